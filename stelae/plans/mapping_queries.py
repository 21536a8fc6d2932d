"""Retrieval, votes, classification, agreement and text functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.operators import bridge, retrieval
from stelae.plans.model import Tables
from stelae.plans.registry import query
from stelae.runtime import stored

TOPK_SQL = """WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), s AS (
SELECT a.vec_id AS subject, b.vec_id AS card, a.label AS own, b.label AS theirs, list_cosine_similarity(a.v, b.v) AS cosine
FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id), top AS (
SELECT *, row_number() OVER (PARTITION BY subject ORDER BY cosine DESC, card)::INTEGER AS rank FROM s WHERE cosine >= 0.1)
"""


def _top(t: Tables, k: int = 10):
    vectors = t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    return retrieval.cosine_top_k(vectors.where("id % 100 = 0"), vectors, k, 0.1, skip_own=True)


@query(TOPK_SQL + "SELECT subject, card, round(cosine, 6) AS cosine, rank FROM top WHERE rank <= 10")
def cosine_topk(t: Tables):
    return _top(t).withColumn("cosine", F.round("cosine", 6))


@query(TOPK_SQL + "SELECT k, count(*) FILTER (WHERE rank <= k) AS found, count(*) AS subjects, round(count(*) FILTER (WHERE rank <= k) / count(*), 4) AS recall FROM (SELECT subject, min(CASE WHEN own = theirs THEN rank END) AS rank FROM top WHERE rank <= 10 GROUP BY 1), (VALUES (1), (3), (5), (10)) c(k) GROUP BY k")
def recall_at_k(t: Tables):
    labels = t.embeddings.select(F.col("vec_id").alias("card"), F.col("label").alias("theirs"))
    own = t.embeddings.select(F.col("vec_id").alias("subject"), F.col("label").alias("own"))
    ranked = stored(_top(t).join(labels, "card").join(own, "subject"), "ranked")  # both branches read it
    truth = ranked.where("own = theirs").select("subject", "card").unionByName(
        ranked.groupBy("subject").agg(F.lit(None).cast("long").alias("card"))
    )
    return retrieval.recall_at(ranked, truth, [1, 3, 5, 10])


@query(TOPK_SQL + """SELECT CASE WHEN rank = 1 THEN '1' WHEN rank <= 3 THEN '2-3' ELSE '4-10' END AS bucket, count(*) AS n,
count(*) FILTER (WHERE own = theirs) AS n_right FROM top WHERE rank <= 10 GROUP BY 1""")
def rank_buckets(t: Tables):
    labels = t.embeddings.select("vec_id", "label")
    ranked = _top(t).join(labels.toDF("card", "theirs"), "card").join(labels.toDF("subject", "own"), "subject")
    return ranked.groupBy(S.rank_bucket(F.col("rank")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("own") == F.col("theirs")).alias("n_right")
    )


@query(TOPK_SQL + """SELECT subject, theirs AS class, round(count(*) / 10, 6) AS share FROM top WHERE rank <= 10 GROUP BY ALL""")
def neighbour_shares(t: Tables):
    labels = t.embeddings.select(F.col("vec_id").alias("neighbour"), F.col("label").alias("class"))
    near = _top(t).select("subject", F.col("card").alias("neighbour"))
    return retrieval.class_shares(near, labels).withColumn("share", F.round("share", 6))


@query(TOPK_SQL + """SELECT subject, class FROM (SELECT *, max(n) OVER (PARTITION BY subject) AS most FROM
(SELECT subject, theirs AS class, count(*) AS n FROM top WHERE rank <= 10 GROUP BY ALL)) WHERE n = most""")
def neighbour_top_share(t: Tables):
    labels = t.embeddings.select(F.col("vec_id").alias("neighbour"), F.col("label").alias("class"))
    near = stored(_top(t).select("subject", F.col("card").alias("neighbour")), "near")  # read twice
    return retrieval.top_share(retrieval.class_shares(near, labels)).select("subject", "class")


@query(TOPK_SQL + """, slots AS (SELECT vec_id AS base, label AS card, CASE WHEN vec_id % 3 = 0 THEN 'RANGE' ELSE 'PROPERTY' END AS slot FROM embeddings)
SELECT subject, s.card, count(DISTINCT CASE WHEN slot = 'PROPERTY' THEN base END) AS own_votes, count(*) AS paths,
round(max(CASE WHEN slot = 'PROPERTY' THEN cosine END), 6) AS best_cosine FROM top JOIN slots s ON s.base = top.card
WHERE rank <= 10 GROUP BY ALL HAVING count(CASE WHEN slot = 'PROPERTY' THEN 1 END) > 0""")
def text_vote_pool(t: Tables):
    hits = _top(t).select("subject", F.col("card").alias("text"), F.col("card").alias("base"), "cosine")
    slot = F.when(F.col("vec_id") % 3 == 0, "RANGE").otherwise("PROPERTY")
    slots = t.embeddings.select(F.col("label").alias("card"), slot.alias("slot"), F.col("vec_id").alias("base"))
    return retrieval.vote_pool(hits, slots).withColumn("best_cosine", F.round("best_cosine", 6))


@query("SELECT count(*) AS n FROM embeddings WHERE embedding IS NULL OR len(embedding) <> 64")
def vector_fitness(t: Tables):
    vectors = t.embeddings.select(F.col("embedding").alias("vector"))
    return retrieval.unfit_vectors(vectors, 64).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 5) AS norm FROM embeddings")
def vector_norm(t: Tables):
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return t.embeddings.select("vec_id", F.round(F.sqrt(square), 5).alias("norm"))


@query("SELECT trim(text) AS text, min(doc_id) AS text_id, count(*) AS n FROM documents WHERE trim(text) <> '' GROUP BY 1")
def embed_text_dedup(t: Tables):
    text = F.btrim("text", F.lit(" ")).alias("text")
    found = t.documents.select("doc_id", text).where("text <> ''").groupBy("text")
    return found.agg(F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("n"))


@query("""SELECT sum(n)::BIGINT AS n_cards, count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_contended, max(n) AS worst
FROM (SELECT p_name, count(*) AS n FROM part GROUP BY 1)""")
def key_multimap_contention(t: Tables):
    return bridge.contention(t.part, "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#2' AND p_type = 'ECONOMY' AND p_size = 11")
def tuple_filter(t: Tables):
    wanted = {"p_brand": F.lit("Brand#2"), "p_type": F.lit("ECONOMY"), "p_size": F.lit(11)}
    return bridge.tuple_filter(t.part, wanted).select("p_partkey", "p_name")


@query("""SELECT 'p_brand' AS field, count(*) FILTER (WHERE p_brand <> 'Brand#2') AS eliminated FROM part
UNION ALL SELECT 'p_type', count(*) FILTER (WHERE p_type <> 'ECONOMY') FROM part""")
def tuple_eliminations(t: Tables):
    return bridge.eliminations(t.part, {"p_brand": F.lit("Brand#2"), "p_type": F.lit("ECONOMY")})


@query("""SELECT class, count(*) AS n FROM (SELECT CASE WHEN l_discount > 0.08 THEN 'refused' WHEN l_quantity < 5 THEN 'gap'
WHEN l_returnflag = 'R' THEN 'exact' WHEN l_tax > 0.04 THEN 'close' ELSE 'related' END AS class FROM lineitem) GROUP BY 1""")
def classification_case(t: Tables):
    rules = [("refused", F.col("l_discount") > 0.08), ("gap", F.col("l_quantity") < 5), ("exact", F.col("l_returnflag") == "R"), ("close", F.col("l_tax") > 0.04)]
    found = t.lineitem.select(bridge.first_match(rules, "related").alias("class"))
    return found.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT from_id, object FROM (SELECT o_orderkey AS s, o_custkey AS object FROM orders) o
JOIN (SELECT l_orderkey, l_orderkey * 100 + l_linenumber AS from_id FROM lineitem) l ON l_orderkey = s
UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def planned_edges_fanout(t: Tables):
    own = F.collect_list(F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("instances")
    held = t.lineitem.groupBy(F.col("l_orderkey").alias("subject")).agg(own)
    orders = t.orders.select(F.col("o_orderkey").alias("subject"), F.col("o_custkey").alias("object"))
    rows = orders.join(held, "subject", "left").withColumn("predicate", F.lit("exact"))
    rows = rows.withColumn("instances", F.coalesce("instances", F.array().cast("array<bigint>")))
    return bridge.planned_edges(rows).select("from_id", "object")


@query("""WITH e AS (SELECT DISTINCT l_returnflag AS block, l_suppkey AS from_id, l_partkey % 40 AS object FROM lineitem)
SELECT a.block, b.other, a.from_id, a.object FROM e a JOIN (SELECT DISTINCT block AS other, from_id FROM e) b
ON a.from_id = b.from_id AND a.block <> b.other
WHERE NOT EXISTS (SELECT 1 FROM e x WHERE x.block = b.other AND x.from_id = a.from_id AND x.object = a.object)""")
def sibling_conflicts(t: Tables):
    edges = t.lineitem.select(F.col("l_returnflag").alias("block"), F.col("l_suppkey").alias("from_id"), (F.col("l_partkey") % 40).alias("object"))
    return bridge.sibling_conflicts(edges)


@query("""SELECT lang, source, count(*) AS units, count(*) FILTER (WHERE quality = 1 - toxic) AS agreed,
count(*) FILTER (WHERE quality <> 1 - toxic) AS differed, round(count(*) FILTER (WHERE quality = 1 - toxic) / count(*), 4) AS rate
FROM labels JOIN documents USING (doc_id) GROUP BY GROUPING SETS ((lang), (source), ())""")
def agreement_tally(t: Tables):
    units = t.labels.join(t.documents.select("doc_id", "lang", "source"), "doc_id")
    units = units.select("lang", "source", F.col("quality").alias("judge"), (1 - F.col("toxic")).alias("rater"))
    return bridge.agreement(units, ["lang", "source"])


@query("""SELECT o_orderkey, CASE WHEN ('0x' || substr(sha256(o_orderpriority || o_orderkey), 1, 8))::BIGINT % 7 < 5
THEN ('0x' || substr(sha256(o_orderpriority || o_orderkey), 1, 8))::BIGINT % 7 + 1 ELSE 0 END AS choice FROM orders""")
def digest_judge(t: Tables):
    prompt = F.concat("o_orderpriority", F.col("o_orderkey").cast("string"))
    return t.orders.select("o_orderkey", bridge.digest_judge(prompt, F.lit(5), 2).alias("choice"))


@query("""SELECT p_brand AS pool, p_name AS rendering, min(p_partkey) AS stands, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS members
FROM part GROUP BY ALL""")
def rendered_collapse(t: Tables):
    cards = t.part.select(F.col("p_brand").alias("pool"), F.col("p_name").alias("rendering"), F.col("p_partkey").alias("id"))
    found = bridge.collapsed(cards, "pool", "rendering", "id", "id")
    return found.select("pool", "rendering", "stands", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@query("""SELECT a.l_orderkey AS owner, max(b.l_quantity) AS donor_version, arg_max(b.l_returnflag || b.l_linestatus, b.l_quantity) AS text
FROM lineitem a JOIN (SELECT l_partkey, l_quantity, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1, 2) b
ON a.l_partkey = b.l_partkey AND b.l_quantity > a.l_quantity WHERE a.l_linenumber = 1
AND a.l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1 GROUP BY 1 HAVING count(*) = 1) GROUP BY 1""")
def donor_text_latest(t: Tables):
    first = t.lineitem.where("l_linenumber = 1")
    single = first.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("l_orderkey")
    owners = first.join(single, "l_orderkey", "left_semi").select("l_partkey", F.col("l_orderkey").alias("owner"), F.col("l_quantity").alias("version"))
    donors = t.lineitem.groupBy("l_partkey", F.col("l_quantity").alias("version")).agg(
        F.concat(F.min("l_returnflag"), F.min("l_linestatus")).alias("text")
    )
    return bridge.later_donor(owners, donors, ["l_partkey"])


@query("""SELECT nations, count(*) AS n FROM (SELECT o_orderstatus, count(DISTINCT o_custkey) AS targets, o_orderpriority FROM orders GROUP BY 1, 3),
(SELECT count(*) AS nations FROM nation) GROUP BY 1""")
def cardinality_census(t: Tables):
    groups = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.countDistinct("o_custkey").alias("targets"))
    n = t.nation.agg(F.count(F.lit(1)).alias("nations"))
    return groups.join(F.broadcast(n)).groupBy("nations").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_orderkey AS subject, string_agg(DISTINCT l_partkey::VARCHAR, ',' ORDER BY l_partkey::VARCHAR) AS target_set FROM lineitem GROUP BY 1""")
def target_set_canonical(t: Tables):
    found = t.lineitem.groupBy(F.col("l_orderkey").alias("subject"))
    return found.agg(F.array_join(F.array_sort(F.collect_set(F.col("l_partkey").cast("string"))), ",").alias("target_set"))


@query("""SELECT p_brand AS domain, p_type AS "range", count(*) AS cards, count(DISTINCT p_name) AS names,
sha256(p_brand || '|' || p_type || '|') AS signature FROM part GROUP BY ALL""")
def hub_card_enumeration(t: Tables):
    signature = F.sha2(S.address_signature(F.col("domain"), F.col("range"), F.lit(None)), 256).alias("signature")
    found = t.part.groupBy(F.col("p_brand").alias("domain"), F.col("p_type").alias("range"))
    return found.agg(F.count(F.lit(1)).alias("cards"), F.countDistinct("p_name").alias("names")).select("*", signature)


@query("SELECT p_partkey, sha256('m1' || chr(0) || '64' || chr(0) || p_name) AS vector_id FROM part")
def vector_id(t: Tables):
    return t.part.select("p_partkey", S.vector_id(F.lit("m1"), F.lit(64), F.col("p_name")).alias("vector_id"))


@query("SELECT l_orderkey, l_linenumber, sha256(l_orderkey || chr(10) || l_returnflag || chr(10) || l_partkey) AS assertion_id FROM lineitem")
def assertion_id(t: Tables):
    found = S.assertion_id(F.col("l_orderkey"), F.col("l_returnflag"), F.col("l_partkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", found.alias("assertion_id"))


@query("""SELECT l_orderkey, 'mapping:' || CASE WHEN l_orderkey % 2 = 0 THEN '~' ELSE '' END || sha256(
string_agg(DISTINCT 's' || l_suppkey, ' ' ORDER BY 's' || l_suppkey) || chr(10) || 'p' || chr(10) ||
string_agg(DISTINCT 'o' || l_partkey, ' ' ORDER BY 'o' || l_partkey)) AS mapping_id FROM lineitem GROUP BY 1""")
def mapping_sameness(t: Tables):
    lists = t.lineitem.groupBy("l_orderkey").agg(
        F.collect_list(F.concat(F.lit("s"), "l_suppkey")).alias("s"), F.collect_list(F.concat(F.lit("o"), "l_partkey")).alias("o")
    )
    found = S.mapping_sameness_id(F.col("s"), F.lit("p"), F.col("o"), F.col("l_orderkey") % 2 == 0)
    return lists.select("l_orderkey", found.alias("mapping_id"))


@query("SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS text FROM documents")
def whitespace_collapse(t: Tables):
    return t.documents.select("doc_id", S.collapse_whitespace(F.col("text")).alias("text"))


@query("""SELECT page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), '^_|_$', '', 'g') AS slug FROM pages""")
def slugify(t: Tables):
    return t.pages.select("page_id", S.slugify(F.col("url")).alias("slug"))


@query("SELECT p_partkey, concat_ws(' | ', nullif(trim(p_name), ''), nullif(trim(p_brand), ''), CASE WHEN p_size > 25 THEN p_type END) AS text FROM part")
def search_text(t: Tables):
    kind = F.when(F.col("p_size") > 25, F.col("p_type"))
    return t.part.select("p_partkey", S.search_text(F.col("p_name"), F.col("p_brand"), kind).alias("text"))


@query("""SELECT o_orderkey, 'hub' AS hub, o_orderstatus AS hub_version, 'src' AS source, o_orderkey::VARCHAR AS source_version,
substr(o_orderpriority, 1, 1) AS suffix, CASE WHEN o_orderkey % 2 = 0 THEN 'm' END AS mark FROM orders""")
def subject_grammar(t: Tables):
    mark = F.when(F.col("o_orderkey") % 2 == 0, F.lit("m"))
    text = S.compose_subject(F.lit("hub"), F.col("o_orderstatus"), F.lit("src"), F.col("o_orderkey").cast("string"), F.substring("o_orderpriority", 1, 1), mark)
    return t.orders.select("o_orderkey", S.parse_subject(text).alias("s")).select("o_orderkey", "s.*")


@query("""SELECT word, count(DISTINCT p_partkey) AS n FROM (SELECT p_partkey, unnest(string_split_regex(p_name || ' ' || lower(p_type), '[^A-Za-z0-9]+')) AS word FROM part)
WHERE word <> '' GROUP BY 1""")
def idea_split(t: Tables):
    words = F.explode(S.split_compound(F.concat_ws(" ", "p_name", F.lower("p_type")))).alias("word")
    return t.part.select("p_partkey", words).groupBy("word").agg(F.countDistinct("p_partkey").alias("n"))


@query("""WITH w AS (SELECT item_id, list_filter(string_split_regex(text, '[^A-Za-z]+'), lambda x: x <> '') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 2], ' ') AS gram FROM w, unnest(range(1, len(w) - 1)) r(i))
SELECT gram, count(*) AS docs FROM g GROUP BY 1 HAVING count(*) > 1""")
def ngram_docfreq(t: Tables):
    words = F.filter(F.split("text", "[^A-Za-z]+"), lambda w: w != "")
    rows = t.benchmark.select("item_id", words.alias("w")).where(F.size("w") >= 3)
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.array_join(F.slice("w", i, 3), " "))
    found = rows.select("item_id", F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram")
    return found.agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")


@query(r"""SELECT source, count(*) FILTER (WHERE regexp_matches(text, '[A-Za-z0-9._]+@[a-z0-9.]+\.[a-z]+')) AS mails,
count(*) FILTER (WHERE regexp_matches(text, '[0-9a-f]{32}')) AS keys FROM documents GROUP BY 1""")
def identifier_scan(t: Tables):
    return t.documents.groupBy("source").agg(
        F.count_if(F.col("text").rlike(r"[A-Za-z0-9._]+@[a-z0-9.]+\.[a-z]+")).alias("mails"),
        F.count_if(F.col("text").rlike("[0-9a-f]{32}")).alias("keys"),
    )


@query("SELECT p_partkey, replace(replace(url, '/', '%2F'), ':', '%3A') AS segment FROM (SELECT p_partkey, 'a b/' || p_partkey || ':x' AS u, replace('a b/' || p_partkey || ':x', ' ', '%20') AS url FROM part)")
def encode_segment(t: Tables):
    text = F.concat(F.lit("a b/"), F.col("p_partkey").cast("string"), F.lit(":x"))
    return t.part.select("p_partkey", S.encode_segment(text).alias("segment"))


@query("""SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey % 7, p_partkey % 11, p_partkey) AS place FROM part""")
def version_order(t: Tables):
    text = F.concat_ws(".", F.col("p_size").cast("string"), (F.col("p_partkey") % 7).cast("string"), (F.col("p_partkey") % 11).cast("string"))
    rows = t.part.select("p_partkey", "p_brand", S.version_key(text).alias("v"))
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy("v", "p_partkey"))
    return rows.select("p_partkey", place.cast("long").alias("place"))
