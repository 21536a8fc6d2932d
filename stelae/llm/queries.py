"""The registered queries of this subpackage: each applies one operator to its
whole table and derives the contract's columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from stelae.llm import (
    bpe,
    chat,
    covertree,
    cuckoo,
    iblt,
    kdfilter,
    labelled,
    packing,
    quality,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
    whitening,
)
from stelae.runtime import new_shared_path, read_table

STRESS_TEXT = r"\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(STRESS_TEXT).alias("text"),
    )
    out = chat.format_conversations(rows.unionByName(extra))
    out = out.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.text_under_mask(F.col("formatted"), F.col("loss_spans"))
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, CASE WHEN lag(role) OVER w = role THEN 0
    ELSE 6 + length(role) + length(regexp_replace(role, '[^\\<#:]', '', 'g')) END AS head,
    row_number() OVER w AS place
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '')) AS loss_sha256,
  sum(head + length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) + 7)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode(read_table(spark, sf_dir, "documents"), path)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), path), 256).alias("decoded_sha256"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.token_pieces(read_table(spark, sf_dir, "documents"), path))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.within_radius(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "warc")
    warc.write_archive(warc.with_revisits(read_table(spark, sf_dir, "pages")), path)
    found = warc.read_archive(spark, path, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), m AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS least FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND least <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND least <> page_id THEN least END AS refers_to
FROM m
"""


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covertree.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s
) WHERE rank <= 5
"""


def op8_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = iblt.with_next_text(read_table(spark, sf_dir, "documents"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), n - half), F.substr(F.col("next_text"), F.lit(1), half))
    rows = rows.select(
        F.col("id").alias("doc_id"),
        n.cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        iblt.digests(F.col("text")).alias("a"),
        iblt.digests(edited).alias("b"),
        iblt.digests(F.col("next_text")).alias("c"),
    )
    rows = rows.select("*", *[iblt.cells(F.col(x), iblt.BASE_CELLS).alias(f"{x}_cells") for x in "abc"])

    def near(x: str):
        lost = iblt.difference(F.col("a"), F.col(x), F.col("a_cells"), F.col(f"{x}_cells"))
        return iblt._let(lost, lambda d: iblt.likeness(F.col("a"), F.col(x), d))

    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        iblt.as_text(F.col("a_cells")).alias("fingerprint"),
        iblt.as_text(F.col("b_cells")).alias("edited_fingerprint"),
        near("b").alias("near_edited"),
        near("c").alias("near_next"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _classified(found: DataFrame, least: float) -> DataFrame:
    return found.select(
        "doc_id",
        labelled.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return _classified(toxicity.score(docs.select("doc_id", "text"), model), 0.5)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return _classified(quality.score(docs.select("doc_id", "text"), model), 0.3)


def op12_cuckoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cuckoo.exact_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents
), g AS (SELECT *, min(doc_id) OVER w AS keep_id, count(*) OVER w AS n FROM d WINDOW w AS (PARTITION BY h))
SELECT doc_id, keep_id, n::BIGINT AS group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM g
"""


def op11_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kdfilter.cluster(read_table(spark, sf_dir, "embeddings"))
    parts = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", F.sha2(parts, 256).alias("centroid_sha256")
    )


def _op11_sql() -> str:
    """The start and three rounds, one table expression each."""
    steps = ["""v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT (row_number() OVER (ORDER BY h, vec_id) - 1)::INTEGER AS cluster, v AS c
  FROM (SELECT *, sha256('1:' || vec_id) AS h FROM v ORDER BY h, vec_id LIMIT 16)
)"""]
    for k in range(4):
        steps.append(f"""a{k} AS (
  SELECT vec_id, any_value(v) AS v, arg_min(cluster, d * 16 + cluster) AS cluster, min(d) AS distance FROM (
    SELECT vec_id, v, cluster,
      (list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c))::BIGINT AS d
    FROM v CROSS JOIN c{k}
  ) GROUP BY vec_id
)""")  # fmt: skip
        if k < 3:
            steps.append(f"""m{k} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM (
    SELECT cluster, place, sum(x)::BIGINT AS s, count(*)::BIGINT AS n
    FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{k}) GROUP BY cluster, place
  ) GROUP BY cluster
), c{k + 1} AS (SELECT c{k}.cluster, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (cluster))""")  # fmt: skip
    return "WITH " + ", ".join(steps) + """
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (cluster)
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=32)
    return found.withColumnRenamed("id", "vec_id")


def queries() -> dict:
    return {
        "op11_kdtree": op11_kdtree,
        "op12_cuckoo": op12_cuckoo,
        "op13_whitening": op13_whitening,
        "op5_toxicity": op5_toxicity,
        "op7_quality": op7_quality,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op8_iblt": op8_iblt,
        "op4_warc": op4_warc,
        "op6_topk": op6_topk,
        "op1_simhash": op1_simhash,
        "op2_packing": op2_packing,
        "op10_bpe": op10_bpe,
        "op9_chat_format": op9_chat_format,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": OP4_SQL,
        "op6_topk": OP6_SQL,
        "op9_chat_format": OP9_SQL,
        "op11_kdtree": _op11_sql(),
        "op12_cuckoo": OP12_SQL,
    }
