"""Index rows derived from blocks, kept up to date as blocks arrive.

A block is a header line and node or edge lines of JSON. Base blocks give an element row
for each node, and a card row for those that are hub references; relationship blocks give
distinct answer edges to meanings. ``update`` derives the rows of blocks that the store
doesn't hold yet, and appends them, with the number of rows of each block, as one commit;
``verify`` derives everything again and compares each block by a digest that doesn't depend
on order, so that what was built step by step is held against what would be built at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.runtime import stored
from stelae.sources import blocks as block_files
from stelae.sources.fold import Store

HEADER = "blockType string, version string, standardKey string, pairA string, pairAVersion string, pairB string, pairBVersion string"
#: Kinds of blocks, the card's label, edges that answer a mapping question.
BASE, RELATIONSHIP, CARD_LABEL = "standardBase", "relationship", "HubReference"
ANSWER_TYPES = ("EXACT_MATCH", "CLOSE_MATCH", "BROAD_MATCH", "NARROW_MATCH", "RELATED_MATCH", "DECLARED_CORRESPONDENCE")
DEFINITIONS = ("definition", "description")
MEANING = r"^edc:hub/([^/@]+)/([^/@]+)/q/(.+)$"
TABLES = ("elements", "hub_cards", "answer_edges")


def block_lines(blocks: DataFrame) -> DataFrame:
    """blocks (ref_id, text) -> ref_id, number, line; empty lines go."""
    lines = blocks.select("ref_id", F.posexplode(F.split("text", "\n")).alias("number", "line"))
    return lines.where("line <> ''")


def _first(name: str) -> Column:
    """The first value of a property, null where it is absent or empty."""
    return F.nullif(F.get(F.col("properties")[name], 0), F.lit(""))


def _parsed(lines: DataFrame) -> DataFrame:
    """Lines beside their block's header; a line that is no JSON object fails the job."""
    # Least numbers are found without the texts; the heads' own size then says how they are joined.
    first = stored(lines.groupBy("ref_id").agg(F.min("number").alias("first")), "first")
    head = lines.join(first, "ref_id").where(F.col("number") == F.col("first"))
    head = head.groupBy("ref_id").agg(F.from_json(F.min("line"), HEADER).alias("header"), F.min("first").alias("first"))
    head = stored(head, "heads")
    rows = lines.join(head, "ref_id").where(F.col("number") > F.col("first"))
    wrong = F.raise_error(F.concat(F.lit("block "), "ref_id", F.lit(": not a line of JSON: "), "line"))
    read = F.col("read")
    rows = rows.withColumn("read", F.from_json("line", block_files.LINE)).withColumn("x", F.when(read.isNotNull() & read["kind"].isNotNull(), read).otherwise(wrong))
    return rows.select("ref_id", "header", "x.*")


def derive(lines: DataFrame) -> dict[str, DataFrame]:
    """lines (ref_id, number, line) -> elements, hub_cards and answer_edges."""
    rows = stored(_parsed(lines), "block_rows")
    nodes = rows.where((F.col("header.blockType") == BASE) & (F.col("kind") == "node"))
    definition = F.coalesce(*map(_first, DEFINITIONS))
    kept = F.to_json(F.struct("labels", "ref", "stableId", F.map_from_entries(F.array_sort(F.map_entries("properties"))).alias("properties")))
    elements = nodes.select(
        "ref_id", F.col("ref.source").alias("standard"), F.col("header.version").alias("version"), F.col("header.standardKey").alias("standard_key"),
        F.col("stableId").alias("element"), _first("parentId").alias("parent"), definition.alias("definition"), kept.alias("node_json"),
    )
    cards = nodes.where(F.array_contains("labels", CARD_LABEL) & F.col("stableId").rlike(MEANING)).select(
        "ref_id", F.col("stableId").alias("meaning"), F.regexp_extract("stableId", MEANING, 1).alias("hub"),
        F.regexp_extract("stableId", MEANING, 2).alias("release"), _first("name").alias("label"), definition.alias("definition"),
        _first("referenceTier").alias("tier"), _first("domainId").alias("domain"),
    )
    edges = rows.where((F.col("header.blockType") == RELATIONSHIP) & (F.col("kind") == "edge") & F.col("type").isin(*ANSWER_TYPES))
    prefix = S.id_prefix(F.col("fromRef.id"))
    version = F.when(prefix == F.col("header.pairA"), F.col("header.pairAVersion")).when(prefix == F.col("header.pairB"), F.col("header.pairBVersion"))
    answers = edges.where(F.col("toRef.id").rlike(MEANING)).select(
        "ref_id", F.col("fromRef.id").alias("subject"), F.col("fromRef.source").alias("standard"), version.alias("version"),
        F.col("toRef.id").alias("meaning"), F.regexp_extract("toRef.id", MEANING, 1).alias("hub"), F.col("type").alias("relation"),
        _first("decisionBlockHash").alias("decision"),
    )
    return {"elements": elements, "hub_cards": cards, "answer_edges": answers.distinct()}


def _counts(lines: DataFrame, derived: dict[str, DataFrame]) -> DataFrame:
    """For each block, also those that give none, the number of its derived rows."""
    found = lines.select("ref_id").distinct().withColumn("n", F.lit(0).cast("long"))
    for rows in derived.values():
        found = found.unionByName(rows.groupBy("ref_id").agg(F.count(F.lit(1)).alias("n")))
    return found.groupBy("ref_id").agg(F.sum("n").alias("derived_rows"))


def update(store: Store, lines: DataFrame) -> int:
    """Derive and append what the store lacks; blocks that it holds are not read again.
    -> the store's version, the same where nothing was new."""
    version = store.version()
    held = store.read("sources", version)
    if held is not None:
        lines = lines.join(held.select("ref_id"), "ref_id", "left_anti")
    lines = stored(lines, "new_lines")
    if not lines.limit(1).count():
        return version
    derived = derive(lines)
    added = {}
    try:
        for name, rows in derived.items():
            added[name] = store.stage(name, rows)
        staged = {name: store.staged(name, segment) for name, segment in added.items()}
        added["sources"] = store.stage("sources", _counts(lines, staged))
        return store.commit(added, version)
    except BaseException:
        for name, segment in added.items():
            store.discard(name, segment)
        raise


def digests(rows: DataFrame, *by: str) -> DataFrame:
    """-> by, n, and four sums of 60 bits each of the rows' SHA-256: equal for equal bags of
    rows whatever their order. Tells accidents apart; sums can be forged on purpose."""
    names = sorted(c for c in rows.columns if c not in by)
    row = F.sha2(F.to_json(F.struct(*[F.coalesce(F.to_json(F.array(c)), F.lit("null")).alias(c) for c in names])), 256)
    parts = [F.conv(F.substring("row", 1 + 15 * i, 15), 16, 10).cast("long").cast("decimal(20,0)") for i in range(4)]
    sums = [F.sum(p).alias(f"part_{i}") for i, p in enumerate(parts)]
    return rows.select(*by, row.alias("row")).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums)


def verify(store: Store, lines: DataFrame) -> DataFrame:
    """-> ref_id, status: same; absent (not derived yet); gone (derived rows without a
    block); or the names of tables whose rows differ from a whole derivation."""
    version = store.version()
    lines = stored(lines, "lines")
    derived = {name: stored(rows, name) for name, rows in derive(lines).items()}  # counted and digested

    def whole(tables: dict[str, DataFrame]) -> DataFrame:
        out = None
        for name, rows in tables.items():
            own = digests(rows, "ref_id").withColumn("table", F.lit(name))
            out = own if out is None else out.unionByName(own)
        return out

    want = whole({**derived, "sources": _counts(lines, derived)})
    names = [*TABLES, "sources"]
    held = {n: store.read(n, version) for n in names}
    have = whole({n: rows for n, rows in held.items() if rows is not None}) if any(r is not None for r in held.values()) else want.where("false")
    parts = ["n", *[f"part_{i}" for i in range(4)]]
    both = want.select("ref_id", "table", F.struct(*parts).alias("want")).join(have.select("ref_id", "table", F.struct(*parts).alias("have")), ["ref_id", "table"], "full")
    is_source = F.col("table") == "sources"
    found = both.groupBy("ref_id").agg(
        F.count_if(is_source & F.col("want").isNotNull()).alias("block"), F.count_if(is_source & F.col("have").isNotNull()).alias("indexed"),
        F.array_sort(F.collect_list(F.when(~F.col("want").eqNullSafe(F.col("have")), F.col("table")))).alias("differing"),
    )
    status = F.when(F.col("indexed") == 0, "absent").when(F.col("block") == 0, "gone").when(F.size("differing") == 0, "same")
    return found.select("ref_id", status.otherwise(F.concat(F.lit("differs: "), F.array_join("differing", ", "))).alias("status"))


def replay_counts(members: DataFrame, lines: DataFrame) -> DataFrame:
    """members (manifest, ref_id), lines -> manifest, blocks, nodes, edges, dangling: what a
    replay that merges by identity would hold. A node is its id; an edge its type, ends and
    properties; an edge with an end that no member holds dangles."""
    rows = stored(members.join(_parsed(lines), "ref_id"), "members")
    nodes = rows.where("kind = 'node'").select("manifest", F.col("stableId").alias("id")).distinct()
    text = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.coalesce("properties", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>")))))))
    ends = [F.col("fromRef.id").alias("a"), F.col("toRef.id").alias("b")]
    edges = rows.where("kind = 'edge'").select("manifest", "type", *ends, F.sha2(text, 256).alias("held")).distinct()
    for end in "ab":
        own = nodes.select("manifest", F.col("id").alias(end), F.lit(True).alias(f"has_{end}"))
        edges = edges.join(own, ["manifest", end], "left")
    whole = F.col("has_a").isNotNull() & F.col("has_b").isNotNull()
    counted = edges.groupBy("manifest").agg(F.count_if(whole).alias("edges"), F.count_if(~whole).alias("dangling"))
    found = members.groupBy("manifest").agg(F.countDistinct("ref_id").alias("blocks"))
    found = found.join(nodes.groupBy("manifest").agg(F.count(F.lit(1)).alias("nodes")), "manifest", "left").join(counted, "manifest", "left")
    return found.fillna(0, ["nodes", "edges", "dangling"]).select("manifest", "blocks", "nodes", "edges", "dangling")


def curated_ids(rows: DataFrame, standards: DataFrame) -> DataFrame:
    """rows (layer, version, decision, ordinal, subject, predicate, object, authors),
    standards (standard_key) -> layer, version, decision, ordinal, assertion_id. Rows of
    no listed standard, or without exactly one author named by an absolute IRI, get no id."""
    known = rows.join(standards.select("standard_key").distinct(), S.id_prefix(F.col("subject")) == F.col("standard_key"), "left_semi")
    author = F.get("authors", 0)
    known = known.where((F.size("authors") == 1) & author.rlike("^[A-Za-z][A-Za-z0-9+.-]*:[^ ]+$"))
    whole = S.assertion_id(F.concat_ws("|", "decision", "subject"), F.col("predicate"), F.col("object"), author)
    return known.select("layer", "version", "decision", "ordinal", whole.alias("assertion_id"))
