"""SimHash near-duplicates: a grid range-join of per-segment bit counts.

A fingerprint's embedding holds the number of set bits of each two-bit segment, in
{0, 1, 2}. The Manhattan distance of two embeddings is a lower bound of the Hamming
distance of the fingerprints. Two fingerprints that differ in at most three bits
differ in at most one bit in one of their halves, so the counts of that half lie in
one grid cell or in cells that touch (one count apart in one segment). Points are
joined with the touching cells and every candidate is verified exactly.

Near duplicates by similarity start with the same join: documents whose fingerprints
lie within the radius are candidates, and become components where the similarity of
their whole shingle sets is high enough. No radius bounds how far apart the
fingerprints of similar sets lie, so what the fingerprints can't reach is completed
exactly, between different components only: two shingle sets of at least a given Jaccard
similarity share one of the first shingles of each in any common order (prefix
filter), so pairs that share none are never looked at and no pair is lost. Shingles that
a sample finds in several documents come last in the order. Each document meets the least
document of each shared shingle; then documents that are still in different components
meet, each pair at its least common shingle. Pairs whose sketches (parities of shingles
by bit, two bits a shingle) lie too far apart go.
Every candidate's similarity is worked out from the whole sets.

Defined results: null text is empty text, with fingerprint zero, linked like any
other; equal texts and repeated rows share a fingerprint; texts of any length
are read whole; rows with a null id keep their fingerprint and component; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stelae.llm.components import connected_components
from stelae.runtime import discard, giving_back, ship_package, stored

SEED, SHINGLE, RADIUS = 42, 3, 3
#: Of near duplicates by similarity: words of a shingle, least Jaccard similarity,
#: documents of the sample, shingles that it ranks at most, documents from which on.
WIDE_SHINGLE, SIMILARITY = 5, 0.8
SAMPLE, MOST_RANKED, LEAST_SEEN = 10_000, 200_000, 3
SKETCH = 8  # words of 64 bits in which a shingle set is sketched, or the power of two that gives two bits a shingle
#: Further hubs of a shingle whose documents fall into more components than that, and how often they are chosen.
HUBS, HUB_TURNS = 4, 2
BRIEF = 4  # words to which sketches are folded where shingles are joined
LEAST_SHARED = 8  # of a document's shared shingles, by which a pair knows where it met before
BLOCK_ROWS = 512  # whose shingle sets are held at once
FILTER_BITS = 24  # of a bitmap of wanted texts, sent to all tasks: 2^18 words at most
_EVEN_BITS = 0x55555555


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """Digests of the lower-cased word shingles of a text, in order."""
    from xxhash import xxh64_intdigest as digest

    words = text.encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    spans = zip((ends - sizes)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_535):
        some = hashes[at : at + 65_535]
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint16)
    over = counts * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the lower-cased word shingles of a text."""
    return majority(shingles(text, width))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> id, fp (the fingerprint's 64 bits as a long)."""
    ship_package(docs.sparkSession)

    def run(batches):
        from stelae.llm import simhash

        for batch in batches:
            found = np.fromiter((simhash.fingerprint(t.as_py() or "") for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, fp long")


def segment_counts(half: Column) -> Column:
    """Bits set in each two-bit segment of a 32-bit half, two bits a segment."""
    return half - F.shiftright(half, 1).bitwiseAND(F.lit(_EVEN_BITS))


def manhattan(a: Column, b: Column) -> Column:
    """Distance of the segment counts of two fingerprints. A count is written as two
    bits, one where any bit is set and one where both are, so that the bits that differ
    add up to the distance."""
    even = F.lit(0x5555555555555555)
    any_ = lambda x: x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(even)
    both = lambda x: x.bitwiseAND(F.shiftrightunsigned(x, 1)).bitwiseAND(even)
    return F.bit_count(any_(a).bitwiseXOR(any_(b))) + F.bit_count(both(a).bitwiseXOR(both(b)))


def _half(fp: Column, index: int) -> Column:
    return (F.shiftrightunsigned(fp, 32) if index else fp).bitwiseAND(F.lit(0xFFFFFFFF))


def _in_half(index: int):
    return lambda cell: F.struct(F.lit(index).alias("half"), cell.alias("cell"))


def links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """points (fp, distinct) -> a, b: the pairs of fingerprints within the radius.
    Both halves may not be further than one bit apart, so the radius is 3 at most."""
    if not 0 <= radius <= 3:
        raise ValueError("the radius must lie in 0..3")
    cells, probes = [], []
    for index in (0, 1):
        counts = segment_counts(_half(F.col("fp"), index))
        cells.append(F.struct(F.lit(index).alias("half"), counts.alias("cell")))
        touching = [
            F.when(F.shiftright(counts, 2 * s).bitwiseAND(F.lit(3)) < 2, counts + F.lit(1 << (2 * s))) for s in range(16)
        ]
        near = F.filter(F.array(counts, *touching), lambda c: c.isNotNull())
        probes.append(F.transform(near, _in_half(index)))
    at = points.select(F.col("fp").alias("a"), F.explode(F.array(*cells)).alias("at")).select("a", "at.half", "at.cell")
    to = points.select(F.col("fp").alias("b"), F.explode(F.concat(*probes)).alias("at")).select("b", "at.half", "at.cell")
    bound = manhattan(F.col("a"), F.col("b")) <= radius
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, radius)
    pairs = at.join(to, ["half", "cell"]).where(bound & apart)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _with_components(own: DataFrame, found: DataFrame, node: str) -> DataFrame:
    """own (id, fp, node), found (a, b: linked nodes) -> id, fp, component_id."""
    first = own.groupBy(node).agg(F.min("id").alias("first_id"))
    roots = connected_components(found, "a", "b")
    named = first.join(roots.withColumnRenamed("node", node), node, "left").withColumn("root", F.coalesce("root", node))
    named = stored(named, "named")
    components = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = stored(named.join(components, "root").select(node, "component_id"), "classes")
    return own.join(classes, node).select("id", "fp", "component_id")


def within_radius(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """-> id, fp, component_id: the smallest id that links reach, the row's own
    included. Copies count once in the join; every link between fingerprints that
    differ is found."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    own = stored(fingerprints(docs, "id", "text"), "fingerprints")
    found = stored(links(own.select("fp").distinct(), radius), "links")
    return _with_components(own, found, "fp").withColumnRenamed("id", id_col)


def _order(held: np.ndarray, ranked: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Distinct digests in the common order: unranked ones, then by documents seen."""
    if not len(ranked):
        return held
    at = np.minimum(np.searchsorted(ranked, held), len(ranked) - 1)
    return held[np.argsort(np.where(ranked[at] == held, seen[at], 0), kind="stable")]


def sketch(held: np.ndarray) -> np.ndarray:
    """The parity of how many digests fall on each bit. Sets that differ in d digests have
    sketches that differ in d bits at most."""
    words = max(SKETCH, 1 << (-(-len(held) // 32) - 1).bit_length())
    bits = np.bincount((held >> np.uint64(32)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _folded(of: Column, at: Column, words: Column) -> Column:
    """The word ``at`` of a sketch folded to so many words."""
    every = F.sequence(at, F.size(of) - 1, words)
    return F.aggregate(every, F.lit(0).cast("long"), lambda held, i: held.bitwiseXOR(F.get(of, i)))


def sketches_apart(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ, the longer one folded to the shorter one's words."""
    words = F.least(F.size(a), F.size(b))

    each = F.transform(F.sequence(F.lit(0), words - 1), lambda at: F.bit_count(_folded(a, at, words).bitwiseXOR(_folded(b, at, words))))
    return F.aggregate(each, F.lit(0), lambda sum_, n: sum_ + n)


def shingle_sets(
    docs: DataFrame, id_col: str, text_col: str, width: int, least: Fraction | None, ranked: np.ndarray, seen: np.ndarray
) -> DataFrame:
    """-> id, fp, node (digest of the set of shingles), n (its size), bits (its sketch),
    held: those of which two similar sets share one, or without ``least`` the whole set."""
    ship_package(docs.sparkSession)

    def run(batches):
        from xxhash import xxh64_intdigest as digest

        from stelae.llm import simhash

        for batch in (b.slice(at, BLOCK_ROWS) for b in batches for at in range(0, b.num_rows, BLOCK_ROWS)):
            rows = []
            for text in batch.column(1):
                hashes = simhash.shingles(text.as_py() or "", width)
                held = np.unique(hashes) if len(hashes) else np.zeros(1, np.uint64)
                n, node, bits = len(held), np.uint64(digest(held.tobytes(), simhash.SEED)), simhash.sketch(held)
                if least is not None:
                    most = n - -(-n * least.numerator // least.denominator) + 1
                    held = simhash._order(held, ranked, seen)[:most]
                rows.append((simhash.majority(hashes), node, n, bits, held.view(np.int64)))
            fp, node, n, bits, held = zip(*rows, strict=True)
            unsigned = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fp, node)]
            arrays = [batch.column(0), *unsigned, pa.array(n, pa.int64()), *[pa.array(x, pa.list_(pa.int64())) for x in (bits, held)]]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "fp", "node", "n", "bits", "held"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(giving_back(run), f"{id_col} {kind}, fp long, node long, n long, bits array<long>, held array<long>")


_NONE = np.empty(0, np.uint64), np.empty(0, np.int64)


def _often_seen(docs: DataFrame, id_col: str, text_col: str, width: int):
    """Shingles of several documents of a sample, ascending, and of how many."""
    step = max(1, docs.count() // SAMPLE)
    some = docs.where(F.pmod(F.xxhash64(id_col, text_col), F.lit(step)) == 0)
    held = shingle_sets(some, id_col, text_col, width, None, *_NONE).select(F.explode("held").alias("shingle"))
    counts = held.groupBy("shingle").count().where(F.col("count") >= LEAST_SEEN)
    got = counts.orderBy(F.desc("count"), "shingle").limit(MOST_RANKED).toArrow()
    ranked, seen = got["shingle"].to_numpy().view(np.uint64), got["count"].to_numpy()
    by = np.argsort(ranked)
    return ranked[by], seen[by]


def _text_digests(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("one"), F.xxhash64(F.lit(1), text).alias("two")


def _perhaps_wanted(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys may be among those wanted: all that are, and few others, by a bitmap
    of their hashes. Its size is bounded, so it is broadcast, whatever their number; the
    others needn't be shuffled for an exact join."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(1 << FILTER_BITS))
    word, bit = F.shiftright(slot, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    bitmap = wanted.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bitmap"))
    held = rows.withColumns({"word": word, "bit": bit}).join(F.broadcast(bitmap), "word")
    return held.where(F.col("bitmap").bitwiseAND(F.col("bit")) != 0).drop("word", "bit", "bitmap")


def close_prints(sets: DataFrame, radius: int = RADIUS) -> DataFrame:
    """sets (fp, node, n; nodes differ) -> a, na, b, nb: of each fingerprint the least node
    with the others, and with the least node of each fingerprint within the radius."""
    heads = stored(sets.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("head")), "prints")

    def of(x: str) -> DataFrame:
        return heads.select(F.col("fp").alias(f"fp_{x}"), F.col("head.node").alias(x), F.col("head.n").alias(f"n{x}"))

    near = links(heads.select("fp"), radius).toDF("fp_a", "fp_b").join(of("a"), "fp_a").join(of("b"), "fp_b")
    equal = sets.select(F.col("fp").alias("fp_a"), F.col("node").alias("b"), F.col("n").alias("nb")).join(of("a"), "fp_a").where("a <> b")
    names = ["a", "na", "b", "nb"]
    return near.select(names).unionByName(equal.select(names))


def similar_sets(own: DataFrame, texts: DataFrame, width: int, least: Fraction) -> DataFrame:
    """own (row, fp, node, n, bits, held: the prefix, id, one, two: digests of the text; nodes
    may repeat), texts (id, text) -> a, b: pairs of nodes of at least this similarity, enough of
    them that every such pair is connected: first those of close fingerprints, then those of
    shared prefixes between different components. Whole sets are made again from the texts,
    only for nodes of pairs whose prefixes and sizes leave them in question."""
    top, under = least.numerator, least.denominator
    ones = stored(own.groupBy("node").agg(F.min("row").alias("row")).select("row"), "ones")
    first = stored(own.join(ones, "row"), "sets_once")
    discard(ones)
    tokens = first.select("node", "n", F.explode("held").alias("token"))
    groups = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n")).alias("hub"))
    groups = groups.where("size > 1").select("token", "hub")
    tokens = stored(tokens.join(groups, "token"), "shared_tokens")
    sized = (F.col("na") * under >= F.col("nb") * top) & (F.col("nb") * under >= F.col("na") * top)
    digests = texts.select("id", *_text_digests(F.col("text")), "text")
    brief = first.select("node", *[_folded(F.col("bits"), F.lit(i), F.lit(BRIEF)).alias(f"brief_{i}") for i in range(BRIEF)])
    apart = sum((F.bit_count(F.col(f"brief_{i}_a").bitwiseXOR(F.col(f"brief_{i}_b"))) for i in range(BRIEF)), F.lit(0))

    def bounded(apart: Column) -> Column:
        """Whether sets whose sketches differ in so many bits can be similar."""
        both = F.col("na") + F.col("nb")
        return (both - apart) * (top + under) >= both * (2 * top)

    def side_of(rows: DataFrame, x: str) -> DataFrame:
        return rows.select([F.col(c).alias(c if c == "token" else x if c == "node" else f"n{x}" if c == "n" else f"{c}_{x}") for c in rows.columns])

    def enough(common: Column) -> Column:  # common shingles for the similarity
        return common * (top + under) >= (F.col("na") + F.col("nb")) * top

    def similar(pairs: DataFrame) -> DataFrame:
        """pairs (a, na, b, nb; distinct) -> a, b of the similar ones. Sketches bound from
        below how many shingles two sets don't share; whole sets decide."""
        for x in "ab":
            pairs = pairs.join(first.select(F.col("node").alias(x), F.col("bits").alias(f"bits_{x}")), x)
        pairs = pairs.where(bounded(sketches_apart(F.col("bits_a"), F.col("bits_b"))))
        pairs = made = stored(pairs.select("a", "na", "b", "nb"), "pairs")
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = first.join(nodes, "node").select(F.col("node").alias("of"), *[F.col(c).alias(f"its_{c}") for c in ("id", "one", "two")])
        same = [F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in ("id", "one", "two")]
        wanted = stored(wanted, "wanted")
        held = _perhaps_wanted(digests, wanted.select(F.col("its_id").alias("id"), F.col("its_one").alias("one"), F.col("its_two").alias("two")), ["id", "one", "two"])
        found = held.join(wanted, same).dropDuplicates(["of"])
        sets = shingle_sets(found.select("of", "text"), "of", "text", width, None, *_NONE)
        sets = stored(sets.select("of", "held"), "sets")
        for x in "ab":
            pairs = pairs.join(sets.select(F.col("of").alias(x), F.col("held").alias(f"held_{x}")), x)
        common = F.size(F.array_intersect("held_a", "held_b"))
        out = stored(pairs.where(enough(common)).select("a", "b"), "similar")
        discard(made, wanted, sets)
        return out

    found = similar(close_prints(first).where(sized))
    roots = connected_components(found, "a", "b")
    stars = tokens.where("node <> hub.node")
    hub = [F.col("hub.node").alias("a"), F.col("hub.n").alias("na")]
    met = stars.select(*hub, F.col("node").alias("b"), F.col("n").alias("nb")).where(sized)
    met = met.groupBy("a", "na", "b", "nb").agg(F.count(F.lit(1)).alias("met"))
    # Common shingles beyond both prefixes are at most what one of the sets has there.
    beyond = F.greatest(*[F.floor((F.col(n) * top + under - 1) / under) - 1 for n in ("na", "nb")])
    met = met.where(enough(F.col("met") + beyond)).drop("met")
    for x in "ab":
        met = met.join(roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")), x, "left")
    apart_yet = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    found = stored(found.unionByName(similar(met.where(apart_yet).select("a", "na", "b", "nb"))), "similar")

    def rooted() -> DataFrame:
        roots = connected_components(found, "a", "b")
        out = stored(tokens.drop("hub").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rest")
        discard(roots)
        return out

    rest = rooted()
    for turn in range(HUB_TURNS):
        # Tokens that still join many components: a few other hubs of each, against the
        # nodes of other components, so that a large group of near copies becomes one
        # before its pairs are made.
        many = rest.groupBy("token").agg(F.countDistinct("root").alias("roots")).where(F.col("roots") > HUBS).select("token")
        crowd = stored(rest.join(many, "token").join(brief, "node"), "crowd")
        if not crowd.limit(1).count():
            break
        by = Window.partitionBy("token").orderBy(F.xxhash64("node", F.lit(turn)), "node")
        chosen = crowd.withColumn("place", F.row_number().over(by)).where(F.col("place") <= HUBS).drop("place")
        near = side_of(chosen, "a").join(side_of(crowd, "b"), "token").where((F.col("root_a") != F.col("root_b")) & sized & bounded(apart))
        found = stored(found.unionByName(similar(near.select("a", "na", "b", "nb").distinct())), "similar")
        discard(crowd, rest)
        rest = rooted()
    discard(tokens)
    whole = rest
    mixed = rest.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    rest = rest.join(mixed.select("token"), "token").groupBy("node", "n", "root").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    rest = rest.join(brief, "node").withColumn("least", F.slice("tokens", 1, LEAST_SHARED))
    rest = stored(rest.withColumn("token", F.explode("tokens")).drop("tokens"), "mixed")
    discard(whole)
    # A pair is made at its least common shingle, and elsewhere only where that isn't
    # among the least shingles that each side holds.
    earlier = F.array_min(F.array_intersect("least_a", "least_b")) < F.col("token")
    pairs = side_of(rest, "a").join(side_of(rest, "b"), "token").where((F.col("root_a") < F.col("root_b")) & sized & bounded(apart))
    pairs = pairs.where(~F.coalesce(earlier, F.lit(False)))
    last = similar(pairs.select("a", "na", "b", "nb").distinct())
    out = stored(found.unionByName(last), "links")
    discard(rest, first, roots)
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDE_SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """-> id, fp, component_id: the smallest id that links reach, the row's own
    included. Rows are linked whose sets of word shingles have at least this Jaccard
    similarity; copies count once."""
    least = Fraction(str(similarity))
    if not 0 < least <= 1:
        raise ValueError("the similarity must lie above 0, and at 1 or below")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    often = _often_seen(docs, "id", "text", width)
    keyed = docs.select(F.struct("id", *_text_digests(F.col("text"))).alias("keys"), "text")
    own = shingle_sets(keyed, "keys", "text", width, least, *often).select("keys.*", "fp", "node", "n", "bits", "held")
    own = stored(own.withColumn("row", F.monotonically_increasing_id()), "shingle_sets")
    found = similar_sets(own, docs, width, least)
    brief = stored(own.select("id", "fp", "node"), "nodes")
    discard(own)
    return _with_components(brief, found, "node").withColumnRenamed("id", id_col)
