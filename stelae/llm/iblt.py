"""Document fingerprints as invertible Bloom lookup tables, in Spark expressions.

A text's units are passages: lines and sentences (of any script), of which each with an
even digest ends a passage, so that only nearby text decides where one ends. The
digests of its distinct units go to three cells each; a cell holds their number, the XOR of the digests and
the XOR of their check values. The difference of two tables is taken cell by cell;
peeling cells that hold one digest recovers the digests that only one side has. Where
peeling stops early the digests are dealt to smaller groups with more cells each,
then to still more; digests that even these can't tell apart are compared as sets.

Defined results: null text is empty text, which has one (empty) unit; repeated rows
and ids keep an order by (id, text), a null id comes first; a single document's next
document is itself; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stelae.runtime import stored

#: Cells of the fingerprint itself; digests per group and cells per group when it
#: fails, and when that fails.
BASE_CELLS, GROUP_ITEMS, GROUP_CELLS, WIDE_CELLS = 18, 8, 24, 66
SENTENCE_END = r"\n|(?<=[.!?|]) |(?<=[。！？])"
BUCKET_IDS, BROADCAST_ROWS = 512, 100_000

_CELL = "struct<n:int,k:bigint,c:bigint>"
_ENTRY = "struct<k:bigint,c:bigint>"
_STATE = f"struct<cells:array<{_CELL}>,out:array<{_CELL}>>"


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.transform(F.array(value), body)[0]


def digests(text: Column) -> Column:
    sentences = F.transform(F.split(F.coalesce(text, F.lit("")), SENTENCE_END, -1), lambda u: F.xxhash64(u))

    def passages(d: Column) -> Column:
        last = F.size(d) - 1
        ends = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (F.pmod(F.get(d, i), F.lit(2)) == 0))
        begin = lambda e, j: F.coalesce(F.get(e, j - 1) + 1, F.lit(0))
        return _let(ends, lambda e: F.transform(e, lambda x, j: F.xxhash64(F.slice(d, begin(e, j) + 1, x - begin(e, j) + 1))))

    return F.array_distinct(_let(sentences, passages))


def _check(key: Column) -> Column:
    return F.xxhash64(F.lit(7), key)


def _place(check: Column, table, width: int) -> Column:
    return F.pmod(F.shiftrightunsigned(check, 20 * table), F.lit(width))


def cells(keys: Column, count: int) -> Column:
    """The table of a list of digests: three sub-tables of count / 3 cells."""
    width = count // 3
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c")).cast(_CELL)

    def add(a, e):
        return F.struct((a["n"] + 1).alias("n"), a["k"].bitwiseXOR(e["k"]).alias("k"), a["c"].bitwiseXOR(e["c"]).alias("c")).cast(_CELL)

    def sub(entries, table):
        def cell(i):
            return F.aggregate(F.filter(entries, lambda e: _place(e["c"], table, width) == i), zero, add)

        return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long")), cell)

    entries = F.transform(keys, lambda k: F.struct(k.alias("k"), _check(k).alias("c")).cast(_ENTRY))
    return _let(entries, lambda e: F.concat(sub(e, 0), sub(e, 1), sub(e, 2)))


def subtract(a: Column, b: Column) -> Column:
    def one(x, y):
        return F.struct(
            (x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["c"].bitwiseXOR(y["c"]).alias("c")
        ).cast(_CELL)

    return F.zip_with(a, b, one)


def peel(difference: Column, count: int) -> Column:
    """The digests (k) with their side (n: 1 or -1), or null if peeling stops early."""
    width = count // 3

    def strip(pure):
        def cell(c, i):
            turn = (F.floor(i / width) * 20).cast("int")
            mine = F.filter(
                pure, lambda p: F.pmod(F.call_function("shiftrightunsigned", p["c"], turn), F.lit(width)) == i % width
            )
            return F.aggregate(
                mine,
                c,
                lambda a, p: F.struct(
                    (a["n"] - p["n"]).alias("n"), a["k"].bitwiseXOR(p["k"]).alias("k"), a["c"].bitwiseXOR(p["c"]).alias("c")
                ).cast(_CELL),
            )

        return cell

    def step(state, _):
        pure = F.array_distinct(F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["k"]) == c["c"])))
        return _let(
            pure,
            lambda p: F.when(F.size(p) == 0, state).otherwise(
                F.struct(
                    F.transform(state["cells"], strip(p)).alias("cells"), F.concat(state["out"], p).alias("out")
                ).cast(_STATE)
            ),
        )

    start = F.struct(difference.alias("cells"), F.array().cast(f"array<{_CELL}>").alias("out")).cast(_STATE)
    end = F.aggregate(F.sequence(F.lit(1), F.lit(count)), start, step)  # a round peels one cell at least
    rest = lambda s: F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0))
    return _let(end, lambda s: F.when(~rest(s), s["out"]))


def _as_sets(a: Column, b: Column) -> Column:
    def side(keys, n):
        return F.transform(keys, lambda k: F.struct(F.lit(n).alias("n"), k.alias("k"), _check(k).alias("c")).cast(_CELL))

    return F.concat(side(F.array_except(a, b), 1), side(F.array_except(b, a), -1))


def _grouped(a: Column, b: Column, groups: Column) -> Column:
    """The digests of both sides dealt to groups: sorted by group behind one mark for
    each group, and cut at the marks."""
    entry = "struct<g:bigint,side:int,k:bigint>"

    def side(keys, n):
        group = lambda k: F.pmod(F.shiftrightunsigned(k, 3), groups)
        return F.transform(keys, lambda k: F.struct(group(k).alias("g"), F.lit(n).alias("side"), k.alias("k")).cast(entry))

    marks = F.transform(
        F.sequence(F.lit(0).cast("long"), groups - 1),
        lambda g: F.struct(g.alias("g"), F.lit(-1).alias("side"), F.lit(0).cast("long").alias("k")).cast(entry),
    )

    def cut(x: Column) -> Column:
        at = F.filter(F.transform(x, lambda e, i: F.when(e["side"] < 0, i)), lambda i: i.isNotNull())
        stop = lambda p, j: F.coalesce(F.get(p, j + 1), F.size(x))
        return _let(at, lambda p: F.transform(p, lambda i, j: F.slice(x, i + 2, stop(p, j) - i - 1)))

    return _let(F.array_sort(F.concat(marks, side(a, 0), side(b, 1))), cut)


def difference(a: Column, b: Column, a_cells: Column, b_cells: Column) -> Column:
    """The digests that only one side has, from the base tables if they can be peeled."""
    groups = F.ceil(F.greatest(F.size(a), F.size(b)) / GROUP_ITEMS).cast("long")

    def group(entries):
        own = lambda n: F.transform(F.filter(entries, lambda e: e["side"] == n), lambda e: e["k"])
        return _let(F.struct(own(0).alias("a"), own(1).alias("b")), wider)

    def wider(x):
        tried = [peel(subtract(cells(x["a"], n), cells(x["b"], n)), n) for n in (GROUP_CELLS, WIDE_CELLS)]
        return F.coalesce(*tried, _as_sets(x["a"], x["b"]))

    larger = F.flatten(F.transform(_grouped(a, b, groups), group))
    # A table gives back no more digests than it has cells, so some need not be tried.
    few = F.abs(F.size(a) - F.size(b)) <= BASE_CELLS
    return F.when(a_cells == b_cells, F.array().cast(f"array<{_CELL}>")).otherwise(
        F.coalesce(F.when(few, peel(subtract(a_cells, b_cells), BASE_CELLS)), larger)
    )


def likeness(a: Column, b: Column, recovered: Column) -> Column:
    """Shared digests over all digests, from the sizes and the recovered difference."""
    both = F.size(a) + F.size(b)
    return ((both - F.size(recovered)) / (both + F.size(recovered))).cast("double")


def as_text(table: Column) -> Column:
    """A table as hexadecimal text."""
    wide = lambda x, n: F.lower(F.lpad(F.hex(x), n, "0"))
    return F.array_join(
        F.transform(table, lambda c: F.concat(wide(c["n"], 4), wide(c["k"], 16), wide(c["c"], 16))), ""
    )


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> id, text, next_text, by ascending id, the last followed by the first. Ids
    fall into buckets of neighbours; a bucket's first row also goes, last in order, to
    the bucket before it, so one shuffle of the texts brings neighbours together."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 62))).alias("key"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("bucket", F.floor(F.col("key") / BUCKET_IDS))
    firsts = rows.groupBy("bucket").agg(F.min("key").alias("key")).repartitionByRange("bucket")
    firsts = stored(firsts.withColumn("block", F.spark_partition_id()), "buckets")
    blocks = firsts.groupBy("block").agg(F.max("bucket").alias("last"), F.min("bucket").alias("bucket"))
    order = Window.orderBy("bucket")  # of ranges: no more rows than shuffle partitions
    blocks = blocks.select("bucket", F.lag("last").over(order).alias("last_before"))
    ends = firsts.agg(F.max("bucket").alias("end"))
    inner = F.lag("bucket").over(Window.partitionBy("block").orderBy("bucket"))
    firsts = firsts.withColumn("inner", inner).join(blocks, "bucket", "left").join(F.broadcast(ends))
    before = F.coalesce("inner", "last_before")
    firsts = firsts.select(
        "bucket", "key", F.coalesce(before, "end").alias("before"), before.isNull().cast("int").alias("wrap")
    )
    firsts = stored(firsts, "firsts").select("key", "before", "wrap")
    if firsts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("wrap"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("bucket"), F.col("wrap"), F.lit(True).alias("guest"))
    joined = rows.join(firsts, "key", "left")
    dealt = joined.select(
        "id", "key", "text", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, guest))).alias("to")
    ).select("id", "key", "text", "to.*")
    follow = Window.partitionBy("bucket").orderBy("wrap", "guest", "key", "text")
    return (
        dealt.withColumn("next_text", F.lead("text").over(follow)).where(~F.col("guest")).select("id", "text", "next_text")
    )
