"""Chat formatting with Spark expressions only: a conversation's turns are collected as
structs and sorted, adjacent turns of one role are merged by array functions, and the
parts are concatenated.

Template: adjacent turns of one role form a block, ``### role: `` followed by each
turn's escaped text and ``</turn>``. Inside roles and texts ``\\`` becomes ``\\b``,
``<`` ``\\l``, ``#`` ``\\h`` and ``:`` (roles only) ``\\c``, so that no text can hold a
control string and reading back is exact.

Defined results: null text or role is empty; rows with a null conv_id form one
conversation; turns order by (turn, role, text) with nulls first, so ties and
repeated rows keep one order; texts of any length are written whole (a conversation is
one row, as its output must be); an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, HEAD_END, TURN_END = "### ", ": ", "</turn>"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
#: Turns whose lengths are summed in one go.
CHUNK = 256


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, written in pairs:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for plain, written in reversed(pairs):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.transform(F.array(value), body)[0]


def _totals(values: Column) -> Column:
    """The sum of what comes before each value, 0 for the first. Chunks are summed
    on their own, so that arrays that grow by one stay short."""
    zero = F.array(F.lit(0).cast("long"))
    plain = lambda x: F.aggregate(x, zero, lambda acc, v: F.array_append(acc, F.element_at(acc, -1) + v))
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
        lambda c: plain(F.slice(values, c * CHUNK + 1, F.lit(CHUNK))),
    )

    def joined(held: Column) -> Column:
        base = plain(F.transform(held, lambda x: F.element_at(x, -1)))
        shift = lambda b: F.flatten(F.transform(held, lambda x, i: F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda v: v + F.get(b, i))))
        return _let(base, shift)

    return _let(chunks, joined)


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, formatted, loss_spans.

    loss_spans holds, in order, the code-point ranges [start, end) of ``formatted``
    that carry loss: the escaped texts of ``loss_role``."""
    rows = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))

    def blocks(said: Column) -> Column:
        """Adjacent turns of one role."""
        first = lambda i: (i == 0) | (F.get(said, i)["role"] != F.get(said, i - 1)["role"])
        starts = F.filter(F.sequence(F.lit(0), F.size(said) - 1), first)
        stop = lambda s, j: F.coalesce(F.get(s, j + 1), F.size(said))
        return _let(starts, lambda s: F.transform(s, lambda a, j: F.slice(said, a + 1, stop(s, j) - a)))

    def written(block: Column) -> Column:
        role = block[0]["role"]
        return F.struct(
            F.concat(F.lit(HEAD), escape(role, ROLE_ESCAPES), F.lit(HEAD_END)).alias("head"),
            (role == loss_role).alias("loss"),
            F.transform(block, lambda t: escape(t["text"])).alias("bodies"),
        )

    def text(block: Column) -> Column:
        return F.concat(block["head"], F.array_join(F.transform(block["bodies"], lambda b: F.concat(b, F.lit(TURN_END))), ""))

    def measures(block: Column) -> Column:
        """Of each turn: code points before its body, of its body; and whether it counts."""
        lead = lambda i: F.when(i == 0, F.length(block["head"])).otherwise(0).cast("long")
        return F.transform(
            block["bodies"],
            lambda b, i: F.struct(lead(i).alias("lead"), F.length(b).cast("long").alias("n"), block["loss"].alias("loss")),
        )

    def spans(m: Column) -> Column:
        before = _totals(F.transform(m, lambda x: x["lead"] + x["n"] + len(TURN_END)))

        def placed(b: Column) -> Column:
            start = lambda x, i: F.get(b, i) + x["lead"]
            return F.transform(m, lambda x, i: F.when(x["loss"], F.struct(start(x, i).alias("start"), (start(x, i) + x["n"]).alias("end"))))

        return F.filter(_let(before, placed), lambda x: x.isNotNull())

    rows = rows.select("conv_id", F.transform(_let(F.col("said"), blocks), written).alias("blocks"))
    return rows.select(
        "conv_id",
        F.array_join(F.transform("blocks", text), "").alias("formatted"),
        _let(F.flatten(F.transform("blocks", measures)), spans).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>."""
    blocks = F.split(formatted, HEAD, -1)
    blocks = F.slice(blocks, F.lit(2), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        cut = F.instr(block, HEAD_END)
        role = unescape(F.substr(block, F.lit(1), cut - 1), ROLE_ESCAPES)
        texts = F.split(F.substr(block, cut + len(HEAD_END)), TURN_END, -1)
        texts = F.slice(texts, F.lit(1), F.size(texts) - 1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def text_under_mask(formatted: Column, spans: Column) -> Column:
    """Everything that the mask covers, unescaped, in order, nothing between."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
        ),
        "",
    )
