"""Blocks of a text log: a header line and the lines below it, wherever files are split.

Spark reads a file in splits that know nothing of each other. Lines get their place from
their file, the start of their split and their number in it. A header's state is carried
by a segmented scan: within each split from line to line; then, over one row for each
split, from the last header of earlier splits of the file to the lines before a split's
own first header. No window spans more than a split, or the splits of one file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stelae.runtime import stored

# The forms of a candidate's header, of a cosine, of a nomination, of what a body may hold.
HEADER = r"^(\d+)\)[ \t]+(.*?)[ \t]+—[ \t]+retrieval cosine[ \t]+(\S+)[ \t]*$"
COSINE = r"^-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?$"
NOMINATION = r"^[ \t]+Nominated by[ \t]+([^:]+):[ \t]*(.*)$"
MARKERS = {
    "cedsReference": r"^[ \t]+CEDS (Value )?Reference:",
    "domains": r"^[ \t]+Domain\(s\):",
    "range": r"^[ \t]+Range:",
    "scope": r"^[ \t]+Scope:",
    "notes": r"^[ \t]+Notes:",
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """-> file, split (where it starts), number (of the line in the split), line; stored,
    so that the numbers hold."""
    held = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("number"), F.col("value").alias("line"),
    )
    return stored(held, "lines")


def carried(lines: DataFrame, state: Column) -> DataFrame:
    """lines and a column ``carried``: the value of ``state`` (a condition's value, null
    where a line doesn't set it) at the last line of the file that sets it, the line's own
    included. The state comes with its place: (split, number, value)."""
    mark = F.when(state.isNotNull(), F.struct("split", "number", state.alias("value")))
    rows = lines.withColumn("mark", mark)
    # The last mark of each split: the greatest place.
    ends = rows.groupBy("file", "split").agg(F.max("mark").alias("last"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("file", "split", F.max("last").over(before).alias("earlier"))
    within = Window.partitionBy("file", "split").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("own", F.last("mark", ignorenulls=True).over(within))
    return rows.join(ends, ["file", "split"]).withColumn("carried", F.coalesce("own", "earlier")).drop("mark", "own", "earlier")


def candidate_blocks(lines: DataFrame) -> DataFrame:
    """-> file, split, number (of the header), position, name, cosine, nominated_by,
    rationale, markers: one row for each block. A block's first nomination counts; a
    nomination line is no body. A header whose cosine is no number opens no block and
    fails the job: it would not be ranked, only lost."""
    is_head = F.col("line").rlike(HEADER)
    part = lambda i: F.regexp_extract("line", HEADER, i)
    cosine = F.when(part(3).rlike(COSINE), part(3).cast("double")).otherwise(
        F.raise_error(F.concat(F.lit("a cosine that is no number: "), "line")).cast("double")
    )
    head = F.struct(part(1).cast("int").alias("position"), part(2).alias("name"), cosine.alias("cosine"))
    rows = carried(lines, F.when(is_head, head)).where("carried is not null")
    at = F.struct("split", "number")
    said = F.col("line").rlike(NOMINATION) & ~is_head
    rows = rows.select(
        "file", F.col("carried.split").alias("head_split"), F.col("carried.number").alias("head_number"), F.col("carried.value").alias("head"), at.alias("at"), "line",
        F.when(said, F.struct(at.alias("at"), F.trim(F.regexp_extract("line", NOMINATION, 1)).alias("by"), F.trim(F.regexp_extract("line", NOMINATION, 2)).alias("why"))).alias("said"),
    )
    # Only the first nomination is left out of the body; a later one matches no marker anyway.
    marked = [F.max(F.when(F.col("line").rlike(p), F.lit(k))).alias(k) for k, p in MARKERS.items()]
    found = rows.groupBy("file", "head_split", "head_number").agg(F.first("head").alias("head"), F.min("said").alias("said"), *marked)
    return found.select(
        "file", F.col("head_split").alias("split"), F.col("head_number").alias("number"), "head.*", F.col("said.by").alias("nominated_by"),
        F.col("said.why").alias("rationale"), F.array_compact(F.array(*MARKERS)).alias("markers"),
    )


def ranked(blocks: DataFrame, by: str = "file") -> DataFrame:
    """Blocks with ``rank`` by cosine, ties in the order shown; display order is no rank."""
    order = Window.partitionBy(by).orderBy(F.desc("cosine"), "split", "number")
    return blocks.withColumn("rank", F.row_number().over(order))
