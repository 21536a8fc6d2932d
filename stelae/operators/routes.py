"""Which route a URI takes, for many URIs and many routes at once.

A route is a template of segments, of which some are written ``{name}``; a last
``{name...}`` takes all that is left. Templates with their names at the same places share
a mask. A URI is cut into segments once; under each mask (there are no more of them than
routes) its other segments make a key, which is joined with the routes' keys by equality:
no pattern is run against pairs. Of several routes the one with most literal segments is
taken, then the one without a rest, then the longer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROUTE = "mask string, key string, kind string, names array<string>, literals int, rest boolean, size int"


def route_table(spark, templates: dict[str, str]) -> DataFrame:
    """templates: by kind."""
    rows = []
    for kind, template in templates.items():
        parts = template.strip("/").split("/")
        rest = parts[-1].endswith("...}")
        names = [p.strip("{}.") for p in parts if p.startswith("{")]
        open_at = [i for i, p in enumerate(parts) if p.startswith("{")]
        if any(p.endswith("...}") for p in parts[:-1]) or len(set(names)) < len(names):
            raise ValueError(f"{template}: a rest stands last, and names differ")
        mask = f"{len(parts)}{'+' if rest else ''}:{','.join(map(str, open_at))}"
        key = "/".join(p for p in parts if not p.startswith("{"))
        rows.append((mask, key, kind, names, len(parts) - len(names), rest, len(parts)))
    if len({(r[0], r[1]) for r in rows}) < len(rows):
        raise ValueError("two routes can't be told apart")
    return spark.createDataFrame(rows, ROUTE)


def matched(uris: DataFrame, routes: DataFrame, scheme: str = "edc:") -> DataFrame:
    """uris (uri) -> uri, kind, parts (map of the names to decoded segments), for every row
    of uris; kind is null where no route fits. A query (after ``?``) is no part of it."""
    # Equal URIs are matched once. They are told apart by their text alone: a row number that is
    # read twice need not be the same both times.
    rows = uris.groupBy("uri").agg(F.count(F.lit(1)).alias("times"))
    plain = F.substring_index("uri", "?", 1)
    path = F.when(plain.startswith(scheme), F.substr(plain, F.lit(len(scheme) + 1)))
    rows = rows.withColumn("segments", F.split(F.regexp_replace(path, "^/+|/+$", ""), "/"))
    masks = routes.select("mask", "rest", "size").distinct()
    opened = F.transform(F.filter(F.split(F.split_part("mask", F.lit(":"), F.lit(2)), ","), lambda x: x != ""), lambda x: x.cast("int"))
    # Masks are few: each URI meets each of them that has its length.
    sizes = {(r["size"], r["rest"]): None for r in masks.collect()}
    fits = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(r).alias("rest")) for s, r in sizes])
    count = F.size("segments")
    fits = F.filter(fits, lambda f: (f["rest"] & (count >= f["size"])) | (~f["rest"] & (count == f["size"])))
    asked = rows.withColumn("fit", F.explode_outer(F.when(F.col("segments").isNotNull(), fits))).select("*", "fit.size", "fit.rest").drop("fit")
    asked = asked.join(F.broadcast(masks.withColumn("opened", opened)), ["size", "rest"], "left")
    kept = F.transform(F.slice("segments", 1, F.col("size")), lambda s, i: F.when(~F.array_contains("opened", i), s))
    asked = asked.withColumn("key", F.array_join(F.array_compact(kept), "/"))
    # Routes come from the driver, and many URIs have one key, so they go to the URIs.
    hits = asked.join(F.broadcast(routes.select("mask", "key", "kind", "names", "literals")), ["mask", "key"], "left")
    last = Window.partitionBy("uri").orderBy(F.desc("literals"), "rest", F.desc("size"), "kind")
    best = hits.withColumn("place", F.row_number().over(last)).where("place = 1")
    piece = F.transform("opened", lambda i: F.when(F.col("rest") & (i == F.col("size") - 1), F.array_join(F.slice("segments", i + 1, F.size("segments")), "/")).otherwise(F.get("segments", i)))
    decoded = F.transform(piece, lambda p: F.url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))))
    # An empty segment names nothing.
    fit = F.col("kind").isNotNull() & ~F.exists(piece, lambda p: p == "")
    best = best.select("uri", F.when(fit, F.col("kind")).alias("kind"), F.when(fit, F.map_from_arrays("names", decoded)).alias("parts"), "times")
    return best.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times")


def resolved(found: DataFrame, known: DataFrame, kinds: list[str], page_kinds: list[str] = ()) -> DataFrame:
    """found (uri, kind, parts), known (kind, key: the parts' values joined by ``/``, answer)
    -> uri, kind, status, answer: 400 for what no route reads or for a query on a kind
    without pages, 501 for kinds that aren't answered, 404 for what isn't held, else 200."""
    key = F.array_join(F.map_values("parts"), "/").alias("key")
    rows = found.select("uri", "kind", key).join(known.where(F.col("kind").isin(*kinds)), ["kind", "key"], "left")
    paged = F.col("uri").contains("?") & ~F.col("kind").isin(*page_kinds)
    status = F.when(F.col("kind").isNull() | paged, 400).when(~F.col("kind").isin(*kinds), 501).when(F.col("answer").isNull(), 404)
    status = status.otherwise(200)
    return rows.select("uri", "kind", status.alias("status"), F.when(status == 200, F.col("answer")).alias("answer"))
