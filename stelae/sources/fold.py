"""Folding one store into another: a plan that only reads, and an append of several
tables that is seen whole or not at all.

A store is a folder. ``tables/<name>/<segment>`` are Parquet folders, ``commits/<number>``
are markers that list the segments of every table; the newest marker is the store. An
append writes new segments first, checks them, and then adds one marker. Until that
marker is there readers see the store as it was, whatever became of the job; segments
without a marker are swept by ``sweep``. A marker is never written over: of two writers
that began from one state the second is refused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stelae.operators.inversions import inversions, numbered
from stelae.runtime import stored

PLAN = (
    "table_name string, source_rows long, target_rows long, missing long, overlap long, repeated long, "
    "conflicts long, order_conflicts long, inversions long"
)


@dataclass(frozen=True)
class TableRule:
    """What makes rows of a table the same (address), what they then must agree in
    (payload), the column whose later rows supersede earlier ones (pair), the order of
    writing (order; given anew by the target if it is also omitted), columns that aren't
    copied, and parents: (own columns, table, its columns)."""

    name: str
    address: tuple[str, ...]
    payload: tuple[str, ...]
    pair: str | None = None
    order: str | None = None
    omitted: tuple[str, ...] = ()
    parents: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()


class Refused(ValueError):
    """A fold that would lose or contradict something; nothing was written."""


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._root = self._hadoop.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, folder: str) -> list[str]:
        path = self._hadoop.Path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def version(self) -> int:
        """Of the newest marker; 0 for a store without any."""
        return max((int(x) for x in self._list("commits") if x.isdigit()), default=0)

    def segments(self, version: int | None = None) -> dict[str, list[str]]:
        version = self.version() if version is None else version
        if not version:
            return {}
        text = self.spark.read.text(f"{self.path}/commits/{version:012d}", wholetext=True).first()[0]
        return json.loads(text)

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        parts = self.segments(version).get(table)
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.path}/tables/{table}/{p}" for p in parts]) if parts else None

    def stage(self, table: str, rows: DataFrame) -> str:
        """Write a segment that no reader sees yet."""
        segment = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/tables/{table}/{segment}")
        return segment

    def staged(self, table: str, segment: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/tables/{table}/{segment}")

    def discard(self, table: str, segment: str) -> None:
        self._fs.delete(self._hadoop.Path(f"{self.path}/tables/{table}/{segment}"), True)

    def commit(self, added: dict[str, str], base: int) -> int:
        """Make staged segments part of the store, all at once; base: the version that they
        were checked against."""
        held = self.segments(base)
        for table, segment in added.items():
            held.setdefault(table, []).append(segment)
        draft = self._hadoop.Path(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(held, sort_keys=True).encode()))
        out.close()
        marker = self._hadoop.Path(f"{self.path}/commits/{base + 1:012d}")
        self._fs.mkdirs(marker.getParent())
        if self._fs.exists(marker) or not self._fs.rename(draft, marker):
            raise Refused(f"the store went on past version {base} meanwhile")
        return base + 1

    def sweep(self) -> int:
        """Delete segments that the newest marker doesn't list; for times without writers."""
        held, n = self.segments(), 0
        for table in self._list("tables"):
            for segment in set(self._list(f"tables/{table}")) - set(held.get(table, [])):
                self.discard(table, segment)
                n += 1
        return n


def _same(left: DataFrame, right: DataFrame, mine: tuple[str, ...], theirs: tuple[str, ...]) -> Column:
    same = F.lit(True)
    for a, b in zip(mine, theirs, strict=True):
        same = same & left[a].eqNullSafe(right[b])
    return same


def _met(source: DataFrame, target: DataFrame | None, rule: TableRule) -> DataFrame:
    """One row for each source row: pair, mine, theirs (payloads), there, and both orders."""
    whole = F.struct(*rule.payload) if rule.payload else F.lit(None)
    order = F.col(rule.order) if rule.order else F.lit(None)
    pair = F.col(rule.pair) if rule.pair else F.lit(None)
    s = source.select(*rule.address, pair.alias("pair"), whole.alias("mine"), order.cast("long").alias("place"))
    if target is None:
        return s.withColumns({"theirs": F.lit(None).cast(s.schema["mine"].dataType), "there": F.lit(False), "their_place": F.lit(None).cast("long")})
    held = [F.col(a).alias(f"held_{i}") for i, a in enumerate(rule.address)]
    t = target.select(*held, whole.alias("theirs"), order.cast("long").alias("their_place"), F.lit(True).alias("there"))
    met = s.join(t, _same(s, t, rule.address, tuple(f"held_{i}" for i in range(len(held)))), "left")
    return met.drop(*[f"held_{i}" for i in range(len(held))]).withColumn("there", F.coalesce("there", F.lit(False)))


def conflicts(source: DataFrame, target: DataFrame, rule: TableRule) -> DataFrame:
    """Source rows whose address the target holds with another payload: the address, and
    the names of the columns that differ."""
    met = _met(source, target, rule).where(F.col("there") & ~F.col("mine").eqNullSafe(F.col("theirs")))
    differ = [F.when(~F.col(f"mine.{c}").eqNullSafe(F.col(f"theirs.{c}")), F.lit(c)) for c in rule.payload]
    return met.select(*rule.address, F.array_compact(F.array(*differ)).alias("differing"))


def order_conflicts(source: DataFrame, target: DataFrame, rule: TableRule, threshold: int | None) -> DataFrame:
    """Pairs that get a new row from the source although the target has written one of
    theirs after the source was taken (its order above the threshold; without a threshold
    none is known to be older): which of the two is the later can't be told."""
    new = _met(source, target, rule).where("not there").select("pair").distinct()
    latest = target.groupBy(F.col(rule.pair).alias("held_pair")).agg(F.max(rule.order).alias("latest"))
    if threshold is not None:
        latest = latest.where(F.col("latest") > threshold)
    return new.join(latest, new["pair"].eqNullSafe(latest["held_pair"])).select("pair", "latest")


def plan_fold(source: dict[str, DataFrame], store: Store, rules: list[TableRule], threshold: int | None = None) -> DataFrame:
    """One row for each table of the source; reads only. Numbers of source rows: missing
    from the target, held by it (overlap), of a repeated address, held with another
    payload (conflicts); pairs whose order can't be told; and pairs of shared rows that
    the two stores wrote in opposite orders (inversions, for information)."""
    version, out = store.version(), []
    for rule in rules:
        if rule.name not in source:
            continue
        rows, target = source[rule.name], store.read(rule.name, version)
        met = stored(_met(rows, target, rule), "met")
        differs = ~F.col("mine").eqNullSafe(F.col("theirs"))
        count = met.agg(
            F.count(F.lit(1)), F.count_if(~F.col("there")), F.count_if(F.col("there")), F.count_if(F.col("there") & differs)
        ).first()
        repeated = met.groupBy(*rule.address).count().where("count > 1").count()
        wrong = order_conflicts(rows, target, rule, threshold).count() if rule.pair and target is not None else 0
        turned = inversions(met.where("there"), "place", "their_place") if rule.order else 0
        n = target.count() if target is not None else 0
        out.append((rule.name, count[0], n, count[1], count[2], repeated, count[3], wrong, turned))
    return store.spark.createDataFrame(out, PLAN)


def _orphans(staged: dict[str, DataFrame], store: Store, version: int, rules: list[TableRule]) -> dict[str, int]:
    """For each table, the new rows that name a parent that neither store holds."""
    out = {}
    for rule in rules:
        for own, parent, theirs in rule.parents:
            if rule.name not in staged:
                continue
            sides = [x for x in (store.read(parent, version), staged.get(parent)) if x is not None]
            rows = staged[rule.name].where(" and ".join(f"`{c}` is not null" for c in own))
            for side in sides:
                keys = side.select(*[F.col(c).alias(f"held_{i}") for i, c in enumerate(theirs)])
                rows = rows.join(keys, _same(rows, keys, own, tuple(keys.columns)), "left_anti")
            n = rows.count()
            if n:
                out[f"{rule.name} -> {parent}"] = n
    return out


def apply_fold(source: dict[str, DataFrame], store: Store, rules: list[TableRule], threshold: int | None = None) -> DataFrame:
    """Fold what the target lacks into it. -> table_name, before, inserted, after. Refused,
    with the target as it was: any conflict, a repeated address, columns that the target
    lacks, rows inserted that weren't planned, parents that are nowhere, a target that
    changed meanwhile."""
    version = store.version()
    plan = plan_fold(source, store, rules, threshold).collect()
    wrong = {r["table_name"]: (r["conflicts"], r["order_conflicts"], r["repeated"]) for r in plan if r["conflicts"] + r["order_conflicts"] + r["repeated"]}
    if wrong:
        raise Refused(f"conflicts, order conflicts, repeated addresses: {wrong}")
    named, added, report = {r.name: r for r in rules}, {}, []
    try:
        for row in plan:
            rule, target = named[row["table_name"]], store.read(row["table_name"], version)
            new = source[rule.name]
            if target is not None:
                lacking = [c for c in new.columns if c not in target.columns and c not in rule.omitted]
                if lacking:
                    raise Refused(f"{rule.name}: the target has no {lacking}")
                new = new.join(target.select(*rule.address), _same(new, target, rule.address, rule.address), "left_anti")
            if rule.order in rule.omitted:
                last = target.agg(F.max(rule.order)).first()[0] if target is not None else None
                new = numbered(new.withColumnRenamed(rule.order, "source_order"), ["source_order", *rule.address], rule.order, last or 0)
                new = new.drop("source_order")
            new = new.drop(*[c for c in rule.omitted if c != rule.order])
            added[rule.name] = store.stage(rule.name, new)
            inserted = store.staged(rule.name, added[rule.name]).count()
            if inserted != row["missing"]:
                raise Refused(f"{rule.name}: {inserted} rows to insert, {row['missing']} planned")
            report.append((rule.name, row["target_rows"], inserted, row["target_rows"] + inserted))
        lost = _orphans({t: store.staged(t, s) for t, s in added.items()}, store, version, rules)
        if lost:
            raise Refused(f"rows that name a parent neither store holds: {lost}")
        store.commit(added, version)
    except BaseException:
        for table, segment in added.items():
            store.discard(table, segment)
        raise
    return store.spark.createDataFrame(report, "table_name string, before long, inserted long, after long")
