"""Exact duplicates by an index of cuckoo filters.

Texts are equal when their SHA-256 is, taken after every run of ASCII white space has
become one space. Digests are dealt to shards by hash. A shard has a cuckoo filter
(buckets of four 16-bit fingerprints, a second bucket found from the first and the
fingerprint alone) and the keys behind it, bucketed like the filter: a fingerprint that
is met counts as a duplicate only if the whole stored digest is the same, otherwise the
digest is new. A filter that can't place a fingerprint is made again, twice as large,
from the stored keys.

``insert`` adds rows, ``delete`` takes rows out by id (a digest leaves the filter with
its last row), ``lookup`` asks which texts are held. Each writes new tables and leaves
the given index as it was, so a lost executor or a failed job costs only its own work.

Before digests are dealt to shards, each task runs the same index over its own rows, so
that a text of which a third of all rows are copies comes to its shard once for each
``SLAB`` distinct digests of a task.

Defined results: null texts count as empty and empty texts equal each other; of equal
texts the least id stays, null ids come last, and of rows that repeat an id and a text
one stays; texts are read whole; an empty table gives no rows; further columns are
ignored. Ids are cast to long.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stelae.runtime import ship_package, stored

#: Distinct digests that a task holds before it hands them on; rows of a shard, about.
SLAB, SHARD_ROWS = 1 << 17, 1 << 20
SLOTS, KICKS, FULL = 4, 200, 0.95
KEY = "shard int, digest binary, absent boolean, keep_id long, keep_row long, live long"
FILTER = "shard int, slots binary"


class CuckooFilter:
    """Fingerprints of digests (arrays of four uint64 each); ``rows`` has, for each slot,
    the place of the key that it stands for, or -1 where that is not at hand."""

    def __init__(self, buckets: int = 256, slots: np.ndarray | None = None):
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots.copy()
        self.rows = np.full(self.slots.shape, -1, np.int64)

    @staticmethod
    def fingerprints(digests: np.ndarray) -> np.ndarray:
        return np.maximum(digests[:, 0] & np.uint64(0xFFFF), 1).astype(np.uint16)

    def first_bucket(self, digests: np.ndarray) -> np.ndarray:
        return (digests[:, 1] & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def other_bucket(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (prints.astype(np.int64) * 0x5BD1E995 & len(self.slots) - 1)

    def candidates(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """-> which of the eight slots of each digest have its fingerprint, and their rows."""
        prints, one = self.fingerprints(digests), self.first_bucket(digests)
        two = self.other_bucket(one, prints)
        met = np.concatenate([self.slots[one], self.slots[two]], 1) == prints[:, None]
        return met, np.concatenate([self.rows[one], self.rows[two]], 1)

    def insert(self, digests: np.ndarray, rows: np.ndarray) -> bool:
        """False: some fingerprint has no place, and the filter has to be made again."""
        if np.count_nonzero(self.slots) + len(digests) > FULL * self.slots.size:
            return False
        prints = self.fingerprints(digests)
        bucket = self.first_bucket(digests)
        for turn in range(KICKS):
            for _ in range(2):
                order = np.argsort(bucket, kind="stable")
                prints, bucket, rows = prints[order], bucket[order], rows[order]
                start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
                nth = np.arange(len(bucket)) - np.repeat(start, np.diff(np.r_[start, len(bucket)]))
                free = np.argsort(self.slots[bucket] != 0, axis=1, kind="stable")
                fits = nth < (self.slots[bucket] == 0).sum(1)
                slot = free[np.arange(len(bucket)), np.minimum(nth, SLOTS - 1)]
                self.slots[bucket[fits], slot[fits]] = prints[fits]
                self.rows[bucket[fits], slot[fits]] = rows[fits]
                prints, bucket, rows, nth = prints[~fits], bucket[~fits], rows[~fits], nth[~fits]
                if not len(prints):
                    return True
                bucket = self.other_bucket(bucket, prints)
            # One of each bucket takes the place of another, which goes to its own other bucket.
            _, kick = np.unique(bucket, return_index=True)
            at, slot = bucket[kick], (turn + rows[kick]) % SLOTS
            out, out_rows = self.slots[at, slot].copy(), self.rows[at, slot].copy()
            self.slots[at, slot], self.rows[at, slot] = prints[kick], rows[kick]
            prints[kick], rows[kick] = out, out_rows
            bucket[kick] = self.other_bucket(at, out)
        return False

    def delete(self, digests: np.ndarray) -> None:
        """Take out digests that were inserted, one fingerprint for each."""
        prints, one = self.fingerprints(digests), self.first_bucket(digests)
        while len(prints):
            two = self.other_bucket(one, prints)
            # Of those that could mean the same slot, one at a time.
            _, first = np.unique(np.minimum(one, two) << 16 | prints, return_index=True)
            left = np.ones(len(prints), bool)
            left[first] = False
            for buckets in (one, two):
                bucket = buckets[first]
                met = self.slots[bucket] == prints[first][:, None]
                held = met.any(1)
                slot = met.argmax(1)
                self.slots[bucket[held], slot[held]] = 0
                self.rows[bucket[held], slot[held]] = -1
                first = first[~held]
            if len(first):
                raise ValueError("a digest to delete is not in the filter")
            prints, one = prints[left], one[left]


class Shard:
    """A filter and the keys put behind it here; ``old`` is a stored filter whose keys
    are elsewhere and have been compared already."""

    def __init__(self, old: np.ndarray | None = None):
        self.filter = CuckooFilter() if old is None else CuckooFilter(slots=old)
        self.whole = old is None  # all keys of the filter are at hand
        self.overflowed = False
        self.n = 0
        self.digests = np.empty((256, 4), np.uint64)
        self.least = np.empty((256, 3), np.int64)  # absent, id, row
        self.live = np.empty(256, np.int64)

    def _store(self, digests: np.ndarray, least: np.ndarray, live: np.ndarray) -> np.ndarray:
        n = self.n + len(digests)
        if n > len(self.live):
            more = max(n, 2 * len(self.live))
            for name in ("digests", "least", "live"):
                old = getattr(self, name)
                new = np.empty((more, *old.shape[1:]), old.dtype)
                new[: self.n] = old[: self.n]
                setattr(self, name, new)
        at = np.arange(self.n, n)
        self.digests[at], self.least[at], self.live[at], self.n = digests, least, live, n
        return at

    def _put(self, digests: np.ndarray, least: np.ndarray, live: np.ndarray) -> None:
        at = self._store(digests, least, live)
        if self.filter.insert(digests, at):
            return
        if not self.whole:  # the larger filter is made from the stored keys, later
            self.whole = self.overflowed = True
        buckets = len(self.filter.slots)
        while True:
            buckets *= 2
            self.filter = CuckooFilter(buckets)
            if self.filter.insert(self.digests[: self.n], np.arange(self.n)):
                return

    def _key_of(self, digests: np.ndarray) -> np.ndarray:
        """The key that is the same as each digest, or -1."""
        met, rows = self.filter.candidates(digests)
        met &= rows >= 0
        key = np.full(len(digests), -1, np.int64)
        who, slot = np.nonzero(met)
        near = rows[who, slot]
        same = (self.digests[near] == digests[who]).all(1)
        key[who[same]] = near[same]
        return key

    def absorb(self, digests: np.ndarray, least: np.ndarray, live: np.ndarray) -> None:
        while len(digests):
            key = self._key_of(digests)
            hit = key >= 0
            if hit.any():
                at, mine = key[hit], least[hit]
                np.add.at(self.live, at, live[hit])
                order = np.lexsort((mine[:, 2], mine[:, 1], mine[:, 0], at))
                at, mine = at[order], mine[order]
                first = np.r_[True, at[1:] != at[:-1]]
                at, mine = at[first], mine[first]
                held = self.least[at]
                less = np.where(mine[:, 0] != held[:, 0], mine[:, 0] < held[:, 0],
                                np.where(mine[:, 1] != held[:, 1], mine[:, 1] < held[:, 1], mine[:, 2] < held[:, 2]))
                self.least[at[less]] = mine[less]
            digests, least, live = digests[~hit], least[~hit], live[~hit]
            # Of equal digests one goes in, the others are asked for again.
            _, new = np.unique(digests[:, 0] ^ digests[:, 1] << np.uint64(16), return_index=True)
            self._put(digests[new], least[new], live[new])
            left = np.ones(len(digests), bool)
            left[new] = False
            digests, least, live = digests[left], least[left], live[left]

    def keys(self, shard: int) -> Iterator[pa.RecordBatch]:
        for i in range(0, self.n, 8192):
            j = min(self.n, i + 8192)
            raw, least = self.digests[i:j].tobytes(), self.least[i:j]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(np.full(j - i, shard, np.int32)),
                "digest": pa.array([raw[32 * k : 32 * k + 32] for k in range(j - i)], pa.binary()),
                "absent": pa.array(least[:, 0].astype(bool)), "keep_id": pa.array(least[:, 1]),
                "keep_row": pa.array(least[:, 2]), "live": pa.array(self.live[i:j]),
            })


def _digests(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 4)


def _numbers(batch: pa.RecordBatch, *names: str) -> np.ndarray:
    return np.stack([batch.column(n).cast(pa.int64()).to_numpy(zero_copy_only=False) for n in names], 1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The parts of each batch that belong to one shard; equal shards are neighbours."""
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if i < j:
                yield int(shard[i]), batch.slice(i, j - i)


def _in_slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slab = Shard()
    for batch in batches:
        slab.absorb(_digests(batch.column("digest")), _numbers(batch, "absent", "id", "row"), np.ones(len(batch), np.int64))
        if slab.n >= SLAB:
            yield from slab.keys(0)
            slab = Shard()
    yield from slab.keys(0)


def _slots(batch: pa.RecordBatch) -> np.ndarray | None:
    raw = batch.column("slots")[0].as_py()
    return None if raw is None else np.frombuffer(raw, np.uint16).reshape(-1, SLOTS)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters come before the keys of their shard. -> keys, and the filter of each shard
    that got any, without slots where it has to be made from the stored keys."""
    number, shard = None, None

    def done():
        for keys in shard.keys(number):
            yield keys.append_column("slots", pa.nulls(len(keys), pa.binary()))
        raw = None if shard.overflowed else shard.filter.slots.tobytes()
        row = {"shard": pa.array([number], pa.int32()), "slots": pa.array([raw], pa.binary())}
        for name, kind in (("digest", pa.binary()), ("absent", pa.bool_()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("live", pa.int64())):
            row[name] = pa.nulls(1, kind)
        names = ["shard", "digest", "absent", "keep_id", "keep_row", "live", "slots"]
        yield pa.RecordBatch.from_arrays([row[x] for x in names], names)

    for at, piece in _pieces(batches):
        if at != number:
            if shard is not None and shard.n:
                yield from done()
            number, shard = at, None
        if not piece.column("kind")[0].as_py():
            shard, piece = Shard(_slots(piece)), piece.slice(1)
        if len(piece):
            shard = shard or Shard()
            shard.absorb(_digests(piece.column("digest")), _numbers(piece, "absent", "keep_id", "keep_row"), _numbers(piece, "live")[:, 0])
    if shard is not None and shard.n:
        yield from done()


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """-> the rows that come after their shard's filter, with ``met``: the filter has
    the digest, or one that looks like it."""
    number, held = None, None
    for at, piece in _pieces(batches):
        if at != number:
            number, held = at, None
        if not piece.column("kind")[0].as_py():
            held, piece = CuckooFilter(slots=_slots(piece)), piece.slice(1)
        if len(piece):
            met = np.zeros(len(piece), bool) if held is None else held.candidates(_digests(piece.column("digest")))[0].any(1)
            yield piece.drop_columns(["slots", "kind"]).append_column("met", pa.array(met))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, held = None, None

    def row():
        return pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int32()), "slots": pa.array([held.slots.tobytes()], pa.binary())})

    for at, piece in _pieces(batches):
        if at != number:
            if held is not None:
                yield row()
            number, held = at, None
        if not piece.column("kind")[0].as_py():
            held, piece = CuckooFilter(slots=_slots(piece)), piece.slice(1)
        if len(piece):
            held.delete(_digests(piece.column("digest")))
    if held is not None:
        yield row()


@dataclass(frozen=True)
class DigestIndex:
    """Stored tables: members (id, absent, row, digest, shard), one row for each document
    held; keys, one for each distinct digest, with the row that stays and the number of
    rows; filters, one for each shard with keys."""

    members: DataFrame
    keys: DataFrame
    filters: DataFrame
    shards: int


def document_digests(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> id, absent, row (any number, told apart), digest (32 bytes), shard; stored, so
    that the numbers hold."""
    # A single space would become itself.
    clean = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")
    known = F.col(id_col).cast("long")
    rows = docs.select(
        F.coalesce(known, F.lit(0)).alias("id"), known.isNull().alias("absent"), F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(clean, 256)).alias("digest"),
    )
    return stored(_sharded(rows, shards), "digests")


def _sharded(rows: DataFrame, shards: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def _after_filters(rows: DataFrame, filters: DataFrame | None, shards: int) -> DataFrame:
    """rows, with the filter of each shard in front of the shard's rows."""
    rows = rows.withColumns({"slots": F.lit(None).cast("binary"), "kind": F.lit(1)})
    if filters is not None:
        own = filters.join(rows.select("shard").distinct(), "shard", "left_semi").withColumn("kind", F.lit(0))
        rows = rows.unionByName(own, allowMissingColumns=True)
    return rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind")


def _filters_of(keys: DataFrame, shards: int) -> DataFrame:
    """Filters made from stored keys."""
    made = _after_filters(keys, None, shards).mapInArrow(_merge, f"{KEY}, slots binary")
    return made.where("slots is not null").select("shard", "slots")


def insert(index: DigestIndex | None, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DigestIndex:
    """The index with the rows of docs added; None: an empty one."""
    spark = docs.sparkSession
    ship_package(spark)
    least_shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = index.shards if index else least_shards
    rows = document_digests(docs, shards, id_col, text_col)
    n = rows.count() + (index.members.count() if index else 0)
    if n > 2 * shards * SHARD_ROWS or index is None:
        shards = max(least_shards, -(-n // SHARD_ROWS))
        rows = _sharded(rows, shards)
        if index:  # more shards: the stored keys make their filters
            keys = stored(_sharded(index.keys, shards), "keys")
            index = DigestIndex(_sharded(index.members, shards), keys, stored(_filters_of(keys, shards), "filters"), shards)
    rows = rows.withColumn("row", F.xxhash64("row", F.lit(uuid.uuid4().hex)))  # not that of an earlier batch
    new = _sharded(rows.mapInArrow(_in_slabs, KEY), shards)
    if index is None:
        made = stored(_after_filters(new, None, shards).mapInArrow(_merge, f"{KEY}, slots binary"), "index")
        return DigestIndex(rows, made.where("digest is not null").drop("slots"), made.where("digest is null").select("shard", "slots"), shards)
    asked = stored(_after_filters(new, index.filters, shards).mapInArrow(_probe, f"{KEY}, met boolean"), "asked")
    known = asked.where("met").drop("met").join(index.keys.select("shard", "digest"), ["shard", "digest"], "left_semi")
    known = stored(known, "known")
    fresh = asked.drop("met").join(known.select("shard", "digest"), ["shard", "digest"], "left_anti")
    made = stored(_after_filters(fresh, index.filters, shards).mapInArrow(_merge, f"{KEY}, slots binary"), "index")
    least = F.min(F.struct("absent", "keep_id", "keep_row")).alias("least")
    again = index.keys.join(known.select("shard", "digest"), ["shard", "digest"], "left_semi").unionByName(known)
    again = again.groupBy("shard", "digest").agg(least, F.sum("live").alias("live")).select("shard", "digest", "least.*", "live")
    keys = index.keys.join(known.select("shard", "digest"), ["shard", "digest"], "left_anti").unionByName(again)
    keys = stored(keys.unionByName(made.where("digest is not null").drop("slots")), "keys")
    changed = made.where("digest is null").select("shard", "slots")
    full = changed.where("slots is null").select("shard")
    made_again = _filters_of(keys.join(full, "shard", "left_semi"), shards)
    filters = index.filters.join(changed, "shard", "left_anti").unionByName(changed.where("slots is not null")).unionByName(made_again)
    return DigestIndex(index.members.unionByName(rows), keys, stored(filters, "filters"), shards)


def delete(index: DigestIndex, ids: DataFrame, id_col: str = "doc_id") -> DigestIndex:
    """The index without the rows of these ids; ids that it doesn't hold, and null ones,
    take nothing out."""
    ids = ids.select(F.col(id_col).cast("long").alias("id")).where("id is not null").withColumn("absent", F.lit(False)).distinct()
    gone = stored(index.members.join(ids, ["id", "absent"], "left_semi").select("shard", "digest").distinct(), "gone")
    members = stored(index.members.join(ids, ["id", "absent"], "left_anti"), "digests")
    least = F.min(F.struct("absent", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"))).alias("least")
    left = members.join(gone, ["shard", "digest"], "left_semi").groupBy("shard", "digest").agg(least, F.count(F.lit(1)).alias("live"))
    left = stored(left.select("shard", "digest", "least.*", "live"), "left")
    dead = gone.join(left, ["shard", "digest"], "left_anti")
    changed = _after_filters(dead, index.filters, index.shards).mapInArrow(_remove, FILTER)
    changed = stored(changed, "filters")
    keys = stored(index.keys.join(gone, ["shard", "digest"], "left_anti").unionByName(left), "keys")
    filters = index.filters.join(changed, "shard", "left_anti").unionByName(changed)
    return replace(index, members=members, keys=keys, filters=filters)


def lookup(index: DigestIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> id, keep_id (of the row that the index keeps for this text), live (rows that it
    holds): one row for each of docs; both null where the text is not held."""
    ship_package(docs.sparkSession)
    rows = document_digests(docs, index.shards, id_col, text_col)
    asked = _after_filters(rows, index.filters, index.shards)
    met = stored(asked.mapInArrow(_probe, "id long, absent boolean, row long, digest binary, shard int, met boolean"), "asked")
    found = met.where("met").join(index.keys.drop("absent"), ["shard", "digest"]).select("row", "keep_id", "live")
    return met.join(found, "row", "left").select(F.when(~F.col("absent"), F.col("id")).alias("id"), "keep_id", "live")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> id, keep_id, group_size, kept, digest: one row for each of docs."""
    return groups(insert(None, docs, id_col, text_col))


def groups(index: DigestIndex) -> DataFrame:
    """-> id, keep_id, group_size, kept, digest: one row for each document held."""
    keys = index.keys.select("digest", F.when(~F.col("absent"), F.col("keep_id")).alias("keep_id"), "keep_row", F.col("live").alias("group_size"))
    rows = index.members.join(keys, "digest")
    known = F.when(~F.col("absent"), F.col("id"))
    kept = ((F.col("row") == F.col("keep_row")) & known.eqNullSafe(F.col("keep_id"))).alias("kept")
    return rows.select(known.alias("id"), "keep_id", "group_size", kept, "digest")
