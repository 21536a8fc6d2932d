"""Cuckoo-filter index, kd-tree clustering and whitening against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stelae.llm import cuckoo, kdfilter, whitening

# --- exact duplicates


def _digests(n, seed):
    return np.random.default_rng(seed).integers(0, 1 << 63, (n, 4), np.uint64)


def test_filter_finds_all_and_forgets_what_is_deleted():
    held = _digests(3000, 1)
    one = cuckoo.CuckooFilter(1024)
    assert one.insert(held, np.arange(3000))
    assert one.candidates(held)[0].any(1).all()
    one.delete(held[:1000])
    assert one.candidates(held[1000:])[0].any(1).all() and np.count_nonzero(one.slots) == 2000
    assert one.candidates(_digests(20000, 2))[0].any(1).mean() < 0.01
    with pytest.raises(ValueError):
        one.delete(_digests(1, 3) | np.uint64(1))


def test_filter_with_equal_fingerprints_overflows_and_grows():
    held = _digests(40, 4)
    held[:, 0] = 7  # one fingerprint
    held[:, 1] = np.arange(40, dtype=np.uint64) << np.uint64(8)  # one bucket of 256
    shard = cuckoo.Shard()
    for i in range(0, 40, 5):
        shard.absorb(held[i : i + 5], np.zeros((5, 3), np.int64), np.ones(5, np.int64))
    assert shard.n == 40 and len(shard.filter.slots) > 256
    shard.absorb(held, np.zeros((40, 3), np.int64), np.ones(40, np.int64))
    assert shard.n == 40 and (shard.live[:40] == 2).all()


def test_hits_are_verified():
    held = _digests(64, 5)
    held[:, :2] = 9  # alike in all that the filter sees
    shard = cuckoo.Shard()
    shard.absorb(held[:8], np.zeros((8, 3), np.int64), np.ones(8, np.int64))
    assert shard.n == 8 and (shard._key_of(held[8:]) == -1).all()


def _normal(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).digest()


def _expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(_normal(t), []).append(i)
    return {(i, min(g, key=lambda x: (x is None, x or 0)), len(g)) for g in groups.values() for i in g}


def test_index_through_inserts_and_deletes(spark, monkeypatch):
    monkeypatch.setattr(cuckoo, "SLAB", 50)
    draw, index, held, n = random.Random(6), None, [], 0
    for _ in range(3):
        batch = []
        for _ in range(400):
            batch.append((n, draw.choice(["", None, "a b", "a  b", "a\t\nb", "hot"]) if draw.random() < 0.5 else f"text {draw.randrange(500)}"))
            n += 1
        index = cuckoo.insert(index, spark.createDataFrame(batch, "doc_id long, text string"))
        held += batch
        got = {(r.id, r.keep_id, r.group_size) for r in cuckoo.groups(index).collect()}
        assert got == _expected(held)
        gone = set(draw.sample(range(n), 150)) | {r.keep_id for r in index.keys.limit(20).collect()}
        index = cuckoo.delete(index, spark.createDataFrame([(g,) for g in gone], "doc_id long"))
        held = [x for x in held if x[0] not in gone]
        rows = cuckoo.groups(index).collect()
        assert {(r.id, r.keep_id, r.group_size) for r in rows} == _expected(held)
        assert {r.id for r in rows if r.kept} == {k for _, k, _ in _expected(held)}
        bits = sum(np.count_nonzero(np.frombuffer(r.slots, np.uint16)) for r in index.filters.collect())
        assert bits == index.keys.count() == len({_normal(t) for _, t in held})
    asked = [(1, "hot"), (2, "never seen"), (3, None), (None, "a b")]
    found = {r.id: r.live for r in cuckoo.lookup(index, spark.createDataFrame(asked, "doc_id long, text string")).collect()}
    count = lambda t: sum(_normal(x) == _normal(t) for _, x in held) or None
    assert found == {i: count(t) for i, t in asked}


def test_small_filters_grow_from_stored_keys(spark):
    """Later batches overflow filters whose keys are stored."""
    index = None
    for i in range(3):
        docs = spark.range(i * 4000, i * 4000 + 4500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 9000).alias("text"))
        index = cuckoo.insert(index, docs)
    assert index.keys.count() == 9000
    assert index.keys.agg(F.sum("live")).first()[0] == 13500
    assert index.filters.groupBy("shard").count().where("count > 1").count() == 0
    bits = sum(np.count_nonzero(np.frombuffer(r.slots, np.uint16)) for r in index.filters.collect())
    assert bits == 9000


def test_more_rows_make_more_shards(spark, monkeypatch):
    rows = [(i, f"t{i % 300}") for i in range(1000)]
    index = cuckoo.insert(None, spark.createDataFrame(rows[:400], "doc_id long, text string"))
    before = index.shards
    monkeypatch.setattr(cuckoo, "SHARD_ROWS", 50)
    index = cuckoo.insert(index, spark.createDataFrame(rows[400:], "doc_id long, text string"))
    assert index.shards > before
    assert {(r.id, r.keep_id, r.group_size) for r in cuckoo.groups(index).collect()} == _expected(rows)


def test_exact_duplicates_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "x y", 0), (3, "x y", 1), (None, "x  y", 0), (None, "z", 0), (None, "z", 0), (4, "\x0b", 0), (5, " ", 0), (6, "l " * 200000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long").withColumn("digest", F.lit("d")).withColumn("keep_id", F.lit(9))
    got = [(r.id, r.keep_id, r.group_size, r.kept) for r in cuckoo.exact_duplicates(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [
        (1, 1, 2, True), (2, 1, 2, False), (3, 3, 3, True), (3, 3, 3, False), (None, 3, 3, False), (None, None, 2, True), (None, None, 2, False),
        (4, 4, 2, True), (5, 4, 2, False), (6, 6, 1, True),
    ]))
    assert cuckoo.exact_duplicates(docs.where("false")).count() == 0


# --- clustering


def _lloyd(rows, k, rounds, scale=64):
    points = np.array([np.floor(np.array(v, np.float64) * scale) for _, v in rows]).astype(np.int64)
    first = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest(), points[i].tolist()))[:k]
    now = points[first].copy()
    for r in range(rounds + 1):
        far = ((points[:, None] - now[None]) ** 2).sum(2)
        own = far.argmin(1)
        if r < rounds:
            for c in set(own.tolist()):
                now[c] = points[own == c].sum(0) // (own == c).sum()
    return [(rows[i][0], int(own[i]), int(far[i, own[i]]), now[own[i]].tolist()) for i in range(len(rows))]


@pytest.mark.parametrize("width,spread", [(2, 0.05), (3, 0.5), (64, 0.3)])
def test_clusters_against_brute_force(spark, monkeypatch, width, spread):
    monkeypatch.setattr(kdfilter, "LEAF_ROWS", 8)
    draw = np.random.default_rng(width)
    middle = draw.normal(size=(12, width))
    points = middle[draw.integers(0, 12, 1200)] + spread * draw.normal(size=(1200, width))
    points[300:700] = points[0]  # a vector that many rows share
    points[700:720] = np.round(points[700:720])
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = kdfilter.cluster(df, width=width).collect()
    want = _lloyd(rows, 16, 3)
    assert sorted((r.id, r.cluster, r.distance, r.centroid) for r in found) == sorted(want)
    sums = {c: sum(d for _, x, d, _ in want if x == c) for c in range(16)}
    assert all(r.cluster_inertia == sums[r.cluster] and r.inertia == sum(sums.values()) for r in found)


def test_filter_prunes_and_assigns_whole_nodes():
    draw = np.random.default_rng(3)
    middle = draw.integers(-4000, 4000, (16, 3))
    points = middle[draw.integers(0, 16, 4096)] + draw.integers(-40, 40, (4096, 3))
    order, leaf = kdfilter.kd_order(points)
    points = points[order]
    parts = list(kdfilter.filter_nodes(points, leaf, middle))
    whole = sum(j - i for c, i, j, *_ in parts if c is not None)
    assert whole > 3500 and sum(j - i for _, i, j, *_ in parts) == 4096
    own, count, total, inertia = kdfilter.assign(points, leaf, middle)
    far = ((points[:, None] - middle[None]) ** 2).sum(2)
    assert (own == far.argmin(1)).all() and inertia.sum() == far.min(1).sum()
    assert (total.sum(0) == points.sum(0)).all() and count.sum() == 4096


def test_ties_go_to_the_smaller_centroid():
    points = np.array([[0, 0], [2, 0], [1, 0], [1, 5]])
    own, *_ = kdfilter.assign(points, np.zeros(4, np.int64), np.array([[2, 0], [0, 0], [2, 0]]))
    assert own.tolist() == [1, 0, 0, 0]
    big = np.array([[(1 << 26) - 1, 0], [-(1 << 26) + 1, 3]])
    own, _, _, inertia = kdfilter.assign(big, np.zeros(2, np.int64), big)
    assert own.tolist() == [0, 1] and inertia.sum() == 0


ODD_VECTORS = [
    (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [1.0]), (6, []),
    (7, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [0.5, 2.0]), (None, [3.0, 1.0]), (8, [1e300, 0.0]), (9, [-0.001, 0.0]),
]


def test_clusters_odd_rows(spark):
    df = spark.createDataFrame(ODD_VECTORS, "vec_id long, embedding array<double>").withColumn("leaf", F.lit("x")).withColumn("id", F.lit(0))
    found = kdfilter.cluster(df, width=2).collect()
    assert sorted((str(r.id), r.distance) for r in found) == [("7", 0), ("7", 0), ("7", 0), ("9", 0), ("None", 0)]
    assert next(r for r in found if r.id == 9).centroid == [-1, 0]
    assert kdfilter.cluster(df.where("false"), width=2).count() == 0


# --- whitening


def _eigen(points, k):
    n, sums = len(points), points.sum(0)
    c = points - sums / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    return c @ u[:, :k] / np.sqrt(e[:k]), e / e.sum(), [sum((n * int(x) - int(s)) ** 2 for x, s in zip(p, sums, strict=True)) for p in points]


@pytest.mark.parametrize("width,k", [(5, 5), (40, 8), (64, 32)])
def test_whitening_against_a_whole_decomposition(spark, width, k):
    draw = np.random.default_rng(width)
    values = draw.normal(size=(400, width)) * np.linspace(3, 0.3, width) @ np.linalg.qr(draw.normal(size=(width, width)))[0]
    values[50:180] = values[0]
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), 32 if k == 5 else k).toPandas()
    w, share, dev = _eigen(np.floor(values * 64).astype(np.int64) + 1_000_000, k)
    found = found.sort_values(["id", "component"])
    got = found["whitened"].to_numpy().reshape(400, k)
    assert np.abs(got * np.sign((got * w).sum(0)) - w).max() < 1e-8
    assert np.allclose(found["explained"].to_numpy()[:k], share[:k], rtol=1e-9)
    assert found["deviation"].tolist()[::k] == dev and found["identity_error"].max() < 1e-9 and set(found["n"]) == {400}


def test_lobpcg_in_many_dimensions():
    draw = np.random.default_rng(1)
    q = np.linalg.qr(draw.normal(size=(300, 300)))[0]
    values = 1 / np.arange(1, 301.0)
    values[5] = values[6] = values[7]  # one value three times
    matrix, asked = q * values @ q.T, []

    def product(block):
        asked.append(block.shape[1])
        return matrix @ block

    e, u, size = whitening.leading_eigenvectors(product, 300, 10)
    assert np.allclose(e, np.sort(values)[::-1][:10], rtol=1e-12) and size < 1e-11
    assert np.abs(u.T @ u - np.eye(10)).max() < 1e-12 and max(asked) <= 2 * (10 + whitening.GUARD)


def test_whitening_odd_rows(spark):
    odd = [r for r in ODD_VECTORS if r[0] != 8] + [(10, [4.0, 7.0])]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>").withColumn("component", F.lit("x")).withColumn("id", F.lit(0))
    found = whitening.whiten(df, 32).collect()
    points = np.array([[64, 128], [64, 128], [32, 128], [192, 64], [-1, 0], [256, 448]])
    assert sorted(r.deviation for r in found if r.component == 1) == sorted(_eigen(points, 2)[2])
    assert len(found) == 12 and sum(r.id is None for r in found) == 2
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")
    assert whitening.whiten(same, 2).count() == 0
    line = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(line, 2).groupBy("component").count().collect() == [(1, 3)]
    assert whitening.whiten(df.where("false"), 32).count() == 0


def test_deviations_beyond_a_long():
    points = np.array([[1 << 39, 5], [-(1 << 39), 7]])
    centre = whitening.Centre(2, points.sum(0).tolist())
    assert centre.deviations(points) == [(1 << 80) + 4, (1 << 80) + 4]


# --- suffix dedup: phrases of one trigger


def test_phrases_that_share_40_bits_of_one_hash_stay(spark):
    """Two texts without a common 50-byte string, whose phrases agree in the trigger and in
    40 bits of their first hash."""
    from stelae.llm import suffix_dedup

    texts = [
        "neyjceiixtenbqfmwepijdklrmyyfjplskivnwktbfvittcsunyosjfvqhiphqukqfnupvgwpmtqdidr",
        "avxoiodpvgiqpvupqlnktcdqzmvqkvplskivnwktbfvittcsunaontqihgxdwsjavuefhfhewhvyqhus",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.spans for r in suffix_dedup.remove_repeats(docs).collect()] == [[], []]


def test_phrase_hashes_are_independent():
    from stelae.llm import suffix_dedup

    data = np.random.default_rng(9).integers(97, 101, 200_000).astype(np.uint8)
    at = np.arange(0, 199_900)
    one = suffix_dedup._phrase_hash(suffix_dedup.Rolling(data), at, at + 20, at + 3, 50)
    two = suffix_dedup.second_hash(data, at, at + 20, at + 3)
    assert len(np.unique(one)) == len(np.unique(two)) == len(at)
    assert ((one & np.uint64(0xFFFF)) == (two & np.uint64(0xFFFF))).mean() < 0.0002


# --- WARC records of other writers


def test_records_of_other_writers(spark):
    import gzip
    import os

    from stelae.llm import warc
    from stelae.runtime import new_shared_path

    def record(kind, block, *fields):
        head = "".join(f"{f}\r\n" for f in (f"WARC-Type: {kind}", *fields, f"Content-Length: {len(block)}"))
        return gzip.compress(b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n")

    body = b"<p>hello</p>"
    members = [
        record("warcinfo", b"software: x\r\n"), record("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n"),
        record("response", b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\n" + body, "WARC-Record-ID: <urn:uuid:1>", "warc-target-uri:http://h/", "WARC-Payload-Digest: sha1:ABC"),
        record("response", b"HTTP/1.1 200 OK\r\nContent-Length: 99\r\n\r\n" + body, "WARC-Record-ID: <urn:uuid:2>"),
        record("resource", body, "WARC-Record-ID: <urn:uuid:3>", "WARC-Target-URI: ftp://h/"), record("metadata", b"a: b"),
        record("revisit", b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\n", "WARC-Record-ID: <urn:uuid:4>", "WARC-Refers-To: <urn:uuid:1>"), record("conversion", b""),
    ]
    path = new_shared_path(spark, "foreign")
    os.makedirs(path.removeprefix("file://"))
    with open(f"{path.removeprefix('file://')}/part-0.gz", "wb") as out:
        out.write(b"".join(members))
    for size in (4 << 20, 100):
        rows = warc.read_archive(spark, path, size).collect()
        digest = hashlib.sha256(body).hexdigest()
        assert sorted((r.record_type, r.url or "", r.payload_bytes, r.payload_digest or "") for r in rows) == [
            ("resource", "ftp://h/", 12, digest), ("response", "", 12, digest), ("response", "http://h/", 12, digest), ("revisit", "", 0, ""),
        ]
        assert {r.page_id for r in rows} == {None} and {bytes(r.payload) for r in rows if r.payload is not None} == {body}


def test_short_payloads_stay_out_of_the_join(spark, monkeypatch):
    from stelae.llm import warc

    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    rows = [(i, None, "x" if i % 2 else "y" * 100) for i in range(40)] + [(None, None, None)]
    found = warc.with_revisits(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert found.count() == 41
    assert {r.refers_to for r in found.collect() if len(r.payload) == 100 and r.page_id} == {0}
    assert all(r.refers_to is None for r in found.collect() if len(r.payload) < 100)


# --- near duplicates of crowded shingles


def test_a_crowd_of_near_copies_against_brute_force(spark, monkeypatch):
    """Many documents share one passage and differ elsewhere, so that shingles join more
    components than there are hubs."""
    from stelae.llm import simhash

    monkeypatch.setattr(simhash, "HUBS", 2)
    draw = random.Random(12)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    base, rows = [word() for _ in range(120)], {}
    for i in range(60):
        words = list(base)
        for _ in range(draw.randint(0, 9)):
            words[draw.randrange(len(words))] = word()
        rows[i] = " ".join(words)
    for i in range(60, 75):
        rows[i] = " ".join([*base[:40], *(word() for _ in range(draw.randint(5, 60)))])
    sets = {k: {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in ((k, t.split()) for k, t in rows.items())}
    root = {k: k for k in rows}
    for a in rows:
        for b in rows:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root[a], root[b]))
                root = {k: x if r == y else r for k, r in root.items()}
    assert len(set(root.values())) > 5
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == root
