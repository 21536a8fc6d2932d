"""Corpus operators against brute force, round trips and held-out rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stelae.llm import bpe, chat, components, covertree, iblt, packing, quality, queries, simhash, suffix_dedup, toxicity, warc
from stelae.llm.components import connected_components
from stelae.runtime import new_shared_path
from tests.conftest import rows_of

ODD_TEXTS = [
    (1, None, "x"), (2, "", "x"), (3, "word", "x"), (3, "word", "x"), (4, "long " * 9000, "x"), (5, "long " * 9000, "x"),
    (6, "a\tb\nc d", "x"), (None, "no id", "x"), (7, "né ß 你好 \U0001f600 it's 's", "x"),
]
SCHEMA = "doc_id long, text string, score string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_TEXTS, SCHEMA)


@pytest.fixture(scope="module")
def texts(small):
    table = pq.read_table(f"{small}/documents.parquet")
    return dict(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(name, spark, small, oracle):
    got = rows_of(queries.queries()[name](spark, small).toPandas())
    assert got == rows_of(oracle.execute(queries.oracle_sql()[name]).fetchdf())


# --- SimHash


def test_simhash_against_brute_force(spark, small, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, small).collect()}
    from xxhash import xxh64_intdigest

    prints = {}
    for k, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[k] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert got == {k: (f"{prints[k]:016x}", find(k)) for k in keys}


def test_links_lose_no_pair(spark):
    draw = random.Random(3)
    base = [draw.getrandbits(64) for _ in range(40)]
    points = sorted({b ^ sum(1 << i for i in draw.sample(range(64), draw.randint(0, 4))) for b in base for _ in range(6)})
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()}
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    assert got == want


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in connected_components(links, "a", "b").collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def _jobs(spark, run):
    """What run() gives, and how many jobs it took."""
    context = spark.sparkContext
    group = f"counted-{random.random()}"
    context.setJobGroup(group, group)
    try:
        return run(), len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("at_once", [7, 50, None])
def test_components_in_any_stretches(spark, monkeypatch, at_once):
    """Against a plain search; few links take no rounds."""
    draw = random.Random(3)
    pairs = [(draw.randrange(-150, 150), draw.randrange(-150, 150)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)]
    root = {n: n for pair in pairs for n in pair}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    links = spark.createDataFrame(pairs, "a long, b long")
    if at_once:
        monkeypatch.setattr(components, "LINKS_AT_ONCE", at_once)
    got, jobs = _jobs(spark, lambda: connected_components(links, "a", "b").collect())
    assert sorted((r.node, r.root) for r in got) == sorted((n, r) for n, r in root.items() if any(n in p and p[0] != p[1] for p in pairs))
    assert at_once or jobs <= 5


def test_simhash_odd_rows(spark, odd):
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(odd).collect()]
    assert len(got) == len(ODD_TEXTS)
    assert {c for d, f, c in got if d in (1, 2)} == {1} and {f for d, f, c in got if d in (1, 2)} == {0}
    assert {c for d, f, c in got if d in (4, 5)} == {4}
    assert simhash.near_duplicates(odd.where("false")).count() == 0


def test_similar_texts_far_apart_in_bits(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    common, rows = " ".join(word() for _ in range(30)), {}
    for i in range(25):
        words = [word() for _ in range(150)]
        for j in range(4):
            edited = list(words)
            for _ in range(2 * j):
                edited[draw.randrange(len(edited))] = word()
            rows[100 * i + j] = " ".join(edited)
        rows[100 * i + 50] = f"{common} {' '.join(word() for _ in range(draw.randint(1, 60)))}"
    sets = {k: {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in ((k, t.split()) for k, t in rows.items())}
    root, far = {k: k for k in rows}, 0
    for a in rows:
        for b in rows:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                far += bin(simhash.fingerprint(rows[a]) ^ simhash.fingerprint(rows[b])).count("1") > 3
                x, y = sorted((root[a], root[b]))
                root = {k: x if r == y else r for k, r in root.items()}
    assert far > 20
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == root


def test_near_duplicates_start_from_fingerprints(spark, monkeypatch):
    draw, seen = random.Random(21), []
    grid = simhash.links
    monkeypatch.setattr(simhash, "links", lambda points, radius=3: seen.append(grid(points, radius).collect()) or grid(points, radius))
    words = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(400)]
    first, edits = " ".join(words), (" ".join([*words[:-1], f"other{i}"]) for i in range(300))
    bits = lambda t: bin(simhash.fingerprint(first, simhash.WIDE_SHINGLE) ^ simhash.fingerprint(t, simhash.WIDE_SHINGLE)).count("1")
    texts = {1: first, 2: next(t for t in edits if 1 <= bits(t) <= 3), 3: " ".join([*words[:200], *words[:200:-1]])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    prints = {k: simhash.fingerprint(t, simhash.WIDE_SHINGLE) for k, t in texts.items()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert [{r.a & (2**64 - 1), r.b & (2**64 - 1)} for r in seen[0]] == [{prints[1], prints[2]}]


def test_pairs_of_close_fingerprints(spark):
    prints = [0, 0, 0, 7, 15, 1 << 63, -1, -1]
    sets = spark.createDataFrame([(p - (1 << 64) if p >> 63 == 1 else p, i, 10 + i) for i, p in enumerate(prints)], "fp long, node long, n long")
    got = {(*sorted((r.a, r.b)), r.na - r.a, r.nb - r.b) for r in simhash.close_prints(sets).collect()}
    assert got == {(0, 1, 10, 10), (0, 2, 10, 10), (0, 3, 10, 10), (3, 4, 10, 10), (0, 5, 10, 10), (6, 7, 10, 10)}


def test_texts_perhaps_wanted(spark, monkeypatch):
    rows = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.xxhash64("id").alias("one"))
    wanted = rows.where("id % 100 = 0 or id is null")
    for bits, most in ((24, 32), (6, 3000)):
        monkeypatch.setattr(simhash, "FILTER_BITS", bits)
        got = simhash._perhaps_wanted(rows, wanted, ["id", "one"])
        assert got.columns == rows.columns and got.count() <= most and wanted.join(got, "one", "left_anti").count() == 0


# --- Packing


def test_packing_is_gapless_and_near_its_bound(spark, small, texts):
    from tokenizers import Tokenizer

    rows = queries.op2_packing(spark, small).toPandas()
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for k, t in texts.items():
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4")
        own = rows[rows.doc_id == k].sort_values("piece")
        assert own.length.sum() == len(ids) and (own.length.iloc[:-1] == 4096).all()
        for r in own.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    for _, own in rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert own.length.sum() <= 4096
        assert (own.offset.to_numpy() == np.r_[0, np.cumsum(own.length)[:-1]]).all()
    assert rows.sequence_id.nunique() <= packing.lower_bound(rows.length.to_numpy(), 4096) + 1


def test_known_words_are_not_encoded_again(monkeypatch):
    path, spelled = P.path("word_bpe_49k.json"), []

    class Counting:
        def __init__(self, model):
            self.model = model

        def tokenize(self, word):
            spelled.append(word)
            return self.model.tokenize(word)

    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    words = packing.WordTokenizer(path)
    words.model = Counting(words.model)
    for i in range(40):
        text = f"Straßen, straßen STRASSEN the The the, (the) the... " + " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[j]}{'uvwxyz'[i // 7]}" for j in range(10))
        assert np.frombuffer(words(text), "<u4").tolist() == words.whole.encode(text, add_special_tokens=False).ids
    assert len(spelled) <= 403 and spelled.count("the") == 1
    assert len(words.cache) + len(words.older) <= 2 * (50 + 20)


def test_texts_of_a_slab_are_encoded_together(monkeypatch):
    path, spelled = P.path("word_bpe_49k.json"), []

    class Counting:
        def __init__(self, model):
            self.model = model

        def tokenize(self, word):
            spelled.append(word)
            return self.model.tokenize(word)

    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    monkeypatch.setattr(packing, "SLAB_BYTES", 4000)
    words = packing.WordTokenizer(path)
    words.model = Counting(words.model)
    # Far more words than the cache holds, all of them in the first and in the second half of the texts.
    drawn = [f"É{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvw"]
    odd = ["", " ", "\x0b\x0cx\r\ny \t", "ÿ... ß!? ...", "e\u0301té, é\u0301", "a\x1cb\x85c\u2028d", "<|endoftext|>.", "It's x-y-- 12,", "naïve" * 2000]
    texts = pa.array([*(" ".join(f"{w}{'.,'[i % 2]}" for w in drawn[i % 10 :: 10]) for i in range(20)), *odd])
    assert packing.slabs(texts[:0]) == [] and packing.slabs(pa.array(["", ""])) == [(0, 2)]
    held = packing.slabs(texts)
    assert [i for a, b in held for i in range(a, b)] == list(range(len(texts))) and 2 < len(held) < 10
    want = [words.whole.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    assert [np.frombuffer(x, "<u4").tolist() for a, b in held for x in words.encode(texts[a:b])] == want
    spelled.clear()
    words.cache, words.older = {}, {}
    assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts)] == want
    assert len(spelled) == len(set(spelled))


def test_tokens_of_odd_texts():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    whole, words = Tokenizer.from_file(path), packing.WordTokenizer(path)
    draw = random.Random(5)
    alphabet = "aBé Éß'sltdrevm12½,.!?-\n\t\x1c\x85 ̈你İ<|>"
    for text in ["", "It's", "<|endoftext|>", "x<|endoftext|>y z", *("".join(draw.choices(alphabet, k=30)) for _ in range(800))]:
        assert np.frombuffer(words(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_lower_bound_holds_and_bites():
    assert packing.lower_bound(np.array([60] * 5), 100) == 5
    assert packing.lower_bound(np.array([], int), 100) == 0
    draw = np.random.default_rng(1)
    for _ in range(50):
        sizes = draw.integers(1, 101, 40)
        bins, offsets, fill = packing.best_fit_decreasing(sizes, 100)
        assert packing.lower_bound(sizes, 100) <= len(fill) and fill.max() <= 100
        assert (np.bincount(bins, sizes) == fill).all()


def test_packing_fills_the_room_of_all_partitions(spark):
    rows = [(i, 0, 0, 2500 if i % 2 else 1596, i) for i in range(12_000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(pieces).toPandas()
    assert sorted(got.doc_id) == list(range(12_000)) and (got.groupby("sequence_id").length.sum() <= 4096).all()
    for _, own in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert (own.offset.to_numpy() == np.r_[0, np.cumsum(own.length)[:-1]]).all()
    assert got.sequence_id.nunique() == 6000 and got.certified.all()


def test_packing_odd_rows(spark, odd):
    path = P.path("word_bpe_49k.json")
    rows = packing.pack(packing.token_pieces(odd, path)).toPandas()
    assert rows.groupby("doc_id", dropna=False).piece.nunique().to_dict()[4.0] == -(-9001 // 4096)
    assert rows[rows.doc_id == 1].length.tolist() == [1] and (rows.doc_id == 3).sum() == 2
    assert packing.pack(packing.token_pieces(odd.where("false"), path)).count() == 0


def test_packing_keeps_large_ids_beside_null(spark):
    big = (1 << 53) + 1
    docs = spark.createDataFrame([(big, "a text"), (None, "no id"), (big + 2, None)], "doc_id long, text string")
    rows = packing.pack(packing.token_pieces(docs, P.path("word_bpe_49k.json"))).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted([str(big), "None", str(big + 2)])


# --- Suffix-array dedup


def test_window_order_by_hand():
    draw = np.random.default_rng(5)
    texts = [bytes(draw.integers(97, 99, draw.integers(6, 40)).astype(np.uint8)) for _ in range(60)]
    key = np.arange(60) // 2
    data, owner, lo, hi, place, _, _ = suffix_dedup.parse(texts, span=6, gram=3)
    begins = np.cumsum([0, *map(len, texts)])
    which, start = suffix_dedup.order_windows(data, lo, place - lo, hi - lo + 6, key[owner], span=6, gram=3)
    got = sorted(zip(owner[which].tolist(), (lo[which] + start - begins[owner[which]]).tolist(), strict=True))
    first = {}
    for i, t in enumerate(texts):
        for at in range(len(t) - 5):
            first[t[at : at + 6]] = min(first.get(t[at : at + 6], 99), int(key[i]))
    assert got == [(i, at) for i, t in enumerate(texts) for at in range(len(t) - 5) if first[t[at : at + 6]] < key[i]]


def test_repeats_with_small_slabs_and_carried_columns(spark, small, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLAB", 3000)
    monkeypatch.setattr(suffix_dedup, "DEAL", 20_000)
    draw = random.Random(11)
    passage = "".join(draw.choices("abcdefg hij", k=400))
    rows = {i: "".join(draw.choices("abcdefg hij", k=draw.randint(0, 900))) + passage[draw.randint(0, 200) :] for i in range(60)}
    docs = spark.createDataFrame([(k, t, "s", "k") for k, t in rows.items()], "doc_id long, text string, spans string, lang string")
    out = suffix_dedup.remove_repeats(docs.repartition(3), ("spans", "lang"))
    assert out.columns == ["doc_id", "lang", "n_bytes", "spans", "kept"]
    got = {r.doc_id: (r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in out.collect()}
    assert got == _cut_by_hand(rows)


def _cut_by_hand(rows, span=50):
    seen, out = {}, {}
    for k, t in sorted(rows.items()):
        raw = (t or "").encode()
        mark, own = bytearray(len(raw)), set()
        for i in range(len(raw) - span + 1):
            own.add(raw[i : i + span])
            if raw[i : i + span] in seen:
                mark[i : i + span] = b"\1" * span
        seen.update(dict.fromkeys(own))
        kept = bytes(b for b, m in zip(raw, mark, strict=True) if not m)
        out[k] = (len(raw), sum(mark), len(re.findall(b"\1+", mark)), hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_against_brute_force(spark, small, texts):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op3_suffix_dedup(spark, small).collect()}
    assert got == _cut_by_hand(texts)


def test_repeats_in_periodic_and_odd_texts(spark):
    draw = random.Random(2)
    rows = {i: "".join(draw.choice("ab") for _ in range(draw.randint(0, 300))) for i in range(25)}
    rows |= {30: "ab" * 400, 31: "ba" * 100, 32: "a" * 49, 33: "a" * 50, 34: "a" * 3000, 35: None, 36: "é" * 60, 37: "é" * 60}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    found = suffix_dedup.remove_repeats(docs).collect()
    got = {r.doc_id: (r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found}
    assert got == _cut_by_hand(rows)
    assert suffix_dedup.remove_repeats(docs.where("false")).count() == 0
    twice = docs.where("doc_id = 30").unionByName(docs.where("doc_id = 30"))
    assert [len(r.spans) for r in suffix_dedup.remove_repeats(twice).collect()] == [0, 0]


# --- WARC


def test_archive_round_trip_with_small_ranges(spark):
    odd = [(1, "http://a/ b", "x" * 150), (2, None, "x" * 150), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (6, "é\n", "é" * 90), (7, "u", "\r\n\r\n" * 30), (8, "u", "x" * 150)]
    pages = spark.createDataFrame(odd, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    path = new_shared_path(spark, "test-warc")
    warc.write_archive(warc.with_revisits(pages), path)
    got = {r.page_id: r for r in warc.read_archive(spark, path, range_bytes=97).collect()}
    assert sorted(got) == list(range(1, 9))
    for page_id, _, html in odd:
        raw = (html or "").encode()
        first = 1 if page_id in (2, 8) else None
        assert got[page_id].refers_to == first and got[page_id].record_type == ("revisit" if first else "response")
        assert got[page_id].payload_bytes == len(raw) and got[page_id].payload_digest == hashlib.sha256(raw).hexdigest()
        assert got[page_id].payload == (None if first else raw)
    assert [got[i].url for i, _, _ in odd] == [u for _, u, _ in odd]
    empty = new_shared_path(spark, "test-warc")
    warc.write_archive(warc.with_revisits(pages.where("false")), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_false_magic_is_no_record():
    inner = warc.member(1, "u", b"a" * 200, hashlib.sha256(b"a" * 200).hexdigest(), None, "d")
    noise = warc.MAGIC + b"\x00" * 30
    data = inner + noise + warc.member(2, "u", b"", hashlib.sha256(b"").hexdigest(), None, "d")
    read = lambda at, n: data[at : at + n]
    for cut in range(1, len(data)):
        halves = [*warc.records_of_range(read, 0, cut), *warc.records_of_range(read, cut, len(data))]
        assert [r["page_id"] for r in halves] == [1, 2]


# --- Classifiers


def _auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable")) + 1
    n1 = (y == 1).sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (y == 0).sum())


@pytest.mark.parametrize(("name", "label", "least"), [("op7_quality", "quality", 0.95), ("op5_toxicity", "toxic", 0.6)])
def test_held_out_rows(name, label, least, spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.queries()[name](spark, folder).toPandas()
    labels = pq.read_table(f"{folder}/labels.parquet").to_pandas()
    assert rows.score.between(0, 1).all() and len(rows) == 1000
    assert (rows.held_out == rows.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    own = rows.merge(labels, on="doc_id")
    own = own[own.held_out]
    assert _auc(own.score.to_numpy(), own[label].to_numpy()) >= least


def test_kernel_tolerates_gaps_and_inserted_characters():
    marks = toxicity.Landmarks(["idiot"])
    near = marks.kernel(["idiot", "id-iot", "idxiot", "idot", "window", "radio"])[:, 0]
    assert near[0] == pytest.approx(1) and near[1] > 0.1 and near[2] > 0.1 and near[3] > 0.1
    assert near[4] < 0.02 and near[5] < 0.02


def test_toxicity_reads_spelled_words():
    clean = ["the plain words of a text. More plain words are here" for _ in range(30)]
    rude = [f"the plain words {w} of a text" for w in ("idiot", "moron", "idiots", "morons") for _ in range(8)]
    y = np.array([0] * len(clean) + [1] * len(rude))
    scorer = toxicity.Scorer(model := toxicity.fit(clean + rude, y, np.ones(len(y))))
    tests = ["you are an idiot", "you i d i o t there", "you id-iot there", "plain words", ""]
    p = 1 / (1 + np.exp(-(model["slope"] * scorer.margins(tests) + model["shift"])))
    assert (p[:2] > 0.5).all() and p[2] > p[3] and (p[3:] < 0.5).all()


def test_margins_are_the_trained_machines():
    draw = random.Random(6)
    plain = ["quiet gardens", "window painting", "mountain weather", "evening concert", "library visitors"]
    line = lambda: " ".join(draw.choices(plain, k=4)) + draw.choice(". |? |! |\n".split("|"))
    clean = ["".join(line() for _ in range(draw.randint(1, 5))) for _ in range(60)]
    rude = ["".join(line() for _ in range(3)) + f"such {w} people, the {w}" for w in ("idiot", "morons") for _ in range(20)]
    y = np.array([0] * len(clean) + [1] * len(rude))
    model = toxicity.fit(clean + rude, y, np.ones(len(y)))
    tests = [*clean[:10], *rude[::4], "idiot " + "quiet mountain weather " * 9, "i d i o t in quiet gardens.x", "ab cd", "", "window" * 12]
    marks = toxicity.Landmarks(model["landmarks"])
    kernels = [[k.sum(0) for s in toxicity.sentences(t) if (k := marks.kernel(s)).any()] for t in tests]
    want = [max((k @ model["weights"] for k in found), default=0.0) + model["bias"] for found in kernels]
    assert min(want) < model["bias"]
    assert toxicity.Scorer(model).margins(tests) == pytest.approx(want, abs=1e-4)


def test_toxicity_above_a_higher_bar(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op5_toxicity(spark, folder).toPandas()
    own = rows.merge(pq.read_table(f"{folder}/labels.parquet").to_pandas(), on="doc_id")
    own = own[own.held_out]
    assert _auc(own.score.to_numpy(), own.toxic.to_numpy()) >= 0.75


def test_toxicity_at_a_larger_scale(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.op5_toxicity(spark, folder).toPandas()
    own = rows.merge(pq.read_table(f"{folder}/labels.parquet").to_pandas(), on="doc_id")
    own = own[own.held_out]
    assert _auc(own.score.to_numpy(), own.toxic.to_numpy()) >= 0.9


def test_toxicity_scores_against_brute_force(spark, small, texts, odd):
    from stelae.runtime import read_table

    docs = read_table(spark, small, "documents")
    model = toxicity.train(docs, read_table(spark, small, "labels"))
    d = toxicity.DECAY

    def features(word):
        out = {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, len(word)):
                    key = word[i] + word[j] + word[k]
                    out[key] = out.get(key, 0) + d ** (k - i + 1)
        return out

    def kernel(a, b):
        return sum(v * b.get(k, 0) for k, v in a.items())

    marks = [features(w) for w in model["landmarks"]]
    known = {}

    def value(word):  # signed, or None without any common subsequence
        if word not in known:
            own = features(word)
            k = [kernel(own, m) / np.sqrt((kernel(own, own) or 1) * kernel(m, m)) for m in marks]
            known[word] = sum(w * x**toxicity.POWER for w, x in zip(model["weights"], k, strict=True)) if any(k) else None
        return known[word]

    def score(text):
        sums = []
        for words in toxicity.sentences(text or ""):
            values = [v for w in words if (v := value(w)) is not None]
            sums += [sum(values)] if values else []
        margin = max(sums, default=0.0) + model["bias"]
        return 1 / (1 + np.exp(-(model["slope"] * margin + model["shift"])))

    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    some = sorted(texts)[::4]
    assert [got[k] for k in some] == pytest.approx([score(texts[k]) for k in some], abs=1e-3)
    # Null, empty, one word, repeated, long and other odd rows, by the trained machine.
    rows = toxicity.score(odd.drop("score"), model).collect()
    assert len(rows) == len(ODD_TEXTS)
    for r in rows:
        assert r.score == pytest.approx(score(r.text), abs=1e-3)


def test_subsequence_kernel_by_hand():
    codes, _ = toxicity._codes(["cat", "car", "cart"], 4)
    d = toxicity.DECAY
    got = toxicity.subsequence_kernel(codes[[0, 1, 2]], codes[[0, 2, 0]])
    assert got == pytest.approx([d**6, d**6, d**7])


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_without_labels(module, spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = module.train(odd, none)
    assert {r.score for r in module.score(odd, model).collect()} == {0.0}
    assert module.score(odd.where("false"), model).count() == 0


def test_quality_of_odd_texts(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, ("good plain words " if i % 2 else "!!! ### $$$ ") * 20) for i in range(60)], "doc_id long, text string")
    model = quality.train(docs, labels)
    got = [r.score for r in quality.score(odd, model).collect()]
    assert len(got) == len(ODD_TEXTS) and all(0 <= s <= 1 for s in got)


# --- Exact top-k


def test_top_k_odd_vectors(spark):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(200)] + [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan"), 0.0, 0.0, 0.0]), (303, [float("inf"), 0.0, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in covertree.top_k(vectors, F.col("id") % 50 == 0, 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows if i < 300}
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert covertree.top_k(vectors.where("false"), F.col("id") % 50 == 0, 5).count() == 0
    one = covertree.top_k(vectors.where("vec_id in (0, 7)"), F.col("id") % 50 == 0, 5).collect()
    assert [(r.query_id, r.id) for r in one] == [(0, 7)]


def test_cover_tree_radii_hold():
    points = np.random.default_rng(0).normal(size=(700, 3)) * 100
    tree = covertree.CoverTree(points, np.arange(700))
    assert sorted(tree.ids.tolist()) == list(range(700)) and len(tree.centre) > 3
    for centre, radius, (a, b) in zip(tree.centre, tree.radius, tree.range, strict=True):
        assert np.sqrt(((tree.points[a:b] - centre) ** 2).sum(1)).max() <= radius


def test_block_pairs_are_pruned_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 60)
    monkeypatch.setattr(covertree, "QUERY_ROWS", 10)
    monkeypatch.setattr(covertree, "TASK_GROUPS", 2)
    counted = {}
    real = covertree.worth_searching

    def counting(pairs, seeds):
        left = real(pairs, seeds)
        counted.update(all=pairs.count(), left=left.count(), asked=seeds.count())
        return left

    monkeypatch.setattr(covertree, "worth_searching", counting)
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(12, 6)) * 8
    points = [(i, (centres[i % 12] + draw.normal(size=6) * 0.2).tolist()) for i in range(900)] + [(900 + i, centres[3].tolist()) for i in range(300)]
    vectors = spark.createDataFrame(points, "vec_id long, embedding array<double>")
    got = {}
    for r in covertree.top_k(vectors, F.col("id") % 50 == 0, 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v in points}
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert counted["left"] < 0.8 * (counted["all"] - covertree.SEEDS * counted["asked"]) and counted["asked"] > 2


# --- Fingerprints


def test_fingerprints_against_sets(spark, small, texts):
    got = {r.doc_id: r for r in queries.op8_iblt(spark, small).collect()}
    from xxhash import xxh64_intdigest

    def units(text):
        found, held = set(), []
        for sentence in re.split(r"\n|(?<=[.!?|]) |(?<=[。！？])", text):
            held.append(sentence)
            if xxh64_intdigest(sentence.encode(), 42) % 2 == 0:
                found.add(tuple(held))
                held = []
        return found | ({tuple(held)} if held else set())

    like = lambda a, b: len(units(a) & units(b)) / len(units(a) | units(b))
    keys = sorted(texts)
    assert sorted(got) == keys
    for k, after in zip(keys, [*keys[1:], keys[0]], strict=True):
        text, half = texts[k], len(texts[k]) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(like(text, edited)) and r.near_next == pytest.approx(like(text, texts[after]))
    assert len({r.fingerprint for r in got.values()}) == len(set(texts.values()))


def test_peeling_recovers_the_difference(spark):
    rows = spark.createDataFrame([([1, 2, 3, 4], [3, 4, 5])], "a array<bigint>, b array<bigint>")
    lost = iblt.peel(iblt.subtract(iblt.cells(F.col("a"), 24), iblt.cells(F.col("b"), 24)), 24)
    assert {(x.k, x.n) for x in rows.select(lost.alias("d")).first()["d"]} == {(1, 1), (2, 1), (5, -1)}
    full = spark.createDataFrame([(list(range(400)), list(range(300, 700)))], "a array<bigint>, b array<bigint>")
    cells = [iblt.cells(F.col(c), iblt.BASE_CELLS) for c in "ab"]
    got = full.select(iblt.difference(F.col("a"), F.col("b"), *cells).alias("d")).first()["d"]
    assert sorted((x.k, x.n) for x in got) == sorted([(i, 1) for i in range(300)] + [(i, -1) for i in range(400, 700)])


def test_next_text_over_gaps_and_odd_rows(spark, odd):
    rows = spark.createDataFrame([(i * 700, f"t{i}") for i in range(-3, 9)], "doc_id long, text string")
    got = {r.id: r.next_text for r in iblt.with_next_text(rows).collect()}
    assert got == {i * 700: f"t{i + 1 if i < 8 else -3}" for i in range(-3, 9)}
    assert [r.next_text for r in iblt.with_next_text(rows.limit(1)).collect()] == ["t-3"]
    assert iblt.with_next_text(odd).count() == len(ODD_TEXTS) and iblt.with_next_text(odd.where("false")).count() == 0


def test_next_text_and_likeness_of_long_and_other_texts(spark):
    many = "".join(f"Satz {i} ist da. " for i in range(20_000))
    rows = [(1, many), (1 << 40, many + "Ende."), (1 << 60, "一句話。另一句！第三句？"), (-5, "第三句？一句話。")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = iblt.with_next_text(docs).select("id", iblt.digests(F.col("text")).alias("a"), iblt.digests(F.col("next_text")).alias("b"))
    out = out.select("*", *[iblt.cells(F.col(x), iblt.BASE_CELLS).alias(f"{x}_cells") for x in "ab"])
    lost = iblt.difference(F.col("a"), F.col("b"), F.col("a_cells"), F.col("b_cells"))
    got = {r.id: (set(r.a), set(r.b), {x.k for x in r.d}) for r in out.select("id", "a", "b", lost.alias("d")).collect()}
    assert all(a ^ b == d for a, b, d in got.values()) and len(got) == 4
    assert len(got[1][0]) > 5000 and len(got[1][2]) <= 4


def test_totals_over_several_chunks(spark):
    values = [i % 7 for i in range(1000)]
    row = spark.createDataFrame([(values,)], "v array<bigint>").select(chat._totals(F.col("v")).alias("t")).first()
    assert list(row.t) == np.concatenate([[0], np.cumsum(values)[:-1]]).tolist()


def test_embedding_distance_is_a_lower_bound(spark):
    draw = random.Random(1)
    pairs = [(draw.getrandbits(63), draw.getrandbits(63)) for _ in range(200)]
    pairs += [(a, a ^ sum(1 << i for i in draw.sample(range(63), 3))) for a, _ in pairs]
    counts = lambda x: [bin(x >> 2 * i & 3).count("1") for i in range(32)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", simhash.manhattan(F.col("a"), F.col("b")).alias("m")).collect()
    for r in got:
        assert r.m == sum(abs(x - y) for x, y in zip(counts(r.a), counts(r.b), strict=True)) <= bin(r.a ^ r.b).count("1")


# --- Chat


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", r"\b \\l <x> ### a: </turn>"), (1, 1, "assistant", None), (1, 2, "assistant", "#<\\"), (1, 3, None, "x"), (None, 0, "a:b<", "y"), (1, 3, None, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.format_conversations(turns)
    out = out.select("conv_id", chat.read_back(F.col("formatted")).alias("t"), chat.text_under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted")
    got = {r.conv_id: r for r in out.collect()}
    assert [(x.role, x.text) for x in got[1].t] == [(r or "", t or "") for c, _, r, t in sorted((x for x in rows if x[0]), key=lambda x: x[1])]
    assert got[1].loss == "#<\\" and got[1].formatted.count("### assistant") == 1
    assert [(x.role, x.text) for x in got[None].t] == [("a:b<", "y")]
    assert chat.format_conversations(turns.where("false")).count() == 0


# --- BPE


def test_bpe_like_the_library():
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(9)
    texts = ["", "'s it's 's  's\n's", "x  \n\n y", "a''s b'll'd", "y" * 1500 + " " + "ab" * 700, "你好 　 世界 ½²"]
    texts += ["".join(draw.choices("'srlevemtd  \n .!1aéL\u0085你", k=draw.randint(1, 40))) for _ in range(1500)]
    classes, merger = bpe._tools(path)
    for text, (ids, offsets) in zip(texts, bpe.encode_texts(texts, classes, merger), strict=True):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
        raw, parts = text.encode(), [library.decode_single_token_bytes(i) for i in ids.tolist()]
        assert all(raw[o : o + len(p)] == p for o, p in zip(offsets.tolist(), parts, strict=True))


def test_bpe_decodes_lists_without_objects_for_ids():
    import pyarrow as pa

    table = pa.array([b"a", b"", b"\xff\x00", b"word"], pa.binary())
    lists = pa.array([[9], [3, 0], None, [], [2, 1, 2], None, [0]], pa.list_(pa.int32()))
    for at in range(1, len(lists) + 1):
        want = [b"worda", None, b"", b"\xff\x00\xff\x00", None, b"a"][at - 1 :]
        assert bpe.bytes_of_lists(lists[at:], table).to_pylist() == want
    assert bpe.bytes_of_lists(pa.array([None, []], lists.type), table).to_pylist() == [None, b""]


def test_bpe_slab_takes_little_memory():
    import tracemalloc

    path = P.path("byte_bpe_multi_50k.tiktoken")
    classes, merger = bpe._tools(path)
    texts = [" ".join(f"w{(i * j) % 900}" for j in range(400)) for i in range(1500)]  # 2.4 million characters or so
    list(bpe.encode_texts(texts[:300], classes, merger))
    tracemalloc.start()
    for _, slab in bpe._slabs(list(range(len(texts))), texts):
        bpe.encode_texts(slab, classes, merger)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


def test_bpe_round_trip(spark, small, texts, odd):
    got = {r.doc_id: r for r in queries.op10_bpe(spark, small).collect()}
    assert {k: r.decoded_sha256 for k, r in got.items()} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts.items()}
    import tiktoken

    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for k, t in texts.items():
        ids = library.encode_ordinary(t)
        assert (got[k].n_tokens, got[k].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    path = P.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode(odd, path).select("doc_id", bpe.decode(F.col("ids"), path).alias("raw")).collect()
    assert sorted(bytes(r.raw) for r in out) == sorted((t or "").encode() for _, t, _ in ODD_TEXTS)
    assert bpe.encode(odd.where("false"), path).count() == 0


def test_workers_give_memory_back_between_tasks(spark):
    """What a scorer held is gone from its worker when the task has ended, also below
    something that stays."""

    def anonymous_mb():
        with open("/proc/self/smaps_rollup") as lines:
            return sum(int(x.split()[1]) for x in lines if x.startswith("Anonymous:")) / 1024

    def score_texts():
        import os
        import sys

        held = [bytes(60_000) for _ in range(3000)]
        sys.stays = bytes(60_000)  # lies above what goes, so the C library keeps that by itself

        def of(texts):
            assert len(held) == 3000
            return np.full(len(texts), os.getpid())

        return of

    def seen(batches):
        import os

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()] * batch.num_rows), pa.array([anonymous_mb()] * batch.num_rows)], names=["pid", "mb"])

    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string").coalesce(1)
    (worker,) = {int(r["score"]) for r in quality.with_scores(docs, score_texts).collect()}
    later = spark.range(64, numPartitions=64).mapInArrow(seen, "pid long, mb double").collect()
    mine = [r["mb"] for r in later if r["pid"] == worker]
    assert mine and max(mine) < 150
