"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage is encoded from
the shares of its characters, of transitions between character classes and of
distinct six-byte strings; gated attention, learned from document labels alone,
weights the encodings, and the weighted passage is scored.

Defined results: null or empty text is one empty passage; texts of any length are
read whole; repeated rows score alike; without labels of both classes the score is
constant (the known class, else 0); an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stelae.llm.labelled import constant, training_rows
from stelae.runtime import give_back_memory, giving_back, ship_package

PASSAGE, HIDDEN, GATE, PER_CLASS = 512, 24, 12, 1500
_SLAB = 1 << 20


def _tables() -> tuple[np.ndarray, np.ndarray]:
    fine, coarse = np.full(256, 63, np.uint8), np.full(256, 7, np.uint8)
    for b in range(26):
        fine[97 + b], coarse[97 + b] = b, 0
        fine[65 + b], coarse[65 + b] = 26, 1
    for b in range(48, 58):
        fine[b], coarse[b] = 27, 2
    fine[32], coarse[32], fine[10], coarse[10] = 28, 3, 29, 4
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for i, b in enumerate(marks):
        fine[b], coarse[b] = 30 + i, 5
    fine[192:], coarse[128:] = 62, 6
    return fine, coarse


FINE, COARSE = _tables()
WIDTH = 64 + 64 + 2


def passage_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages in order, and the passages of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(1, -(-sizes // PASSAGE))
    first = np.cumsum(counts) - counts
    n = int(counts.sum())
    data = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.cumsum(sizes) - sizes
    inside = np.arange(len(data)) - np.repeat(begins, sizes)
    at = (np.repeat(first, sizes) + inside // PASSAGE).astype(np.int64)
    length = np.bincount(at, minlength=n).astype(np.float32)
    share = np.maximum(length, 1)[:, None]
    fine = np.bincount(at * 64 + FINE[data], minlength=n * 64).reshape(n, 64)
    kinds = COARSE[data]
    pair = kinds[:-1] * np.uint8(8) + kinds[1:]
    steps = np.bincount(at[:-1] * 64 + pair, minlength=n * 64).reshape(n, 64)
    six = np.zeros(len(data), np.uint32)
    for j in range(6):
        six[: len(data) - j] = six[: len(data) - j] * np.uint32(0x01000193) + data[j:]
    seen = np.zeros(n * 256, bool)
    seen[at * 256 + (six * np.uint32(0x9E3779B1) >> np.uint32(24))] = True
    distinct = seen.reshape(n, 256).sum(1) / (256 * (1 - np.exp(-np.maximum(length, 1) / 256)))
    out = np.empty((n, WIDTH), np.float32)
    out[:, :64], out[:, 64:128] = np.sqrt(fine / share), np.sqrt(steps / share)
    out[:, 128], out[:, 129] = distinct, length / PASSAGE
    return out, counts


def _forward(m: dict, x: np.ndarray, first: np.ndarray, counts: np.ndarray) -> dict:
    h = np.tanh(x @ m["W"] + m["b"])
    t, g = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-(h @ m["U"])))
    raw = (t * g) @ m["w"]
    top = np.repeat(np.maximum.reduceat(raw, first), counts)
    e = np.exp(raw - top)
    a = e / np.repeat(np.add.reduceat(e, first), counts)
    z = np.add.reduceat(a[:, None] * h, first)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": 1 / (1 + np.exp(-(z @ m["c"] + m["d"])))}


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 40) -> dict:
    """Adam on the weighted log loss of documents; gradients written out by hand."""
    draw = np.random.default_rng(7)
    mean, std = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / std
    scale = lambda a, b: (draw.normal(size=(a, b)) / np.sqrt(a)).astype(np.float64)
    m = {"W": scale(WIDTH, HIDDEN), "b": np.zeros(HIDDEN), "V": scale(HIDDEN, GATE), "U": scale(HIDDEN, GATE), "w": scale(GATE, 1)[:, 0], "c": scale(HIDDEN, 1)[:, 0], "d": np.zeros(())}
    s1, s2, turn = {k: np.zeros_like(v) for k, v in m.items()}, {k: np.zeros_like(v) for k, v in m.items()}, 0
    begins = np.cumsum(counts) - counts
    for _ in range(epochs):
        order = draw.permutation(len(y))
        for part in np.array_split(order, max(1, len(y) // 64)):
            n = counts[part]
            rows = np.concatenate([np.arange(begins[i], begins[i] + counts[i]) for i in part])
            first, bx = np.cumsum(n) - n, x[rows]
            f = _forward(m, bx, first, n)
            dz_ = (f["p"] - y[part]) * weight[part] / weight[part].sum()
            g = {"c": f["z"].T @ dz_, "d": dz_.sum()}
            dz = np.repeat(dz_[:, None] * m["c"], n, 0)
            da = (dz * f["h"]).sum(1)
            draw_ = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first), n))
            dt = draw_[:, None] * m["w"] * f["g"] * (1 - f["t"] ** 2)
            dg = draw_[:, None] * m["w"] * f["t"] * f["g"] * (1 - f["g"])
            dh = f["a"][:, None] * dz + dt @ m["V"].T + dg @ m["U"].T
            du = dh * (1 - f["h"] ** 2)
            g |= {"w": (f["t"] * f["g"]).T @ draw_, "V": f["h"].T @ dt, "U": f["h"].T @ dg, "W": bx.T @ du + 1e-4 * m["W"], "b": du.sum(0)}
            turn += 1
            for k in m:
                s1[k] = 0.9 * s1[k] + 0.1 * g[k]
                s2[k] = 0.999 * s2[k] + 0.001 * g[k] ** 2
                m[k] = m[k] - 0.004 * (s1[k] / (1 - 0.9**turn)) / (np.sqrt(s2[k] / (1 - 0.999**turn)) + 1e-8)
    return m | {"mean": mean, "std": std}


def _slabs(batch: pa.RecordBatch):
    begin, size, held = 0, 0, []
    for i, text in enumerate(batch.column(1).cast(pa.binary())):
        raw = text.as_py() or b""
        held.append(raw)
        size += len(raw)
        if size >= _SLAB or i == batch.num_rows - 1:
            yield batch.slice(begin, len(held)), held
            begin, size, held = i + 1, 0, []


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> dict:
    """A model of docs (doc_id, text) and labels (doc_id, label) outside the held-out
    fold, from at most ``per_class`` rows a class, weighted by the classes' sizes."""
    ship_package(docs.sparkSession)
    rows, counts = training_rows(docs.select("doc_id", "text"), labels.select("doc_id", label), label, per_class)
    if (known := constant(counts)) is not None or rows is None:
        return {"constant": known or 0.0}

    def run(batches):
        from stelae.llm import quality

        for batch in batches:
            for rows, texts in quality._slabs(batch):
                x, n = quality.passage_features(texts)
                ends = np.cumsum(n)
                flat = [x[e - c : e].tobytes() for e, c in zip(ends, n, strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(flat, pa.binary())], names=["label", "x"])

    got = rows.select("label", "text", "doc_id").sort("doc_id").select("label", "text").mapInArrow(giving_back(run), "label int, x binary").collect()
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH) for r in got]
    y = np.array([r["label"] for r in got], np.float64)
    if not 0 < y.sum() < len(y):
        return {"constant": float(y.mean()) if len(y) else 0.0}
    drawn = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.where(y == 1, counts[1] / drawn[1], counts[0] / drawn[0])
    model = fit(np.concatenate(bags).astype(np.float64), np.array([len(b) for b in bags]), y, weight / weight.mean())
    del got, bags
    give_back_memory()
    return model


def with_scores(docs: DataFrame, score_texts) -> DataFrame:
    """docs and a column ``score``. score_texts() makes, in a task, a function from
    texts as bytes to their scores."""
    ship_package(docs.sparkSession)
    names = ["doc_id", "text", *[c for c in docs.columns if c not in ("doc_id", "text", "score")]]

    def run(batches):
        from stelae.llm import quality

        scores = score_texts()
        for batch in batches:
            for rows, texts in quality._slabs(batch):
                found = pa.array(np.asarray(scores(texts), np.float64))
                yield pa.RecordBatch.from_arrays([*rows.columns, found], names=[*names, "score"])

    rows = docs.select(*names)
    return rows.mapInArrow(giving_back(run), rows.withColumn("score", F.lit(0.0)).schema)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """docs (doc_id, text, ...) -> the same with a column score."""

    def score_texts():
        from stelae.llm import quality

        if "constant" in model:
            return lambda texts: np.full(len(texts), model["constant"])
        small = {k: v.astype(np.float32) for k, v in model.items()}

        def of(texts):
            x, n = quality.passage_features(texts)
            return quality._forward(small, (x - small["mean"]) / small["std"], np.cumsum(n) - n, n)["p"]

        return of

    return with_scores(docs, score_texts)
