"""Toxicity by a support vector machine with a gapped subsequence string kernel.

The kernel of two words sums over common subsequences of three letters, each weighted
by how far it is spread, so a word with letters between or left out stays close to
the word without. A sentence's kernel sums over its words (normalised, and raised to
a power so that unlike words count next to nothing). The Nyström map of a set of
landmark words turns this into vectors; a linear machine with squared hinge loss
learns from labelled sentences: in each document the one that scores highest stands
for it. Runs of single letters are read as one word too.

The kernel is worked out from explicit features (a word's three-letter subsequences
with their weights), for every word and landmark. Training and serving score by one
function: signed values of words, cached, are summed over sentences; a text's margin
is the highest sum.

Defined results: null or empty text has no words and takes the score of none; texts
of any length are read whole (words over 32 letters in overlapping stretches);
repeated rows score alike; without labels of both classes the score is constant (the
known class, else 0); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from functools import cache
from itertools import chain, combinations

import numpy as np
from pyspark.sql import DataFrame

from stelae.llm.labelled import constant, training_rows
from stelae.llm.quality import with_scores
from stelae.runtime import give_back_memory

ORDER, DECAY, POWER = 3, 0.6, 4
#: Subsequences that a direct table may name.
MOST_NAMES = 1 << 22
#: Share of the best landmark's z score that the others need.
SUPPORT = 0.25
LANDMARKS, PER_CLASS, CACHE_WORDS = 64, 1500, 150_000
LONGEST, MOST_LETTERS = 16, 32
#: Characters of text whose words are held at once.
BLOCK_CHARS = 1 << 20
#: What ends a sentence, besides the end of a line.
_STOPS = ".!?|"
_SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]\S){3,}(?!\S)")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def _codes(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), width), np.uint32)
    if len(words):
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(words)), sizes)
        out[row, np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = points
    return out, sizes


def subsequence_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of pairs of words: rows of code points, zero where a word has ended."""
    match = (a[:, :, None] == b[:, None, :]) & (a[:, :, None] > 0)
    n, la, lb = match.shape
    before = np.ones((n, la + 1, lb + 1), np.float32)
    for _ in range(ORDER - 1):
        here = np.zeros((n, la, lb + 1), np.float32)
        gain = DECAY * DECAY * match * before[:, :-1, :-1]
        for j in range(lb):
            here[:, :, j + 1] = DECAY * here[:, :, j] + gain[:, :, j]
        before = np.zeros((n, la + 1, lb + 1), np.float32)
        for i in range(la):
            before[:, i + 1] = DECAY * before[:, i] + here[:, i]
    return DECAY * DECAY * (match * before[:, :-1, :-1]).sum((1, 2))


def _self_kernel(codes: np.ndarray) -> np.ndarray:
    return np.maximum(subsequence_kernel(codes, codes), 1e-12)


@cache
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the letters of all subsequences of ORDER letters of a word of n
    letters, and their weights."""
    places = np.array(list(combinations(range(n), ORDER)), np.int64).reshape(-1, ORDER)
    return places, (DECAY ** (places[:, -1] - places[:, 0] + 1)).astype(np.float32)


class Landmarks:
    """The kernel as a product of explicit features: a word's weights of the
    subsequences that landmarks have."""

    def __init__(self, words: list[str]):
        self.words = words
        letters = sorted({c for w in words for c in w})
        self.base = len(letters) + 1
        kind = np.int32 if self.base**ORDER < 1 << 31 else np.int64
        self.number = np.zeros(0x110000, kind)
        self.number[[ord(c) for c in letters]] = np.arange(1, self.base)
        held = []
        for i, w in enumerate(words):
            places, weight = _triples(len(w))
            held.append((self._named(self.number[[ord(c) for c in w]][None, :], places)[0], np.full(len(places), i), weight))
        name, word, weight = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.empty(0, np.int64),) * 3
        self.names, row = np.unique(name, return_inverse=True)
        self.features = np.zeros((len(self.names), len(words)), np.float32)
        np.add.at(self.features, (row, word), weight)
        self.own = np.maximum((self.features**2).sum(0), 1e-12)
        self.rows = None
        if self.base**ORDER <= MOST_NAMES:
            self.rows = np.full(self.base**ORDER, -1, np.int32)
            self.rows[self.names] = np.arange(len(self.names))

    def _rows(self, name: np.ndarray) -> np.ndarray:
        """The row of each subsequence, -1 where no landmark has it."""
        if self.rows is not None:
            return self.rows[name]
        row = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        return np.where(self.names[row] == name, row, -1)

    def _named(self, numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
        """One number for each subsequence of each word."""
        name = numbers[:, places[:, 0]]
        for j in range(1, ORDER):
            name = name * self.base + numbers[:, places[:, j]]
        return name

    def kernel(self, words: list[str]) -> np.ndarray:
        """Sharpened normalised kernel of words (MOST_LETTERS at most) and landmarks."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        by_size = np.argsort(sizes, kind="stable")
        edges = np.searchsorted(sizes[by_size], np.arange(ORDER, sizes.max(initial=0) + 2))
        for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False), ORDER):
            if not len(self.names):
                break
            places, weight = _triples(n)
            step = max(64, (1 << 18) // len(places))
            for at in range(a, b, step):
                part = by_size[at : min(at + step, b)]
                codes, _ = _codes([words[i] for i in part], n)
                row = self._rows(self._named(self.number[codes], places)).ravel()
                found = np.flatnonzero(row >= 0)
                if not len(found):
                    continue
                w, which = np.divmod(found.astype(np.int32), np.int32(len(places)))
                first = np.flatnonzero(np.diff(w, prepend=-1))
                live = w[first]
                shared = np.add.reduceat(self.features[row[found]] * weight[which][:, None], first)
                out[part[live]] = (shared / np.sqrt(_self_kernel(codes[live])[:, None] * self.own)) ** POWER
        return out


def stretches(word: str) -> list[str]:
    if len(word) <= MOST_LETTERS:
        return [word]
    half = MOST_LETTERS // 2
    return [word[i : i + MOST_LETTERS] for i in range(0, len(word) - half, half)]


def _lines(text: str) -> list[list[str]]:
    """The words of a text's sentences, lower-cased, as they stand between white space,
    and then the runs of spelled letters."""
    text = text.lower()
    for stop in _STOPS:
        text = text.replace(stop, "\n")
    lines = [part.split() for part in text.split("\n")]
    line = at = 0
    for run in _SPELLED.finditer(text):
        line += text.count("\n", at, run.start())
        at = run.start()
        lines[line].append("".join(run.group().split()))
    return lines


def _pieces(raw: str) -> list[str]:
    word = raw.strip(_EDGES)
    return stretches(word) if word else []


def sentences(text: str) -> list[list[str]]:
    """The words of a text's sentences, without marks at their ends."""
    found = [[p for raw in words for p in _pieces(raw)] for words in _lines(text)]
    return [words for words in found if words]


def choose_landmarks(words: list[str], docs: list[np.ndarray], y: np.ndarray, count: int = LANDMARKS) -> list[str]:
    """Words that toxic documents hold more often than others do in either half of the
    training documents (the halves take turns) by a z score of at least SUPPORT of the
    best, picked so that each toxic document holds several; then frequent words of the
    others, as many at most. docs: the numbers of each document's distinct words."""
    fit_ = np.fromiter((ORDER <= len(w) <= LONGEST for w in words), bool, len(words))
    docs = [d[fit_[d]] for d in docs]
    tally = lambda some: np.bincount(np.concatenate([*some, np.empty(0, np.int64)]), minlength=len(words))
    scores = []
    for half in (0, 1):
        own = list(zip(docs[half::2], y[half::2], strict=True))
        n = [max(1, sum(t == c for _, t in own)) for c in (0, 1)]
        seen = [tally([d for d, t in own if t == c]) for c in (0, 1)]
        share = (seen[0] + seen[1]) / (n[0] + n[1])
        spread = share * (1 - share) * (1 / n[0] + 1 / n[1])
        scores.append((seen[1] / n[1] - seen[0] / n[0]) / np.sqrt(np.maximum(spread, 1e-12)) * (seen[1] > 0))
    least = np.minimum(*scores)
    held = (least > 0) & (least >= SUPPORT * least.max(initial=0.0))
    need = {i: 3.0 for i in range(len(docs)) if y[i] == 1}
    where: dict[int, list[int]] = {w: [] for w in np.flatnonzero(held).tolist()}
    for i in need:
        for w in docs[i][held[docs[i]]].tolist():
            where[w].append(i)
    toxic: list[str] = []
    while len(toxic) < count * 3 // 4 and where:
        best = max(where, key=lambda w: (least[w] * sum(need[i] for i in where[w]), words[w]))
        if sum(need[i] for i in where[best]) <= 0:
            break
        toxic.append(words[best])
        for i in where.pop(best):
            need[i] = max(0.0, need[i] - 1)
    common = tally([d for d, t in zip(docs, y, strict=True) if t == 0])
    order = sorted(np.flatnonzero((common > 0) & (least <= 0)).tolist(), key=lambda w: (-common[w], words[w]))
    plain = [words[w] for w in order if len(words[w]) >= 2 * ORDER]
    return toxic + plain[: min(count - len(toxic), max(len(toxic), count // 8))]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, rounds: int = 400):
    """Squared hinge loss by accelerated gradient steps; the last column is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y == 1, 1.0, -1.0)
    step = 1 / (2 * np.linalg.norm(x * np.sqrt(weight / weight.sum())[:, None], 2) ** 2 + penalty)
    w = ahead = np.zeros(x.shape[1])
    for i in range(rounds):
        gap = np.maximum(0, 1 - sign * (x @ ahead))
        slope = -2 * x.T @ (weight * gap * sign) / weight.sum() + penalty * np.r_[ahead[:-1], 0]
        new = ahead - step * slope
        ahead, w = new + i / (i + 3) * (new - w), new
    return w[:-1], w[-1]


def fit(texts: list[str], y: np.ndarray, weight: np.ndarray, rounds: int = 3) -> dict:
    number: dict[str, int] = {}
    docs = []  # numbers of words, and of how many words a sentence has
    for text in texts:
        found = sentences(text)
        flat = np.array([number.setdefault(w, len(number)) for words in found for w in words], np.int64)
        docs.append((flat, np.array([len(words) for words in found], np.int64)))
    words = list(number)
    sets = [np.unique(flat) for flat, _ in docs]
    marks = Landmarks(choose_landmarks(words, sets, y))
    at = np.array([number[w] for w in marks.words], np.int64)
    seen = [np.bincount(np.concatenate([*[d for d, t in zip(sets, y, strict=True) if t == c], at]), minlength=len(words))[at] - 1 for c in (0, 1)]
    gain = (seen[1] * (y == 0).sum() > seen[0] * (y == 1).sum()).astype(float)
    base = marks.kernel(marks.words).astype(float)
    base = (base + base.T) / 2 + 1e-3 * np.eye(len(base))
    values, vectors = np.linalg.eigh(base)
    nystrom = vectors / np.sqrt(np.maximum(values, 1e-3))
    raw = marks.kernel(words)
    live = raw.any(1)
    small, bags = nystrom.astype(np.float32), []
    for flat, sizes in docs:
        of = np.repeat(np.arange(len(sizes)), sizes)[live[flat]]
        flat = flat[live[flat]]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        bags.append(np.add.reduceat(raw[flat], first) @ small if len(flat) else np.zeros((1, small.shape[1]), np.float32))
    del raw, number, words, sets, docs
    bias = 0.0
    coefficient = np.linalg.pinv(nystrom) @ gain
    for _ in range(rounds):
        top = np.array([b[np.argmax(b @ coefficient)] for b in bags])
        coefficient, bias = _svm(top, y, weight)
    margin = np.array([(b @ coefficient).max() + bias for b in bags])
    slope, shift = 1.0, 0.0
    target = np.where(y == 1, 1 - 1e-3, 1e-3)
    for _ in range(500):  # Platt's sigmoid, by damped Newton steps
        p = 1 / (1 + np.exp(-(slope * margin + shift)))
        g = weight * (p - target)
        h = weight * p * (1 - p)
        hess = np.array([[(h * margin**2).sum(), (h * margin).sum()], [(h * margin).sum(), h.sum()]]) + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, [(g * margin).sum() + 1e-3 * slope, g.sum()])
        slope, shift = slope - 0.5 * move[0], shift - 0.5 * move[1]
        if np.abs(move).max() < 1e-6:
            break
    return {"landmarks": marks.words, "weights": nystrom @ coefficient, "bias": float(bias), "slope": float(slope), "shift": float(shift)}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> dict:
    """A model of docs (doc_id, text) and labels (doc_id, label) outside the held-out
    fold, from at most ``per_class`` rows a class, weighted by the classes' sizes."""
    rows, counts = training_rows(docs.select("doc_id", "text"), labels.select("doc_id", label), label, per_class)
    if (known := constant(counts)) is not None or rows is None:
        return {"constant": known or 0.0}
    got = sorted(rows.select("doc_id", "label", "text").collect(), key=lambda r: r["doc_id"])
    y = np.array([r["label"] for r in got])
    if not 0 < y.sum() < len(y):
        return {"constant": float(y.mean()) if len(y) else 0.0}
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    model = fit([r["text"] or "" for r in got], y, weight / weight.mean())
    del got
    give_back_memory()
    return model


class Scorer:
    def __init__(self, model: dict):
        self.model = model
        self.marks = Landmarks(model["landmarks"])
        self.cache: dict[str, float] = {}

    def _learn(self, raws: list[str]) -> None:
        """Signed values of words as they stand between white space: zero only where
        no landmark has anything in common."""
        pieces, owner = [], []
        for i, raw in enumerate(raws):
            own = _pieces(raw)
            pieces += own
            owner += [i] * len(own)
        value, live = np.zeros(len(raws)), np.zeros(len(raws), bool)
        if pieces:
            kernel = self.marks.kernel(pieces)
            np.add.at(value, owner, kernel @ self.model["weights"])
            np.logical_or.at(live, owner, kernel.any(1))
        value[live & (value == 0)] = np.finfo(float).tiny
        self.cache.update(zip(raws, value.tolist(), strict=True))

    def margins(self, texts: list[str]) -> np.ndarray:
        """The highest sentence margin of each text, over sentences with something in
        common with a landmark."""
        ends = np.cumsum([len(t) for t in texts]) // BLOCK_CHARS
        edges = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
        return np.concatenate([self._margins(texts[a:b]) for a, b in zip(edges, edges[1:], strict=False)])

    def _margins(self, texts: list[str]) -> np.ndarray:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        lines = [[words for words in _lines(text) if words] for text in texts]
        flat = [words for own in lines for words in own]
        missing = set().union(*flat).difference(self.cache)
        if missing:
            self._learn(sorted(missing))
        out = np.zeros(len(texts))
        if flat:
            sizes = np.fromiter(map(len, flat), np.int64, len(flat))
            get = self.cache.__getitem__
            values = np.fromiter(map(get, chain.from_iterable(flat)), np.float64, int(sizes.sum()))
            first = np.cumsum(sizes) - sizes
            total = np.add.reduceat(values, first)
            total[~np.logical_or.reduceat(values != 0, first)] = -np.inf
            counts = np.fromiter(map(len, lines), np.int64, len(lines))
            some = np.flatnonzero(counts)
            best = np.maximum.reduceat(total, (np.cumsum(counts) - counts)[some])
            out[some] = np.where(np.isfinite(best), best, 0.0)
        return out + self.model["bias"]


def score(docs: DataFrame, model: dict) -> DataFrame:
    """docs (doc_id, text, ...) -> the same with a column score."""

    def score_texts():
        from stelae.llm import toxicity

        if "constant" in model:
            return lambda texts: np.full(len(texts), model["constant"])
        scorer = toxicity.Scorer(model)

        def of(texts):
            margin = scorer.margins([t.decode("utf-8", "replace") for t in texts])
            return 1 / (1 + np.exp(-(model["slope"] * margin + model["shift"])))

        return of

    return with_scores(docs, score_texts)
