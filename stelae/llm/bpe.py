"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Boundaries are found without a regex engine. Every code point becomes a symbol (its
class, folded with the one or two code points that follow); each symbol is a
transition function over the eight states of a small automaton. Functions compose
associatively, so a block scan composes them for all blocks at once, gives every
block its entering state, and a second pass marks the breaks. The slices between
breaks go through a cache of merged pairs.

Defined results: null text is empty text (no ids, empty decoding); a text of any
length is handled whole; repeated rows give repeated results; an empty table gives
no rows; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stelae.runtime import ship_package

LETTER, NUMBER, OTHER, SPACE, BLANK, EDGE = range(6)
#: Symbols: a letter, a number, another mark, an apostrophe that starts a
#: contraction of one or two letters, white space that goes on, white space before a
#: mark (not U+0020, or U+0020), the edge of a text.
L, N, P, A1, A2, WR, WL, SL, SEP = range(9)
#: States: nothing open, in letters, in numbers, in other marks, in white space,
#: after a space that joins what follows, two or one letters of a contraction to go.
FRESH, IN_L, IN_N, IN_P, IN_W, JOIN, C2, C1 = range(8)
BLOCK = 64
#: Code points worked on at a time, and pieces kept in a worker's cache.
SLAB_CHARS, CACHE_PIECES = 400_000, 300_000


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """after[state, symbol] and breaks[state, symbol] (a break before the symbol)."""
    after, breaks = np.zeros((8, 9), np.uint8), np.ones((8, 9), bool)
    for s in range(8):
        for y in range(9):
            if s == C2:
                after[s, y], breaks[s, y] = C1, False
            elif s == C1:
                after[s, y], breaks[s, y] = FRESH, False
            elif y in (L, N, P):
                own = {L: IN_L, N: IN_N, P: IN_P}[y]
                after[s, y], breaks[s, y] = own, s not in (own, JOIN)
            elif y in (A1, A2):
                if s in (IN_P, JOIN):
                    after[s, y], breaks[s, y] = IN_P, False
                else:
                    after[s, y] = C1 if y == A1 else C2
            elif y == WR:
                after[s, y], breaks[s, y] = IN_W, s != IN_W
            else:
                after[s, y] = {WL: FRESH, SL: JOIN, SEP: FRESH}[y]
    return after, breaks


AFTER, BREAKS = _automaton()


def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for c in range(sys.maxunicode + 1):
        kind = kinds.get(unicodedata.category(chr(c))[0])
        if kind is not None:
            table[c] = kind
    # White_Space of the Unicode character database (fixed values).
    spaces = [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[spaces] = SPACE
    table[0x20] = BLANK
    return table


def symbols(points: np.ndarray, edges: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """points: code points of texts, each followed by one place of edges."""
    kind = classes[points]
    kind[edges] = EDGE
    out = kind.copy()
    out[kind == EDGE] = SEP
    after = np.empty_like(kind)
    after[:-1], after[-1] = kind[1:], EDGE
    white = (kind == SPACE) | (kind == BLANK)
    last = white & (after <= OTHER)
    out[white] = WR
    out[last & (kind == SPACE)] = WL
    out[last & (kind == BLANK)] = SL
    quotes = np.flatnonzero((points == 39) & (kind == OTHER))
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        real = np.concatenate([kind, np.full(2, EDGE, kind.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        single = np.isin(one, [ord(c) for c in "stmd"]) & (real[quotes + 1] != EDGE)
        pair = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
        out[quotes[single]] = A1
        out[quotes[pair & (real[quotes + 2] != EDGE)]] = A2
    return out


def breaks_of(syms: np.ndarray) -> np.ndarray:
    """Where a piece begins: an associative scan of transition functions."""
    n = len(syms)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, SEP, np.uint8)
    padded[:n] = syms
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    flat_after, flat_breaks = AFTER.ravel(), BREAKS.ravel()
    scan = np.repeat(np.arange(8, dtype=np.uint8)[None, :], blocks, 0)
    for column in columns:
        scan = flat_after[scan * np.uint8(9) + column[:, None]]
    step = 1
    while step < blocks:  # composed[i] = scan[i] after all blocks up to i
        later = np.take_along_axis(scan[step:], scan[:-step], 1)
        scan = np.concatenate([scan[:step], later])
        step *= 2
    state = np.empty(blocks, np.uint8)
    state[0], state[1:] = FRESH, scan[:-1, FRESH]
    marks = np.empty((BLOCK, blocks), bool)
    for j, column in enumerate(columns):
        place = state * np.uint8(9) + column
        marks[j] = flat_breaks[place]
        state = flat_after[place]
    return np.ascontiguousarray(marks.T).ravel()[:n]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Merger:
    """Cached pair merging. A piece gets a number; the ids of all cached pieces, the
    byte where each begins and the lengths of the pieces lie in flat arrays, so that
    texts are put together by gathers."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.starts = array("i"), array("i")
        self.first, self.width = array("q", [0]), array("i")

    def merge(self, piece: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        raw = piece.encode("utf-8")
        ranks = self.ranks
        if raw in ranks:
            return (ranks[raw],), (0,)
        if len(raw) > 400:
            return self._merge_long(raw)
        get = ranks.get
        parts = [raw[i : i + 1] for i in range(len(raw))]
        far = 1 << 60
        near = [get(raw[i : i + 2], far) for i in range(len(raw) - 1)]
        while near:
            best = min(near)
            if best == far:
                break
            i = near.index(best)
            joined = parts[i] + parts[i + 1]
            parts[i : i + 2] = [joined]
            del near[i]
            if i < len(near):
                near[i] = get(joined + parts[i + 1], far)
            if i:
                near[i - 1] = get(parts[i - 1] + joined, far)
        return self._placed(parts)

    def _merge_long(self, raw: bytes):
        """The same for a long piece, with a heap and linked places."""
        import heapq

        get, n = self.ranks.get, len(raw)
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i]:
                continue
            j = end[i]
            if j >= n or end[j] != stop:
                continue
            alive[j] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := get(raw[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            k = before[i]
            if k >= 0 and (r := get(raw[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        return self._placed([raw[i : end[i]] for i in range(n) if alive[i]])

    def _placed(self, parts: list[bytes]):
        starts, at = [], 0
        for part in parts:
            starts.append(at)
            at += len(part)
        return tuple(self.ranks[p] for p in parts), tuple(starts)

    def __call__(self, piece: str) -> int:
        ids, starts = self.merge(piece)
        self.ids.extend(ids)
        self.starts.extend(starts)
        self.first.append(len(self.ids))
        self.width.append(len(piece.encode("utf-8")))
        n = self.number[piece] = len(self.width) - 1
        return n


_WORKER: dict = {}


def _tools(path: str):
    if path not in _WORKER:
        _WORKER[path] = (_classes(), Merger(load_ranks(path)))
    return _WORKER[path]


def encode_texts(texts: list[str], classes: np.ndarray, merger: Merger):
    """For each text: ids, the byte offset of each id."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    edges = np.cumsum(sizes) - 1
    cuts = np.flatnonzero(breaks_of(symbols(points, edges, classes)))
    places = cuts.tolist()
    if len(merger.number) >= CACHE_PIECES:
        merger.forget()
    number = merger.number
    pieces = [joined[a:b] for a, b in zip(places, [*places[1:], len(joined)], strict=True)]
    which = list(map(number.get, pieces))
    for i in [i for i, n in enumerate(which) if n is None]:
        found = number.get(pieces[i])
        which[i] = merger(pieces[i]) if found is None else found
    del pieces, places
    which = np.array(which, np.int64)
    real = ~np.isin(cuts, edges)  # an edge breaks too, and is no piece
    which, cuts = which[real], cuts[real]
    first = np.frombuffer(merger.first, np.int64)
    counts = first[which + 1] - first[which]
    ends = np.cumsum(counts)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[which] - (ends - counts), counts)
    ids = np.frombuffer(merger.ids, np.int32)[at] if len(at) else np.empty(0, np.int32)
    width = np.frombuffer(merger.width, np.int32)[which].astype(np.int64) if len(which) else np.empty(0, np.int64)
    begin = np.cumsum(width) - width
    last = np.searchsorted(cuts, edges)  # pieces before each edge
    heads = np.concatenate([[0], last[:-1]])
    tokens = np.concatenate([[0], ends])[last]
    base = np.repeat(np.concatenate([begin, [0]])[np.minimum(heads, len(begin))], last - heads)
    starts = np.frombuffer(merger.starts, np.int32)[at] if len(at) else np.empty(0, np.int32)
    offsets = (starts + np.repeat(begin - base, counts)).astype(np.int32)
    out, a = [], 0
    for b in tokens.tolist():
        out.append((ids[a:b], offsets[a:b]))
        a = b
    return out


def _slabs(ids: list, texts: list[str]):
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLAB_CHARS:
            yield ids[start : i + 1], texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield ids[start:], texts[start:]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int32)))


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> id, ids array<int>, offsets array<int> (the byte where each token begins)."""
    spark = docs.sparkSession
    ship_package(spark)

    def run(batches):
        from stelae.llm import bpe

        classes, merger = bpe._tools(ranks_path)
        for batch in batches:
            texts = [t if t is not None else "" for t in batch.column(1).to_pylist()]
            for keys, slab in bpe._slabs(batch.column(0).to_pylist(), texts):
                done = bpe.encode_texts(slab, classes, merger)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, batch.schema.field(0).type), bpe._lists([d[0] for d in done]), bpe._lists([d[1] for d in done])],
                    names=[id_col, "ids", "offsets"],
                )
                del done
            del batch, texts
            pa.default_memory_pool().release_unused()  # what a batch took isn't kept for the next

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, ids array<int>, offsets array<int>")


def bytes_of_lists(ids: pa.ListArray, table: pa.BinaryArray) -> pa.BinaryArray:
    """For each list of ids the bytes that they stand for, one after another. table: the
    bytes of each id. No object is made for an id: the tokens of all lists are gathered
    into one buffer, of which each list has a range."""
    tokens = table.take(ids.flatten())
    ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)])
    _, places, held = tokens.buffers()
    begins = np.frombuffer(places, np.int32)[tokens.offset :][ends] if len(tokens) else np.zeros(len(ends), np.int32)
    out = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(begins.astype(np.int32)), held or pa.py_buffer(b"")])
    return pc.if_else(ids.is_valid(), out, pa.scalar(None, pa.binary())) if ids.null_count else out


def _bytes_table(path: str) -> pa.BinaryArray:
    if ("bytes", path) not in _WORKER:
        ranks = load_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            table[i] = raw
        _WORKER["bytes", path] = pa.array(table, pa.binary())
    return _WORKER["bytes", path]


def decode(ids: Column, ranks_path: str) -> Column:
    """The bytes that token ids stand for; null ids give null."""

    @F.arrow_udf("binary")
    def decoded(column: pa.Array) -> pa.Array:
        from stelae.llm import bpe

        return bpe.bytes_of_lists(column, bpe._bytes_table(ranks_path))

    return decoded(ids)
