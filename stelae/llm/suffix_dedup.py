"""Exact removal of repeated byte strings by a prefix-free parse.

Parse: a rolling hash of ``GRAM`` bytes runs over each document; the place of the
least hash among the grams of every ``span``-byte window is a trigger, so that each
window holds one, found from the window's bytes alone. Triggers cut the text into
phrases: a head that ends with its trigger, and the bytes that the parse goes on with
(so many that each window lies in one phrase).

Dictionary: each phrase goes, as a hash of its trigger and two of itself (128 bits, by
which phrases of one trigger are told apart), to the bucket of its trigger, where equal phrases lie together with their least document. A phrase
that a smaller document has as well is repeated whole; a trigger of one document, or
of equal phrases only, is settled.

Corpus order: phrases of the other triggers, as at the ends of repeated passages, go
to buckets by trigger as strings. There the suffixes of the distinct heads are sorted
from the order of the suffixes one byte shorter (the dictionary's suffix array), what
follows the triggers is sorted with its common prefixes (the parse's order), and the
two ranks together order all windows; neighbours in that order are compared, so equal
windows form a run with its least document. Only windows with their trigger in one
place can be equal, so one place is ordered at a time.

Texts are dealt once, by slab (a stored number of some neighbouring rows); slabs carry
marks back. Tasks drop phrases that a smaller document among their last ``DEAL`` bytes
has too before dealing, so a hot passage isn't sent once for each document.

Defined results: null text is empty; texts shorter than ``span`` lose nothing; texts
of any length are read whole (a slab holds at least one); rows with one id never
remove each other's bytes; a null id is larger than any other; an empty table gives no
rows; further columns are ignored, and so are columns to carry that are named like
one of the results.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stelae.runtime import giving_back, ship_package, stored

SPAN, GRAM = 50, 20
#: Bytes and rows of a slab; bytes of text whose phrases are dealt at once; bytes of
#: text per bucket of triggers; open windows per bucket of their order.
SLAB, SLAB_ROWS, DEAL, BUCKET_BYTES, BUCKET_WINDOWS, LEAST_BUCKETS = 1 << 20, 1 << 14, 16 << 20, 16 << 20, 1 << 20, 24
#: Sent bits of the trigger's hash, beside those that chose the bucket. Triggers that are
#: taken for one because of them only leave more phrases open, to be compared as strings.
TRIGGER_BITS = 32
DUPLICATE, OPEN = 1, 2
RESULTS = ("doc_id", "n_bytes", "spans", "kept")
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
#: Of the second hash of a phrase: its own base, and its own value for each byte.
_SECOND = 0xD6E8FEB86659FD93
_POWERS: dict = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit multiply-xorshift hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        _POWERS[base] = made
    return _POWERS[base]


_VALUES = {_BASE: np.arange(1, 257, dtype=np.uint64), _SECOND: _mix(np.arange(1, 257, dtype=np.uint64))}


class Rolling:
    """Hashes of any substring of a byte array, from prefix sums modulo 2^64."""

    def __init__(self, data: np.ndarray, base: int = _BASE):
        up, self.down = _powers(len(data) + 1, base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[base][data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.down[start])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """For each place: where the least of the next ``width`` values is (leftmost)."""
    at, best, have = np.arange(len(values), dtype=np.int32), values, 1
    while have < width:
        step = min(have, width - have)
        later = best[step:] < best[:-step]
        at = np.where(later, at[step:], at[:-step])
        best = np.minimum(best[step:], best[:-step])
        have += step
    return at


def parse(texts: list[bytes], span: int = SPAN, gram: int = GRAM):
    """The texts' bytes, and of each phrase: document's place, first and last window
    start, trigger place, trigger hash, phrase hash (the first of two)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    stops = np.cumsum(sizes)
    if len(data) < span:
        none = np.empty(0, np.int64)
        return data, none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    rolling = Rolling(data)
    grams = rolling.grams(gram)
    trigger = _least(grams, span - gram + 1)[: len(data) - span + 1]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[: len(trigger)]
    inside = np.flatnonzero(np.arange(len(trigger)) + span <= stops[owner])
    trigger, owner = trigger[inside], owner[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(inside)]])[: len(first)] - 1
    lo, hi, place = inside[first], inside[last], trigger[first].astype(np.int64)
    return data, owner[first].astype(np.int64), lo, hi, place, grams[place], _phrase_hash(rolling, lo, hi, place, span)


def _phrase_hash(rolling: Rolling, lo: np.ndarray, hi: np.ndarray, place: np.ndarray, span: int) -> np.ndarray:
    return _mix(rolling(lo, hi + span) ^ ((hi - lo).astype(np.uint64) << np.uint64(32)) ^ (place - lo).astype(np.uint64))


def second_hash(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, place: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Of whole phrases, independent of the first: phrases are the same if both hashes,
    128 bits in all, are."""
    return _phrase_hash(Rolling(data, _SECOND), lo, hi, place, span)


def _packed(values: np.ndarray) -> bytes:
    """Integers as offsets from the least, in as few bytes each as the largest needs."""
    values = np.asarray(values)
    wide = values.astype(np.uint64) if values.dtype == np.uint64 else values.astype(np.int64).view(np.uint64)
    base = values.min() if len(values) else 0
    base = np.uint64(base) if values.dtype == np.uint64 else np.array([base], np.int64).view(np.uint64)[0]
    rest = wide - base
    width = (int(rest.max()).bit_length() + 7) // 8 if len(rest) else 0
    body = np.ascontiguousarray(rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return struct.pack("<IBQ", len(values), width, int(base)) + body


def _unpacked(raw: bytes, at: int, kind=np.int64) -> tuple[np.ndarray, int]:
    count, width, base = struct.unpack_from("<IBQ", raw, at)
    at += 13
    wide = np.zeros((count, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw, np.uint8, width * count, at).reshape(width, count).T
    return (wide.view("<u8").ravel() + np.uint64(base)).view(kind), at + width * count


def _all_packed(*arrays: np.ndarray) -> bytes:
    return b"".join(map(_packed, arrays))


def _all_unpacked(raw: bytes, kinds) -> tuple[list[np.ndarray], int]:
    found, at = [], 0
    for kind in kinds:
        values, at = _unpacked(raw, at, kind)
        found.append(values)
    return found, at


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by keys (the last is the major one), and where a group begins, by
    all keys but the first."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = False
    for key in keys[1:]:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    return order, new


def _later(order: np.ndarray, new: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which rows have a larger key than the first of their group."""
    starts = np.flatnonzero(new)
    out = np.empty(len(order), bool)
    if len(order):
        out[order] = key[order] > key[order[starts]][np.cumsum(new) - 1]
    return out


class Dealer:
    """Collects phrases of slabs, and deals them as blobs by bucket of the trigger."""

    def __init__(self, buckets: int):
        self.buckets, self.size, self.docs, self.held = buckets, 0, 0, []

    def add(self, slab: int, at: np.ndarray, keys: np.ndarray, texts: list[bytes]) -> None:
        data, owner, lo, hi, place, major, one = parse(texts)
        here = np.full(len(keys), slab, np.int64)
        self.held.append((here, at.astype(np.int64), keys.astype(np.int64), owner + self.docs, major, one, second_hash(data, lo, hi, place)))
        self.docs += len(keys)
        self.size += sum(map(len, texts))

    def blobs(self):
        """Entries that a smaller document of those collected has too are only marked."""
        if not self.held:
            return
        slab, at, keys, doc, major, one, two = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.size, self.docs, self.held = 0, 0, []
        order, new = _groups(keys[doc], two, one, major)
        known = _later(order, new, keys[doc])
        del order, new
        bucket = (major % np.uint64(self.buckets)).astype(np.int64)
        major //= np.uint64(self.buckets)
        by = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by], np.arange(self.buckets + 1))
        for b in range(self.buckets):
            own = by[edges[b] : edges[b + 1]]
            if len(own):
                docs, counts = np.unique(doc[own], return_counts=True)
                mark = known[own]
                sent = own[~mark]
                low = np.uint64((1 << TRIGGER_BITS) - 1)
                yield b, _all_packed(slab[docs], at[docs], keys[docs], counts, np.flatnonzero(mark), major[sent] & low, one[sent], two[sent])


def settle(bucket: int, blobs: list[bytes]) -> pd.DataFrame:
    """-> slab, bucket, opened (windows left open, at most), marks: documents of the slab and
    4 * (the entry of the document in this bucket) + status. DUPLICATE: a smaller
    document has the phrase too; OPEN: the trigger is shared with other documents, and
    the phrase is not settled."""
    u = np.uint64
    parts = [_all_unpacked(b, (np.int64,) * 5 + (u, u, u))[0] for b in blobs]
    sent = []
    for _, _, _, counts, mark, _, _, _ in parts:
        kept = np.ones(int(counts.sum()), bool)
        kept[mark] = False
        sent.append(kept)
    key = np.concatenate([np.repeat(p[2], p[3])[s] for p, s in zip(parts, sent, strict=True)])
    major, one, two = (np.concatenate([p[i] for p in parts]) for i in (5, 6, 7))
    order, new = _groups(key, two, one, major)
    status = np.where(_later(order, new, key), DUPLICATE, 0).astype(np.uint8)
    if len(key):
        new_major = np.ones(len(key), bool)
        new_major[1:] = major[order[1:]] != major[order[:-1]]
        starts = np.flatnonzero(new_major)
        low, high = np.minimum.reduceat(key[order], starts), np.maximum.reduceat(key[order], starts)
        several = np.add.reduceat(new.astype(np.int64), starts) > 1
        unsure = ((low < high) & several)[np.cumsum(new_major) - 1]
        status[order[unsure & (status[order] == 0)]] = OPEN
    rows, begin = [], 0
    for (slab, at, _, counts, _, _, _, _), kept in zip(parts, sent, strict=True):
        own = np.full(len(kept), DUPLICATE, np.uint8)
        n = int(kept.sum())
        own[kept] = status[begin : begin + n]
        begin += n
        entry = np.arange(len(kept)) - np.repeat(np.cumsum(counts) - counts, counts)
        found = np.flatnonzero(own)
        doc = np.repeat(np.arange(len(counts)), counts)[found]
        value = entry[found] * 4 + own[found]
        for s, some in _by_slab(slab[doc]):
            opened = int((value[some] & 3 == OPEN).sum()) * (SPAN - GRAM + 1)
            rows.append((s, bucket, opened, _all_packed(at[doc[some]], value[some])))
    return pd.DataFrame(rows, columns=["slab", "bucket", "opened", "marks"])


def _by_slab(slab: np.ndarray):
    """Slabs with their rows, in the order of rows."""
    if not len(slab):
        return
    order = np.argsort(slab, kind="stable")
    found, first = np.unique(slab[order], return_index=True)
    for s, a, b in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        yield s, order[a:b]


def _statuses(at: np.ndarray, owner: np.ndarray, major: np.ndarray, buckets: int, marks) -> np.ndarray:
    """Statuses of a slab's phrases from its marks (bucket, documents, values). at: of
    the documents that the phrases' owners count."""
    status = np.zeros(len(owner), np.uint8)
    bucket = (major % np.uint64(buckets)).astype(np.int64)
    by = np.lexsort((owner, bucket))
    place = bucket[by] * (1 << 31) + owner[by]
    number = np.full(int(at.max(initial=-1)) + 1, -1)
    number[at] = np.arange(len(at))
    for b, docs, value in marks:
        begin = np.searchsorted(place, b * (1 << 31) + number[docs])
        status[by[begin + (value >> 2)]] = value & 3
    return status


def _table(table: pa.Table, *names: str) -> list:
    """Columns of a table: numbers as arrays, texts as lists of bytes."""
    out = []
    for name in names:
        column = table.column(name)
        if pa.types.is_integer(column.type):
            out.append(column.to_numpy())
        else:
            column = column if pa.types.is_binary(column.type) else column.cast(pa.binary())
            out.append([x or b"" for x in column.to_pylist()])
    return out


def open_phrases(slab: int, at: np.ndarray, keys: np.ndarray, texts: list[bytes], marks, buckets: int, order_buckets: int):
    """Of a slab: blobs with its open phrases by bucket of the order, and one with the
    byte runs of its repeated phrases."""
    marks = [(b, *_all_unpacked(raw, (np.int64, np.int64))[0]) for b, raw in marks]
    marked = np.flatnonzero(np.isin(at, np.unique(np.concatenate([docs for _, docs, _ in marks]))))
    at, keys, texts = at[marked], keys[marked], [texts[i] for i in marked]
    data, owner, lo, hi, place, major, _ = parse(texts)
    status = _statuses(at, owner, major, buckets, marks)
    begins = np.cumsum([0, *map(len, texts)])[:-1]
    sure = np.flatnonzero(status == DUPLICATE)
    if len(sure):
        # Phrases of a document follow each other, so runs that touch are merged.
        new = np.ones(len(sure), bool)
        new[1:] = (owner[sure[1:]] != owner[sure[:-1]]) | (lo[sure[1:]] > hi[sure[:-1]] + SPAN)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(sure)) - 1
        doc = owner[sure[first]]
        begin = lo[sure[first]] - begins[doc]
        length = hi[sure[last]] + SPAN - lo[sure[first]]
        yield slab % order_buckets, b"\0" + _all_packed(np.array([slab]), at[doc], begin, length)
    unsure = np.flatnonzero(status == OPEN)
    bucket = ((major[unsure] // np.uint64(buckets)) % np.uint64(order_buckets)).astype(np.int64)
    for b in np.unique(bucket).tolist():
        own = unsure[bucket == b]
        doc, size = owner[own], hi[own] - lo[own] + SPAN
        where = np.repeat(lo[own] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        head = _all_packed(np.array([slab]), at[doc], keys[doc], lo[own] - begins[doc], place[own] - lo[own], size)
        yield b, b"\1" + head + data[where].tobytes()


def _ranks(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes: their sorted order, and for each place in it the bytes that it
    shares with the row before (0 for the first)."""
    n, width = strings.shape
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = strings
    order = np.lexsort(wide.view(">u8").astype(np.uint64).T[::-1]) if width else np.arange(n)
    shared = np.zeros(n, np.int64)
    if width and n:
        differs = strings[order[1:]] != strings[order[:-1]]
        shared[1:] = np.where(differs.any(1), differs.argmax(1), width)
    return order, shared


def _classes(order: np.ndarray, shared: np.ndarray, length: int) -> np.ndarray:
    """Ranks of sorted strings by their first bytes alone."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < length) - 1 if length else 0
    return out


def order_windows(data: np.ndarray, begin: np.ndarray, place: np.ndarray, size: np.ndarray, key: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """Windows of open phrases that a smaller document has too: the phrase, and the
    window's start in it. begin, size: of each phrase in data; place: of its trigger."""
    most = span - gram
    padded = np.concatenate([data, np.zeros(span, np.uint8)])
    trigger = begin + place
    order, shared = _ranks(padded[trigger[:, None] + np.arange(gram)])
    rank = _classes(order, shared, gram)
    tail = size - place - gram
    strings = padded[(trigger + gram)[:, None] + np.arange(most)]
    strings[np.arange(most) >= tail[:, None]] = 0
    follow, follow_shared = _ranks(strings)
    alive, found = np.arange(len(begin)), []
    for before in range(most + 1):  # bytes of the window before its trigger
        if before:
            # The order of suffixes one byte longer, from the order of those before.
            alive = alive[place[alive] >= before]
            step = padded[trigger[alive] - before].astype(np.int64) * (len(begin) + 1) + rank[alive]
            rank[alive] = np.unique(step, return_inverse=True)[1]
        rest = most - before
        own = alive[tail[alive] >= rest]
        after = _classes(follow, follow_shared, rest)
        ordered, new = _groups(key[own], after[own], rank[own])
        own = own[_later(ordered, new, key[own])]
        found.append((own, place[own] - before))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def settle_order(blobs: list[bytes]) -> pd.DataFrame:
    """-> slab, marks: documents of the slab, starts and lengths of repeated runs."""
    rows, parts, texts = [], [], []
    for raw in blobs:
        if raw[0] == 0:
            (slab, at, begin, length), _ = _all_unpacked(raw[1:], (np.int64,) * 4)
            rows.append((int(slab[0]), _all_packed(at, begin, length)))
        else:
            (slab, at, *more), stop = _all_unpacked(raw[1:], (np.int64,) * 6)
            parts.append((np.repeat(slab, len(at)), at, *more))
            texts.append(raw[1 + stop :])
    if parts:
        slab, at, key, lo, place, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        data = np.frombuffer(b"".join(texts), np.uint8)
        which, start = order_windows(data, np.cumsum(size) - size, place, size, key)
        start = start + lo[which]
        order = np.lexsort((start, at[which], slab[which]))
        slab, at, start = slab[which[order]], at[which[order]], start[order]
        new = np.ones(len(order), bool)
        new[1:] = (slab[1:] != slab[:-1]) | (at[1:] != at[:-1]) | (start[1:] > start[:-1] + SPAN)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(order))[: len(first)] - 1
        slab, at, begin, length = slab[first], at[first], start[first], start[last] + SPAN - start[first]
        rows += [(s, _all_packed(at[some], begin[some], length[some])) for s, some in _by_slab(slab)]
    return pd.DataFrame(rows, columns=["slab", "marks"])


def number_slabs(batches, task: int):
    """Rows with the number of their slab, and their own number in it."""
    slab, at, size = task << 33, 0, 0
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        lengths = pa.compute.binary_length(column).to_numpy(zero_copy_only=False).tolist()
        slabs, numbers = [], []
        for n in lengths:
            if at and (size + n > SLAB or at == SLAB_ROWS):
                slab, at, size = slab + 1, 0, 0
            slabs.append(slab)
            numbers.append(at)
            at, size = at + 1, size + n
        arrays = [pa.array(slabs, pa.int64()), pa.array(numbers, pa.int32()), *batch.columns]
        yield pa.RecordBatch.from_arrays(arrays, names=["slab", "at", *batch.schema.names])


def deal_phrases(batches, buckets: int):
    dealer = Dealer(buckets)

    def dealt():
        pairs = list(dealer.blobs())
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.binary())], names=["bucket", "blob"]
        )

    for batch in batches:
        slab, at, keys = (batch.column(i).to_numpy() for i in range(3))
        edges = [0, *(np.flatnonzero(np.diff(slab)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                texts = [t or b"" for t in batch.column(3).slice(a, b - a).cast(pa.binary()).to_pylist()]
                dealer.add(int(slab[a]), at[a:b], keys[a:b], texts)
            if dealer.size >= DEAL:
                yield dealt()
    yield dealt()


def cut(table: pa.Table, marks: list[bytes], names: list[str], whole_characters: bool) -> pa.Table:
    """A slab's documents without the runs that its marks hold."""
    at, texts = _table(table, "at", "text")
    runs = [_all_unpacked(m, (np.int64,) * 3)[0] for m in marks]
    doc, lo, length = (np.concatenate(x) for x in zip(*runs, strict=True)) if runs else (np.empty(0, np.int64),) * 3
    order = np.argsort(doc, kind="stable")
    doc, lo, length = doc[order], lo[order], length[order]
    begins, ends = np.searchsorted(doc, at), np.searchsorted(doc, at, side="right")
    spans = [merged(lo[a:b], lo[a:b] + length[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
    drop = [_whole_characters(t, s) for t, s in zip(texts, spans, strict=True)] if whole_characters else spans
    kept = [_without(t, s) for t, s in zip(texts, drop, strict=True)]
    shown = pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
    arrays = [table.column("doc_id"), table.column("carried"), pa.array(list(map(len, texts)), pa.int64()), shown, pa.array(kept, pa.binary())]
    return pa.Table.from_arrays(arrays, names=names)


def merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that ranges [lo, hi) cover."""
    if not len(lo):
        return []
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(lo)]]) - 1
    return list(zip(lo[first].tolist(), reach[last].tolist(), strict=True))


def _whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans with the other bytes of UTF-8 characters that they cut through."""

    def start(at: int) -> int:  # of the character that holds this place
        lead = at
        while lead > max(0, at - 3) and text[lead] & 0xC0 == 0x80:
            lead -= 1
        return lead

    def stop(at: int) -> int:
        lead, first = start(at), text[start(at)]
        size = 4 if first >= 0xF0 else 3 if first >= 0xE0 else 2 if first >= 0xC0 else 1
        inside = text[lead + 1 : lead + size]
        size = 1 + next((i for i, b in enumerate(inside) if b & 0xC0 != 0x80), len(inside))
        return max(at + 1, lead + size)

    wide = [(start(a) if stop(start(a)) > a else a, stop(b - 1)) for a, b in spans]
    return merged(*np.array(wide, np.int64).T) if wide else []


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    if not spans:
        return text
    at, parts = 0, []
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = (), whole_characters: bool = False) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, the columns to carry, n_bytes, spans (removed
    byte ranges), kept (the other bytes, or with ``whole_characters`` those of them
    that don't belong to a character with removed bytes)."""
    ship_package(docs.sparkSession)
    carry = tuple(c for c in carry if c not in RESULTS)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        "doc_id",
        F.struct(*carry).alias("carried") if carry else F.lit(0).alias("carried"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def numbered(batches):
        from pyspark import TaskContext

        from stelae.llm import suffix_dedup

        return suffix_dedup.number_slabs(batches, TaskContext.get().partitionId())

    slabs = rows.mapInArrow(numbered, "slab long, at int, " + ", ".join(f"{n} {k}" for n, k in kinds.items()))
    slabs = stored(slabs, "slabs")
    size = slabs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))

    def phrase_run(batches):
        from stelae.llm import suffix_dedup

        return suffix_dedup.deal_phrases(batches, buckets)

    def phrase_settler(group: pd.DataFrame) -> pd.DataFrame:
        from stelae.llm import suffix_dedup

        return suffix_dedup.settle(int(group["bucket"].iloc[0]), list(group["blob"]))

    blobs = slabs.select("slab", "at", "key", "text").mapInArrow(giving_back(phrase_run), "bucket long, blob binary")
    marks = blobs.groupBy("bucket").applyInPandas(phrase_settler, "slab long, bucket long, opened long, marks binary")
    marks = stored(marks, "phrases")
    opened = marks.agg(F.sum("opened")).first()[0] or 0
    order_buckets = max(LEAST_BUCKETS, -(-opened // BUCKET_WINDOWS))

    def open_run(table: pa.Table, own: pa.Table) -> pa.Table:
        from stelae.llm import suffix_dedup

        pairs = []
        if table.num_rows and own.num_rows:
            slab, at, keys, texts = suffix_dedup._table(table, "slab", "at", "key", "text")
            sorted_ = np.argsort(at)
            own = zip(*suffix_dedup._table(own, "bucket", "marks"), strict=True)
            texts = [texts[i] for i in sorted_]
            pairs = list(suffix_dedup.open_phrases(int(slab[0]), at[sorted_], keys[sorted_], texts, own, buckets, order_buckets))
        return pa.table({"bucket": pa.array([p[0] for p in pairs], pa.int64()), "blob": pa.array([p[1] for p in pairs], pa.binary())})

    def order_settler(group: pd.DataFrame) -> pd.DataFrame:
        from stelae.llm import suffix_dedup

        return suffix_dedup.settle_order(list(group["blob"]))

    names = ["doc_id", "carried", "n_bytes", "spans", "kept"]

    def cut_run(table: pa.Table, own: pa.Table) -> pa.Table:
        from stelae.llm import suffix_dedup

        return suffix_dedup.cut(table, suffix_dedup._table(own, "marks")[0], names, whole_characters)

    # Both cogroups deal the slabs alike, so that Spark shuffles the texts once.
    dealt = slabs.groupBy("slab")
    blobs = dealt.cogroup(marks.select("slab", "bucket", "marks").groupBy("slab")).applyInArrow(open_run, "bucket long, blob binary")
    runs = blobs.groupBy("bucket").applyInPandas(order_settler, "slab long, marks binary")
    out = dealt.cogroup(runs.groupBy("slab")).applyInArrow(
        cut_run,
        f"doc_id {kinds['doc_id']}, carried {kinds['carried']}, n_bytes long, "
        "spans array<struct<start:bigint,stop:bigint>>, kept binary",
    )
    own = [F.col(f"carried.{c}").alias(c) for c in carry]
    return out.select("doc_id", *own, "n_bytes", "spans", "kept")
