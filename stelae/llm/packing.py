"""Best-fit packing of tokenised documents, certified by lower bounds.

Documents are cut into pieces of at most ``limit`` tokens and dealt to partitions
of a bounded number of pieces. Each partition packs by best-fit decreasing. While the
bins are more than the largest of a family of dual-feasible-function bounds over the
whole corpus, every bin with room left goes on to the next round: bins are dealt anew
to partitions of as many pieces, in turn by chance and by fill, and packed again (the
earlier bins stay if that isn't better). This ends when one partition is left, or when
neither way of dealing lessens the bins.

Defined results: null text is empty text (only the end id); texts of any length are
read whole and cut into pieces; repeated rows are packed as often as they occur; ids
stay as they are, a null id too; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stelae.runtime import giving_back, ship_package, stored

#: Pieces per partition in each round; the last turn that sequence ids have bits for.
PIECES_PER_PARTITION, LAST_TURN = 1500, 63
#: Words of either half of the cache; bytes of the texts that are encoded at a time (a longer text is one slab).
CACHE_WORDS, SLAB_BYTES = 200_000, 8 << 20

_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
#: A plain Latin word with the marks behind it.
_PLAIN = f"^(?P<stem>{_LETTERS})(?P<marks>[!\"#$%&()*+,./:;=?@^_{{}}~-]*)$"
_WORKER: dict = {}


class WordTokenizer:
    """Ids of whole texts by a tokenizers file whose pre-tokenizer splits at ASCII
    white space. Arrow splits a slab of texts, numbers the distinct chunks between
    white space and parts plain Latin words from the marks behind them; only the
    distinct stems, in lower case, and other chunks are looked up in the cache, and
    those that are new are encoded together. Stems skip the normaliser, which only
    lower-cases them, and go to the file's own merge model; every other chunk takes the
    whole tokenizer. When the cache is full its half that was used less recently goes,
    so that frequent words stay."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        # The byte alphabet of byte-level models: printable bytes stand for
        # themselves, the others for the code points from 256 on, in order.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in shown]
        self.letters = [(chr(b), chr(256 + i)) for i, b in enumerate(rest) if b >= 128]

    def _whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, chunks: list[bytes]) -> None:
        cache, stems, letters = self.cache, [], re.compile(_LETTERS)
        for chunk in chunks:
            if chunk.isalpha() or letters.fullmatch(text := chunk.decode("utf-8")):
                stems.append(chunk)
            else:
                cache[chunk] = self._whole(text)
        spelled = b"\n".join(stems).decode("latin-1")
        if not spelled.isascii():
            for byte, shown in self.letters:
                spelled = spelled.replace(byte, shown)
        ids, ends, tokenize = [], [], self.model.tokenize
        for word in spelled.split("\n") if stems else []:
            ids += [t.id for t in tokenize(word)]
            ends.append(4 * len(ids))
        data, begin = np.array(ids, "<u4").tobytes(), 0
        for stem, end in zip(stems, ends, strict=True):
            cache[stem] = data[begin:end]
            begin = end

    def _known(self, chunks: pa.Array) -> pa.Array:
        """Ids of each chunk: stems in lower case, or what isn't a plain word."""
        numbered = chunks.dictionary_encode()
        distinct = numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        cache, older = self.cache, self.older
        missing = set(distinct).difference(cache)
        if older and (known := [c for c in missing if c in older]):
            cache.update(zip(known, map(older.get, known), strict=True))
            missing.difference_update(known)
        if missing:
            self._learn(list(missing))
        return pa.array(list(map(cache.get, distinct)), pa.large_binary()).take(numbered.indices)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (strings without null)."""
        if len(self.cache) > CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        parts = pc.extract_regex(chunks.dictionary, _PLAIN)
        stems, marks = (pc.struct_field(parts, name) for name in ("stem", "marks"))
        begun = self._known(pc.coalesce(pc.utf8_lower(stems), chunks.dictionary))
        ended = self._known(pc.fill_null(marks, ""))
        ids = pc.binary_join_element_wise(begun, ended, pa.scalar(b"", pa.large_binary())).take(chunks.indices)
        begins = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset :]
        ends = begins[np.cumsum(split.value_lengths().to_numpy())].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self.encode(pa.array([text], pa.string()))[0]


def slabs(texts: pa.Array) -> list[tuple[int, int]]:
    """Begin and end of stretches of texts that hold about SLAB_BYTES, or one text."""
    held = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // SLAB_BYTES
    begins = np.flatnonzero(np.diff(held, prepend=-1)).tolist()
    return list(zip(begins, [*begins[1:], len(texts)], strict=False))


def token_pieces(
    docs: DataFrame, tokenizer_path: str, limit: int = 4096, end_id: int = 1, keep_ids: bool = False
) -> DataFrame:
    """-> doc_id, piece, start, length, ids_crc32 (and ids, if kept)."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def run(batches):
        from stelae.llm import packing

        encode = packing._WORKER.get(tokenizer_path)
        if encode is None:
            encode = packing._WORKER[tokenizer_path] = packing.WordTokenizer(tokenizer_path)
        tail = np.array([end_id], "<u4").tobytes()
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for begin, end in packing.slabs(texts):
                columns: list[list] = [[] for _ in range(5 + keep_ids)]
                doc_ids = batch.column(0)[begin:end]
                for doc_id, ids in zip(doc_ids.to_pylist(), encode.encode(texts[begin:end]), strict=True):
                    ids += tail
                    for piece, start in enumerate(range(0, len(ids) // 4, limit)):
                        part = ids[4 * start : 4 * (start + limit)]
                        row = [doc_id, piece, start, len(part) // 4, zlib.crc32(part)]
                        for column, value in zip(columns, row + [np.frombuffer(part, "<i4")] * keep_ids, strict=True):
                            column.append(value)
                arrays = [pa.array(c, t) for c, t in zip(columns, [doc_ids.type, *types], strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        encode.older = {}  # workers outlive their tasks, and other work

    return docs.select("doc_id", "text").mapInArrow(giving_back(run), schema)


def lower_bound(lengths: np.ndarray, limit: int) -> int:
    """Of lengths, one for each piece; see ``histogram_bound``."""
    return histogram_bound(*np.unique(np.asarray(lengths, np.int64), return_counts=True), limit)


def histogram_bound(sizes: np.ndarray, counts: np.ndarray, limit: int) -> int:
    """sizes: distinct lengths, ascending; counts: of pieces of each. The largest of these
    bounds on the bins: total length; for each threshold, pieces above limit - threshold count whole and pieces below it not at all; and
    the stair functions u(k) for k up to 20. All are dual feasible."""
    if not len(sizes):
        return 0
    up = lambda total, scale: int(-(-total // scale))
    best = up(int((sizes * counts).sum()), limit)
    tail_sum = np.concatenate([np.cumsum((sizes * counts)[::-1])[::-1], [0]])
    tail_count = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    low = np.flatnonzero(sizes * 2 <= limit)
    high = np.searchsorted(sizes, limit - sizes[low], side="right")
    totals = tail_sum[low] - tail_sum[high] + limit * tail_count[high]
    if len(totals):
        best = max(best, up(int(totals.max()), limit))
    for k in range(1, 21):
        whole = (k + 1) * sizes
        value = np.where(whole % limit == 0, k * sizes, whole // limit * limit)
        best = max(best, up(int((value * counts).sum()), k * limit))
    return best


def best_fit_decreasing(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the fill of each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room_of: dict[int, list[int]] = {}
    rooms, fill = 0, []
    for i in order.tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = room_of[room]
            b = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            room, b = limit, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            held = room_of.setdefault(left, [])
            if not held:
                rooms |= 1 << left
            held.append(b)
    return bins, offsets, np.array(fill, np.int64)


def _pack_partition(rows: pa.Table, limit: int) -> pa.Table:
    ways = [("length", "descending"), *[(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")]]
    rows = rows.sort_by(ways).combine_chunks()
    lengths = rows.column("length").to_numpy()
    bins, offsets, fill = best_fit_decreasing(lengths, limit)
    if (rows.column("bin").to_numpy() >= 0).all():
        places = np.stack([rows.column(c).to_numpy() for c in ("from_part", "bin")], axis=1)
        earlier, old = np.unique(places, axis=0, return_inverse=True)
        if len(earlier) <= len(fill):
            bins, offsets = old.ravel(), rows.column("offset").to_numpy()
            fill = np.bincount(bins, lengths).astype(np.int64)
    certified = np.full(len(lengths), len(fill) == lower_bound(lengths, limit))
    new = {"from_part": rows.column("part"), "bin": pa.array(bins), "offset": pa.array(offsets), "fill": pa.array(fill[bins]), "certified": pa.array(certified)}
    return pa.table({c: new.get(c, rows.column(c)) for c in rows.column_names})


def _packer(limit: int):
    def run(group: pa.Table) -> pa.Table:
        from stelae.llm import packing

        return packing._pack_partition(group, limit)

    return run


def _dealt(opened: DataFrame, pieces_of: dict[int, int], turn: int) -> DataFrame:
    """Bins with room, whole, to partitions of about PIECES_PER_PARTITION pieces: in odd
    turns by chance, in even ones so that bins of like fill (the emptiest first) meet.
    pieces_of: how many pieces the bins of each fill hold."""
    total = sum(pieces_of.values())
    parts = -(-total // PIECES_PER_PARTITION)
    chance = F.xxhash64(F.lit(turn), "from_part", "bin")
    if turn % 2:
        return opened.withColumn("part", F.pmod(chance, F.lit(parts)))
    fills = sorted(pieces_of)
    ends = np.cumsum([pieces_of[f] for f in fills]).tolist()
    spans = [(f, e - pieces_of[f], pieces_of[f]) for f, e in zip(fills, ends, strict=True)]
    spans = opened.sparkSession.createDataFrame(spans, "fill long, begin long, pieces long")
    place = F.col("begin") + F.floor(F.pmod(chance, F.lit(1 << 20)) / (1 << 20) * F.col("pieces"))
    part = F.least(F.floor(place * parts / total), F.lit(parts - 1)).cast("long")
    return opened.join(F.broadcast(spans), "fill").withColumn("part", part).select(*opened.columns)


def pack(pieces: DataFrame, limit: int = 4096) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32) -> the same with sequence_id,
    offset and certified (its partition, or the whole corpus, met its lower bound)."""
    ship_package(pieces.sparkSession)
    pieces = stored(pieces, "pieces")
    sizes = sorted((r["length"], r["count"]) for r in pieces.groupBy("length").count().collect())
    bound = histogram_bound(*np.array(sizes, np.int64).reshape(-1, 2).T, limit)
    parts = max(1, -(-sum(n for _, n in sizes) // PIECES_PER_PARTITION))
    rows = pieces.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).alias("part"),
        F.lit(-1).cast("long").alias("from_part"),
        F.lit(-1).cast("long").alias("bin"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(0).cast("long").alias("fill"),
        F.lit(False).alias("certified"),
    )
    schema, settled, turn, full, fewest, idle = rows.schema, [], 0, 0, None, 0
    while True:
        packed = stored(rows.groupBy("part").applyInArrow(_packer(limit), schema), "packed")
        number = F.shiftleft(F.lit(turn).cast("long"), 57) + F.shiftleft(F.col("part"), 24) + F.col("bin")
        packed = packed.withColumn("sequence_id", number)
        bins = packed.groupBy("fill").agg(F.count_if(F.col("offset") == 0).alias("bins"), F.count(F.lit(1)).alias("pieces"))
        bins = {r["fill"]: (r["bins"], r["pieces"]) for r in bins.collect()}
        count = full + sum(n for n, _ in bins.values())
        idle = idle + 1 if fewest is not None and count >= fewest else 0
        fewest = count
        pieces_of = {f: n for f, (_, n) in bins.items() if f < limit}
        if count <= bound or parts == 1 or idle == 2 or turn == LAST_TURN or not pieces_of:
            settled.append(packed)
            break
        full += bins.get(limit, (0, 0))[0]
        settled.append(packed.filter(F.col("fill") == limit))
        turn, parts = turn + 1, -(-sum(pieces_of.values()) // PIECES_PER_PARTITION)
        rows = _dealt(packed.filter(F.col("fill") < limit), pieces_of, turn).select(*schema.names)
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    out = out.withColumn("certified", F.col("certified") | F.lit(count <= bound))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")
