"""WARC archives: a deduplicating writer and a splittable reader.

Writing: the first row (least id) of each group of equal payloads becomes a response,
the others become revisit records that refer to it. Each record is a gzip member of
its own; Spark's text writer puts the members into files of any Hadoop file system.

Reading: files are cut into byte ranges. A task scans its range for the gzip magic,
takes a candidate for a record only if it decodes to a WARC header, and owns the
records that start inside its range; it reads past the end of the range where its
last record does.

Defined results: null payload is an empty one; a null URL leaves its header out; a
null id is kept as null; payloads of any length are written whole; URLs are read back as
given; rows that repeat the least id of their group are all
responses; an empty table makes an archive without records, which reads as no rows;
further columns are ignored. Of other writers' archives (a gzip member for each record)
responses, resources and revisits are read, with a null page_id and, for what carries its
payload, the SHA-256 of it; a revisit has the digest only if it is a SHA-256. Records of
other kinds (warcinfo, request, metadata) are passed over.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stelae.runtime import ship_package, stored

MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Revisited payloads that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 50_000
CHUNK = 1 << 20
_EMPTY_MEMBER = bytes([31, 139, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])


def member(page_id, url, payload: bytes, digest: str, refers_to, date: str, level: int = 6) -> bytes:
    """One gzip member whose last byte is zero (an empty member follows if need be)."""
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", date),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        target = quote(url, safe="%:/?#[]@!$&'()*+,;=~-._")
        fields.append(("WARC-Target-URI", target))
        if target != url:  # as given, percent-encoded whole
            fields.append(("X-Target-Given", quote(url, safe="")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", name(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()
    return out if out[-1] == 0 else out + _EMPTY_MEMBER


def with_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, html -> page_id, url, payload, digest, refers_to."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Short payloads take no part in the join: as rows without a key they would all meet in one task.
    short = rows.where(F.octet_length("payload") < least_bytes).withColumn("refers_to", F.lit(None).cast(rows.schema["page_id"].dataType))
    rows = rows.where(F.octet_length("payload") >= least_bytes)
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = stored(firsts.select("digest", "first_id"), "revisited")
    if firsts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    later = F.when(F.col("page_id").eqNullSafe(F.col("first_id")), None).otherwise(F.col("first_id"))
    return rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", later.alias("refers_to")).unionByName(short)


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write rows of with_revisits() as gzip members into the files of a new folder."""
    ship_package(pages.sparkSession)

    def run(batches):
        from stelae.llm import warc

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            made: list[bytes] = []
            size = 0
            for page_id, url, payload, digest, refers_to in zip(*columns, strict=True):
                whole = warc.member(
                    page_id.as_py(), url.as_py(), payload.as_py().encode("utf-8"), digest.as_py(), refers_to.as_py(), date
                )
                made.append(whole[:-1])  # the writer's separator is the last byte, zero
                size += len(whole)
                if size > 4 * CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["member"])
                    made, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["member"])

    columns = ["page_id", "url", "payload", "digest", "refers_to"]
    members = pages.select(*columns).mapInArrow(run, "member binary")
    members.select(F.col("member").cast("string")).write.option("lineSep", "\u0000").text(path)


def _parse(raw: bytes) -> dict | None:
    """A record; None for bytes that are none; an empty dict for a record of another kind
    than responses, revisits and resources."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/1."):
        return None
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    fields = {name.strip().lower(): value.strip() for name, _, value in lines}
    kind, size = fields.get("warc-type"), fields.get("content-length", "")
    if not kind or not size.isdigit():
        return None
    if kind not in ("response", "revisit", "resource"):
        return {}
    block, revisit = rest[: int(size)], kind == "revisit"
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not http.startswith(b"HTTP/"):
        http, payload = b"", block
    said = re.search(rb"(?i)\ncontent-length:[ \t]*(\d+)", http)
    own = fields.get("warc-payload-digest", "").startswith("sha256:")  # as this writer has it
    digest = fields["warc-payload-digest"].removeprefix("sha256:") if own else None
    length = int(said[1]) if said and (own or revisit) else len(payload)
    if not revisit:
        actual = hashlib.sha256(payload).hexdigest()
        if own and (len(payload) != length or actual != digest):
            raise ValueError(f"damaged record {fields.get('warc-record-id')}")
        digest = actual

    def number(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))
        return int(found[1]) if found else None

    given = fields.get("x-target-given")
    return {
        "page_id": number("warc-record-id"),
        "url": fields.get("warc-target-uri") if given is None else unquote(given),
        "record_type": kind,
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": number("warc-refers-to") if revisit else None,
        "payload": None if revisit else payload,
    }


def records_of_range(read_at, start: int, stop: int):
    """The records that start in [start, stop). read_at(offset, n) gives up to n bytes
    of the file, none at its end."""
    held, base, ended = bytearray(), start, False

    def more() -> bool:
        nonlocal ended
        got = b"" if ended else read_at(base + len(held), CHUNK)
        ended = ended or not got
        held.extend(got)
        return not ended

    at = start
    while at < stop:
        found = held.find(MAGIC, at - base)
        if found < 0 or base + found >= stop:
            if found < 0 and base + len(held) < stop + len(MAGIC) and more():
                at = max(at, base + len(held) - CHUNK - len(MAGIC)) if len(held) > 2 * CHUNK else at
                continue
            return
        del held[:found]
        base, at = base + found, base + found
        unpack, out, fed = zlib.decompressobj(31), bytearray(), 0
        try:
            while not unpack.eof:
                if fed >= len(held) and not more():
                    break
                part = bytes(held[fed : fed + CHUNK])
                out += unpack.decompress(part)
                fed += len(part)
                if len(out) >= 7 and not out.startswith(b"WARC/1."):
                    break
        except zlib.error:
            out.clear()
        record = _parse(bytes(out)) if unpack.eof else None
        if record is None and not (unpack.eof and not out):
            at += 1  # the magic was part of compressed data
            continue
        used = fed - len(unpack.unused_data)
        del held[:used]
        base, at = base + used, base + used
        if record:
            yield record


def _open(path: str):
    from pyarrow import fs

    plain = re.match(r"file:/*(/.*)", path)
    system, place = (fs.LocalFileSystem(), plain[1]) if plain else fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


_FIELDS = {
    "page_id": ("long", pa.int64()),
    "url": ("string", pa.string()),
    "record_type": ("string", pa.string()),
    "payload_bytes": ("long", pa.int64()),
    "payload_digest": ("string", pa.string()),
    "refers_to": ("long", pa.int64()),
    "payload": ("binary", pa.binary()),
}


def read_archive(spark: SparkSession, path: str, range_bytes: int = 4 << 20, with_payload: bool = True) -> DataFrame:
    """-> page_id, url, record_type, payload_bytes, payload_digest, refers_to (, payload)."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    ranges = files.where("length > 0").select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes))).alias("start")
    )
    count = ranges.count()
    names = [n for n in _FIELDS if with_payload or n != "payload"]

    def run(batches):
        from stelae.llm import warc

        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with warc._open(path) as file:

                    def read_at(offset: int, n: int, file=file) -> bytes:
                        file.seek(offset)
                        return file.read(n)

                    rows, size = [], 0
                    for record in warc.records_of_range(read_at, start, start + range_bytes):
                        rows.append(record)
                        size += record["payload_bytes"]
                        if size > 8 * warc.CHUNK:
                            yield warc._batch(rows, names)
                            rows, size = [], 0
                    yield warc._batch(rows, names)

    schema = ", ".join(f"{n} {_FIELDS[n][0]}" for n in names)
    return ranges.select("path", "start").repartition(max(1, count)).mapInArrow(run, schema)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], _FIELDS[n][1]) for n in names], names=names)
