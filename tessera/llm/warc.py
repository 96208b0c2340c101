"""WARC archives: a writer that replaces equal payloads by revisits, and a splittable reader.

Every record is a gzip member of its own. A reading task owns a byte range: it looks for the magic
bytes of gzip, takes a place for a member only if its first bytes decode to a WARC header, and reads
the records that begin inside its range, to their ends wherever those lie.

A null payload is an empty one. Of records with equal payloads of min_bytes at least, those with the
largest id (ties included) are responses and the others revisit it; a null id counts as smallest.
Shorter payloads are all responses. Repeated rows are records each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import checkpointed, prepare

FILE_BYTES = 64 << 20
SPLIT_BYTES = 4 << 20
MAGIC = b"\x1f\x8b\x08"
_ID = re.compile(rb"<urn:page:(-?\d+|null)>")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def name(page: int | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A record as a gzip member; a revisit keeps the payload's length and digest only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def write(pages: DataFrame, folder: str, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Archives below folder; the manifest of finished files: path, bytes, records."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload")).withColumn("sha", F.sha1("payload"))
    newest = rows.groupBy("sha").agg(F.max("page_id").alias("newest"))  # keys and ids only, combined before the shuffle
    joined = rows.join(newest, "sha").select("page_id", "url", "payload", "newest", (~F.col("page_id").eqNullSafe(F.col("newest")) & (F.octet_length("payload") >= min_bytes)).alias("revisit"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stem = f"{TaskContext.get().partitionId():06d}"
        out, uri, held, n, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    uri, held, n = files.new_name(f"{folder}/warc", stem) + ".warc.gz", 0, 0
                    out = files.create(uri)
                page, link, text, newest_id, revisit = row
                data = record(page, link, text.encode(), newest_id, revisit)
                out.write(data)
                held, n = held + len(data), n + 1
                if held >= FILE_BYTES:
                    out.close()
                    done.append((uri, held, n))
                    out = None
        if out is not None:
            out.close()
            done.append((uri, held, n))
        if done:
            paths, sizes, counts = zip(*done, strict=True)
            yield pa.RecordBatch.from_pydict({"path": paths, "bytes": sizes, "records": counts})

    return checkpointed(joined.mapInArrow(archive, "path string, bytes long, records long"), folder, "warc_manifest")


def members(file: object, begin: int, end: int, step: int = 1 << 20) -> Iterator[bytes]:
    """The decoded records of the members that begin in begin .. end."""
    size = file.size()
    at, buffer, base = begin, b"", begin

    def more() -> bool:
        nonlocal buffer
        data = file.read_at(min(step, max(0, size - base - len(buffer))), base + len(buffer)) if base + len(buffer) < size else b""
        buffer += data
        return bool(data)

    while at < end:
        if at - base > step:
            buffer, base = buffer[at - base :], at
        place = buffer.find(MAGIC, at - base)
        if place < 0:
            at = max(at, base + len(buffer) - 2)
            if at >= end or not more():
                return
            continue
        at = base + place
        if at >= end:
            return
        unpack, out, used = zlib.decompressobj(31), [], at - base
        valid = None
        try:
            while not unpack.eof:
                if used >= len(buffer) and not more():
                    raise zlib.error("it ends within a member")
                given = buffer[used : used + 65536]
                used += len(given)
                out.append(unpack.decompress(given))
                if valid is None and sum(map(len, out)) >= 7:
                    valid = b"".join(out).startswith(b"WARC/1.")
                    if not valid:
                        raise zlib.error("no WARC header")
            if not valid:
                raise zlib.error("no WARC header")
        except zlib.error:
            at += 1
            continue
        used -= len(unpack.unused_data)
        yield b"".join(out)
        at = base + used


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of a record; checks lengths and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    block = rest[: int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)\ncontent-length:\s*(\d+)", http)[1])
    kind, claimed = fields[b"warc-type"].decode(), fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
    if kind == "response" and (len(payload) != length or digest(payload) != claimed):
        raise ValueError(f"record {fields[b'warc-record-id']!r} is damaged")
    number = lambda x: None if (m := _ID.fullmatch(x))[1] == b"null" else int(m[1])
    return number(fields[b"warc-record-id"]), length, claimed, kind, number(fields[b"warc-refers-to"]) if kind == "revisit" else None


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Per record of the archives in the manifest (path, bytes): page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = manifest.sparkSession
    prepare(spark)
    ranges = manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("begin"))
    ranges = ranges.select("path", "begin", F.least(F.col("begin") + split_bytes, "bytes").alias("end")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "begin")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with files.open_input(path) as file:
                    rows = [parse(x) for x in members(file, begin, end)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], names=names)

    return ranges.mapInArrow(scan, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
