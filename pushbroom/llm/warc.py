"""WARC archives: a writer, and a reader that splits compressed archives by byte ranges.

Every record is a gzip member of its own, as the format asks for. A reading task gets
a byte range, looks for gzip's magic bytes in it, and takes a place for the start of a
member only if what follows decodes to a WARC header; it owns the records that start in
its range and reads past the range's end to finish the last. Members are decoded to
their end with gzip's own checksum, and blocks are held against their declared length and digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Workspace, bound_arrow, broadcast_within, partitions

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 8 << 20
#: Digests that repeat up to which they are broadcast (about 80 bytes each).
MANY_DIGESTS = 200_000
_CHUNK = 1 << 18
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def _line(value: str) -> bytes:
    """A header value on one line: percent signs and control characters are percent-encoded."""
    return b"".join(b"%%%02X" % c if c < 32 or c in (37, 127) else bytes([c]) for c in value.encode("utf-8", "surrogatepass"))


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A record as gzip bytes that end in a zero byte.

    gzip ends with the upper byte of the length, zero below 16 MiB; a longer record is
    followed by an empty member, which ends in zero and decodes to nothing.
    """
    http = _HTTP % len(payload)
    block = http if revisit else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + record_id(page_id, url).encode(), b"WARC-Date: 2000-01-01T00:00:00Z"]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _line(url))
    if page_id is not None:
        head.append(b"X-Page-ID: %d" % page_id)
    head += [b"WARC-Payload-Digest: sha1:" + digest.encode(), b"X-Payload-Length: %d" % len(payload)]
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"X-Refers-To-Page-ID: %d" % refers_to]
    head += [b"WARC-Block-Digest: sha1:" + base32_sha1(block).encode(), b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = z.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()
    return out if out[-1] == 0 else out + _EMPTY


_EMPTY = (lambda z: z.compress(b"") + z.flush())(zlib.compressobj(6, zlib.DEFLATED, 31))


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, payload) with digest, refers_to and revisit.

    Of records with equal payloads of at least ``min_bytes`` bytes, those with the smallest page_id are responses and
    the others revisit it; smaller payloads are all responses, and so is a group whose ids are all
    null. A null payload is an empty one. A null id is never referred to and revisits where any id is known.
    """
    full = pages.select("page_id", "url", F.coalesce("payload", F.lit(b"")).alias("payload"))
    full = full.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    # ids and digests only; map-side counts keep a digest of a third of all rows from one task
    first = full.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = Workspace(pages.sparkSession, "warc").table(first.where("n > 1 AND first IS NOT NULL").drop("n"), "first")
    # payloads stay where they are if the digests that repeat are few enough to send
    first = broadcast_within(first, first.count(), MANY_DIGESTS)
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return full.join(first, ["digest", "size"], "left").select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_warc(spark: SparkSession, pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Writes a record per row of ``pages`` (page_id, url, payload binary) into archives below ``path``.

    Spark's own file writer puts the files in place, so retries leave no half archive. It
    ends each row by a separator byte, and that is the last, zero byte of each gzip member. Columns
    besides the three are ignored; an empty table writes no record. A payload of any length that fits a row is written whole.
    """
    bound_arrow(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [member(i, u, p, base32_sha1(p), r, v)[:-1] for i, u, p, r, v in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["z"])

    rows = plan_records(pages, min_bytes).mapInArrow(run, "z binary")
    rows.select(F.col("z").cast("string").alias("value")).write.option("lineSep", "\0").option("compression", "none").text(path)


def opened(path: str):
    """A file object of random access for a URI; local ones need no more than ``open``."""
    at = urlparse(path)
    if at.scheme in ("", "file"):
        return open(unquote(at.path) if at.scheme else path, "rb")  # noqa: SIM115
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


class _Bytes:
    """Bytes of a file from any place on. ``at`` keeps a window that grows as far as it is asked to and forgets what lies before; ``peek`` keeps nothing."""

    def __init__(self, file):
        self.file, self.base, self.data = file, 0, b""

    def at(self, start: int, size: int) -> bytes:
        if start < self.base or start > self.base + len(self.data):
            self.base, self.data = start, b""
        while len(self.data) < start - self.base + size:
            self.file.seek(self.base + len(self.data))
            more = self.file.read(max(_CHUNK, size))
            if not more:
                break
            self.data += more
        return self.data[start - self.base : start - self.base + size]

    def peek(self, start: int, size: int) -> bytes:
        if self.base <= start and start + size <= self.base + len(self.data):
            return self.data[start - self.base : start - self.base + size]
        self.file.seek(start)
        return self.file.read(size)

    def forget(self, before: int) -> None:
        if before - self.base > 4 * _CHUNK:
            self.data, self.base = self.data[before - self.base :], before


def _member_at(src: _Bytes, at: int) -> tuple[bytes, int] | None:
    """(record, end) if a gzip member that holds a WARC record starts at ``at``. Of a long member only the decoded record is held, as its row will be."""
    z, out, pos = zlib.decompressobj(31), [], at
    try:
        probe = z.decompress(src.at(at, 512), 8)
        if len(probe) >= 6 and not probe.startswith(b"WARC/1"):
            return None
        z, n = zlib.decompressobj(31), 0
        while not z.eof:
            data = src.peek(pos, _CHUNK)
            if not data:
                return None
            out.append(z.decompress(data))
            n += len(out[-1])
            pos += len(data)
            if out and n >= 6 and not b"".join(out[:2]).startswith(b"WARC/1"):
                return None
    except zlib.error:
        return None
    record = b"".join(out)
    return (record, pos - len(z.unused_data)) if record.startswith(b"WARC/1") else None


def records_in(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record bytes) of the records whose gzip member starts in [start, end)."""
    src, at = _Bytes(file), start
    while at < end:
        window = src.at(at, min(_CHUNK, end - at) + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        if hit < 0:
            if len(window) < len(MAGIC):
                return
            at += len(window) - len(MAGIC) + 1
            src.forget(at)
            continue
        at += hit
        if at >= end:
            return
        if found := _member_at(src, at):
            yield at, found[0]
            at = found[1]
        else:
            at += 1
        src.forget(at)


def parse(record: bytes, payloads: bool = True) -> tuple:
    """A record's row; ValueError where its length or a digest does not hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"Content-Length"])]
    if len(block) != int(fields[b"Content-Length"]) or rest[len(block) :] != b"\r\n\r\n" or fields[b"WARC-Block-Digest"][5:].decode() != base32_sha1(block):
        raise ValueError(f"damaged record {fields.get(b'WARC-Record-ID')!r}")
    digest, size, kind = fields[b"WARC-Payload-Digest"][5:].decode(), int(fields[b"X-Payload-Length"]), fields[b"WARC-Type"].decode()
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged payload {fields.get(b'WARC-Record-ID')!r}")
    number = lambda k: int(fields[k]) if k in fields else None
    url = unquote(fields[b"WARC-Target-URI"].decode("utf-8", "surrogatepass"), errors="surrogatepass") if b"WARC-Target-URI" in fields else None
    return number(b"X-Page-ID"), size, digest, kind, number(b"X-Refers-To-Page-ID"), url, payload if payloads else None


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload) of the archives below ``path``.

    Archives are cut into ranges of ``split_bytes`` whatever records lie there, so one archive feeds many
    tasks. A revisit's payload is null: its response holds it; its digest and length are those of the full payload.
    """
    bound_arrow(spark, 2000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [f.split()[0] for f in _FIELDS.split(", ")]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        for b in batches:
            for name, start, end in zip(*(c.to_pylist() for c in b.columns)):
                with opened(name) as file:
                    rows, held = [], 0
                    for _, record in records_in(file, start, end):
                        rows.append(parse(record, payloads))
                        held += len(record) if payloads else 0
                        if len(rows) >= 2000 or held > 8 << 20:
                            yield pack(rows)
                            rows, held = [], 0
                    if rows:
                        yield pack(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length").where("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.select("path", "length", starts.alias("start")).select("path", "start", F.least("length", F.col("start") + split_bytes).alias("end"))
    return ranges.repartition(partitions(spark), "path", "start").mapInArrow(run, _FIELDS)
