"""Token ids of documents as length-delimited binary records.

A data file is a sequence of frames, little-endian throughout:

    length of the payload, unsigned 64 bits
    masked checksum of those 8 bytes, unsigned 32 bits
    payload: flags (1 byte: 1 has a doc_id, 2 ids are 32 bits wide, else 16), doc_id (8 bytes, signed), ids
    masked checksum of the payload, unsigned 32 bits
    one end byte, 0x00

A masked checksum is crc32 rotated right by 15 bits plus 0xA282EAD8, so that the
checksum of data that itself holds checksums stays informative. Files are named
part-N in ascending doc_id order, and so are the frames of each file. The offset
index is a Parquet table of its own: one row per frame with its file, offset,
length and doc_id, so that a shuffled reader fetches frames in any order.

Data files go through Spark's own file writer and its commit protocol: they are
atomic, survive task retries, and reach any file system that Spark writes to. Its
writer ends every row by a separator, which is the frame's end byte.
"""

from __future__ import annotations

import json
import os
import string
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Workspace, bound_arrow, kept, partitions
from .warc import opened

END_ID = 2
SHARD_BYTES = 16 << 20
_HEAD = struct.Struct("<QI")
#: A space or line end, and characters that are no white space.
_PLAIN = r"^[ \n][^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+\z"
_META = struct.Struct("<Bq")


def masked(data: bytes | memoryview) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    """A frame without its end byte, which the file writer adds."""
    payload = _META.pack((doc_id is not None) | wide << 1, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def frames(content: bytes | memoryview, whole: bool = True) -> Iterator[tuple[int, int, memoryview]]:
    """(offset, frame length, payload) of each frame of a file; ValueError where a checksum fails.

    Unless ``whole``, only the lengths' checksums are held against the bytes.
    """
    content, at = memoryview(content), 0
    while at < len(content):
        size, check = _HEAD.unpack_from(content, at)
        if masked(content[at : at + 8]) != check:
            raise ValueError(f"length checksum fails at {at}")
        payload = content[at + 12 : at + 12 + size]
        if whole and (masked(payload) != struct.unpack_from("<I", content, at + 12 + size)[0] or content[at + 16 + size]):
            raise ValueError(f"payload checksum fails at {at}")
        yield at, size + 17, payload
        at += size + 17


def head(payload: bytes | memoryview) -> tuple[int | None, int]:
    """doc_id and number of ids, without the ids."""
    flags, doc_id = _META.unpack_from(payload)
    return doc_id if flags & 1 else None, (len(payload) - _META.size) // (4 if flags & 2 else 2)


def parse(payload: bytes | memoryview) -> tuple[int | None, np.ndarray]:
    flags, doc_id = _META.unpack_from(payload)
    return doc_id if flags & 1 else None, np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=_META.size)


def _classes() -> np.ndarray:
    """By byte: 1 white space, 2 a letter, 3 a mark that always ends a word (an apostrophe may belong to one), 4 a byte of a longer character."""
    out = np.zeros(256, np.uint8)
    for kind, chars in ((1, "\t\n\v\f\r\x1c\x1d\x1e\x1f "), (2, string.ascii_letters), (3, string.punctuation.replace("'", ""))):
        out[list(chars.encode())] = kind
    out[128:] = 4
    return out


_CLASS = _classes()


def _wide_space(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space beyond ASCII begins at each place of ``at``."""
    a, b, c = (np.take(raw, at + k, mode="clip") for k in range(3))
    general = (b == 0x80) & ((c >= 0x80) & (c <= 0x8A) | np.isin(c, (0xA8, 0xA9, 0xAF))) | (b == 0x81) & (c == 0x9F)
    return (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & general | (a == 0xE3) & (b == 0x80) & (c == 0x80)


def cuts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin: ``raw`` are the texts' bytes and ``at`` their limits.

    A piece ends before a space or line end between two characters that are no white space, and between a letter and a mark.
    """
    kind = _CLASS[raw]
    start, edge = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 2, bool)
    edge[at] = True
    k = np.flatnonzero((raw == 32) | (raw == 10))
    k = k[(k > 0) & ~edge[k + 1]]
    before, after = kind[k - 1], kind[k + 1]
    good = (before != 1) & (after != 1)
    wide = np.flatnonzero(good & ((before == 4) | (after == 4)))
    w = k[wide]
    # a character of two bytes begins two bytes before, and its lead byte is none of a longer one's
    good[wide] = ~(_wide_space(raw, w + 1) | _wide_space(raw, np.maximum(w - 2, 0)) & (raw[np.maximum(w - 2, 0)] == 0xC2) | _wide_space(raw, np.maximum(w - 3, 0)) & (raw[np.maximum(w - 3, 0)] >= 0xE1))
    start[k[good]] = True
    m = np.flatnonzero(kind == 3)
    last = raw[m - 1]
    start[m[(kind[m - 1] == 2) | (raw[np.maximum(m - 2, 0)] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)]] = True
    start[at] = True
    return np.flatnonzero(start[:-1])


class Encoder:
    """Encodes whole texts, encoding each distinct piece once.

    A byte-level pre-tokenizer never joins text across a single space or line end that stands between two other characters, nor a letter and the
    mark after it, so a text cut there encodes as its pieces do. Pieces are cut, looked up and put together in Arrow and numpy. Texts with a
    special token's string are encoded as they are. Of the pieces seen last, between half of ``limit`` and ``limit`` are remembered, but none of
    more than 60 bytes.
    """

    def __init__(self, path: str, limit: int = 200_000):
        # its threads would wait for each other over the few new pieces of a text; Spark's tasks are the parallelism
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        #: Pieces that are remembered, their ids, and the block that last had them.
        self.words, self.ids, self.used, self.turn = pa.array([], pa.string()), pa.array([], pa.binary()), np.empty(0, np.int64), 0
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = np.dtype("<u4" if self.wide else "<u2")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        made = {k: made.get(k) for k in ("normalizer", "pre_tokenizer")}
        pre = made["pre_tokenizer"] or {}
        # a byte-level vocabulary writes a space and a line end as these two letters
        vocab = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.begins[[i for t, i in vocab.items() if t[0] in "\u0120\u010a"]] = True
        self.by_piece = made["normalizer"] is None and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) == ("ByteLevel", False, True)

    def __call__(self, text: str | None) -> bytes:
        return next(self.many([text]))

    def many(self, texts: list[str | None] | pa.Array, hold: int = 2_000_000) -> Iterator[bytes]:
        """Ids of each text; texts of about ``hold`` bytes are cut at once."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.string()).fill_null("")
        if not len(texts):
            return
        at = np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, texts.offset * 4).astype(np.int64)
        first = 0
        while first < len(texts):
            end = max(first + 1, int(np.searchsorted(at, at[first] + hold, "right")) - 1)
            yield from self._block(texts[first:end], at[first : end + 1])
            first = end

    def _block(self, texts: pa.Array, at: np.ndarray) -> Iterator[bytes]:
        if at[0] == at[-1]:
            yield from [b""] * len(texts)
            return
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0]))
        at, content = at - at[0], raw.tobytes()
        marked = [s.encode() for s in self.special if s.encode() in content] if self.by_piece else [b""]
        odd = {n for n in range(len(texts)) if any(s in content[at[n] : at[n + 1]] for s in marked)}
        alone = {n: np.array(self.tokenizer.encode(texts[n].as_py(), add_special_tokens=False).ids, self.kind).tobytes() for n in odd}
        if odd:
            content = b"".join(content[i:j] for n, (i, j) in enumerate(zip(at, at[1:])) if n not in odd)
            sizes = np.diff(at)
            sizes[list(odd)] = 0
            raw, at = np.frombuffer(content, np.uint8), np.concatenate([[0], np.cumsum(sizes)])
        starts = cuts(raw, at) if len(raw) else np.empty(0, np.int64)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(raw)).astype("<i4")), pa.py_buffer(content)).dictionary_encode()
        ids = self._known(pieces.dictionary).take(pieces.indices)
        ends = np.frombuffer(ids.buffers()[1], "<i4", len(ids) + 1, ids.offset * 4)[np.searchsorted(starts, at)].tolist() if len(ids) else [0] * len(at)
        out = memoryview(ids.buffers()[2] or b"")
        for n, (i, j) in enumerate(zip(ends, ends[1:])):
            yield alone[n] if n in odd else bytes(out[i:j])

    def _known(self, pieces: pa.StringArray) -> pa.BinaryArray:
        """Ids of each of distinct pieces, remembered or new."""
        at = pc.index_in(pieces, value_set=self.words)
        new = at.is_null()
        fresh = pieces.filter(new)
        ids, place = self._encoded(fresh)
        self.turn += 1
        held = at.drop_null().to_numpy()
        self.used[held] = self.turn
        index = np.empty(len(pieces), np.int64)
        index[new.to_numpy(zero_copy_only=False)] = len(self.words) + place
        index[at.is_valid().to_numpy(zero_copy_only=False)] = held
        every = pa.concat_arrays([self.ids, ids])
        short = pc.less_equal(pc.binary_length(fresh), 60)
        self.words = pa.concat_arrays([self.words, fresh.filter(short)])
        self.ids = pa.concat_arrays([self.ids, ids.take(pa.array(place)).filter(short)])
        self.used = np.append(self.used, np.full(len(self.words) - len(self.used), self.turn))
        if len(self.words) > self.limit:
            keep = np.sort(np.argsort(-self.used, kind="stable")[: self.limit // 2])
            self.words, self.ids, self.used = self.words.take(pa.array(keep)), self.ids.take(pa.array(keep)), self.used[keep]
        return every.take(pa.array(index))

    def _encoded(self, pieces: pa.StringArray, joined: int = 1000) -> tuple[pa.BinaryArray, np.ndarray]:
        """Ids of pieces in an order of its own, and each piece's place in it.

        Pieces of a space or line end and a word are encoded as one text, in which only their first tokens begin with either.
        """
        plain = pc.match_substring_regex(pieces, _PLAIN).to_numpy(zero_copy_only=False).astype(bool)
        part = pieces.filter(pa.array(plain))
        at = np.frombuffer(part.buffers()[1], "<i4", len(part) + 1, part.offset * 4) if len(part) else np.zeros(1, "<i4")
        content = memoryview(part.buffers()[2] or b"")
        ids, starts, size = [], [], 0
        for k in range(0, len(part), joined):
            end = min(len(part), k + joined)
            got = np.array(self.tokenizer.encode_batch_fast([str(content[at[k] : at[end]], "utf-8")], add_special_tokens=False)[0].ids, self.kind)
            first = np.flatnonzero(self.begins[got])
            if len(first) != end - k:
                raise ValueError("pieces do not begin with a token of their own")
            ids.append(got)
            starts.append(first + size)
            size += len(got)
        offsets = (np.concatenate([*starts, [size]]) * self.kind.itemsize).astype("<i4")
        data = np.concatenate([np.empty(0, self.kind), *ids]).tobytes()
        others = pieces.filter(pa.array(~plain)).to_pylist()
        alone = [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        place = np.empty(len(pieces), np.int64)
        place[plain], place[~plain] = np.arange(len(part)), len(part) + np.arange(len(others))
        return pa.concat_arrays([pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), pa.array(alone, pa.binary())]), place


def encoder(path: str) -> Encoder:
    """The worker process's encoder, which its tasks share."""
    return kept(("encoder", path), lambda: Encoder(path))


def encode_frames(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Rows (frame binary) in the order of ``docs``' rows, of its doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.kind).tobytes()
        for b in batches:
            ids = encode.many(b.column(1))
            out = [frame(i, t + end, encode.wide) for i, t in zip(b.column(0).to_pylist(), ids)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "frame binary")


def write_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Writes ``docs`` (doc_id, text) to ``path``/data and ``path``/index.

    Texts are dealt by ranges of doc_id into files of about ``shard_bytes`` of text
    (equal ids keep together unless their texts differ; null ids come first), so one
    shuffle of the texts gives the global order.
    Null and empty texts become the end id alone. Rows that repeat stay, in the order of
    a hash of their texts. An empty table writes no frame. Columns besides the two are ignored.
    """
    _write_data(spark, docs, tokenizer, path, end_id, shard_bytes)
    offsets(spark, path).write.parquet(f"{path}/index")


def _write_data(spark: SparkSession, docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    bound_arrow(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(max(1, -(-size // shard_bytes), partitions(spark) if size > shard_bytes else 1), *key)
    encoded = encode_frames(dealt.sortWithinPartitions(*key), tokenizer, end_id)
    encoded.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\0").option("compression", "none").text(f"{path}/data")


def _files(spark: SparkSession, path: str, read: Callable[[str, memoryview], Iterator[tuple]], fields: dict[str, str]) -> DataFrame:
    """Rows that ``read`` yields from the name and content of each data file, which its worker opens, so the JVM holds no whole file."""
    kinds = {"string": pa.string(), "long": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("files", dict)  # the encoder's pieces are not needed beside whole files
        for b in batches:
            for name, at in zip(*(c.to_pylist() for c in b.columns)):
                with opened(at) as file:
                    content = file.read()
                if rows := list(read(name, memoryview(content))):
                    yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(zip(*rows), fields.values())], list(fields))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    return files.select(F.regexp_extract("path", r"(part-\d+)[^/]*$", 1), "path").mapInArrow(run, ", ".join(f"{k} {v}" for k, v in fields.items()))


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, bytes, doc_id, n_tokens) of every frame of ``path``/data, from the frames' heads and the lengths' checksums."""

    def read(name: str, content: memoryview) -> Iterator[tuple]:
        for at, size, payload in frames(content, whole=False):
            yield name, at, size, *head(payload)

    return _files(spark, path, read, {k: _SCANNED[k] for k in ("file", "at", "bytes", "doc_id", "n_tokens")})


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Reads every frame of ``path``/data, checking both checksums.

    Rows: file, at (offset), bytes (length of the frame), nth (its place in the file), doc_id, n_tokens,
    before (tokens of the file before it), ids_crc32 (of the ids as unsigned 32-bit integers).
    A file is read in one piece, so one text's ids must stay below two gigabytes.
    """

    def read(name: str, content: memoryview) -> Iterator[tuple]:
        before = 0
        for n, (at, size, payload) in enumerate(frames(content)):
            doc_id, ids = parse(payload)
            yield name, at, size, n, doc_id, len(ids), before, zlib.crc32(ids.astype("<u4"))
            before += len(ids)

    return _files(spark, path, read, _SCANNED)


_SCANNED = {"file": "string", "at": "long", "bytes": "long", "nth": "long", "doc_id": "long", "n_tokens": "long", "before": "long", "ids_crc32": "long"}


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in ``path``; start counts all ids before it."""
    return _with_starts(scan(spark, path), spark.read.parquet(f"{path}/index"))


def _with_starts(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Only the totals of files meet in one task: a row each, of files of bounded size."""
    order = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return rows.join(starts, "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def read_shuffled(spark: SparkSession, path: str, seed: int = 0) -> DataFrame:
    """(doc_id, frame) in an order drawn by ``seed``: the index is shuffled, and its offsets cut the frames out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    content = files.select(F.regexp_extract("path", r"(part-\d+)[^/]*$", 1).alias("file"), "content")
    cut = spark.read.parquet(f"{path}/index").join(content, "file").select(
        "doc_id", F.substring("content", F.col("at").cast("int") + 1, F.col("bytes").cast("int")).alias("frame"), F.xxhash64(F.lit(seed), "file", "at").alias("_r")
    )
    return cut.orderBy("_r").drop("_r")


def token_table(spark: SparkSession, docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Writes ``docs`` as token records, by default to a folder of the shared root, and reads them back.

    The files are read whole once, with both checksums; what that finds is kept as a table, of which the index is a part.
    """
    ws = Workspace(spark, "tokens")
    path = path or ws.folder("records")
    _write_data(spark, docs, tokenizer, path)
    rows = ws.table(scan(spark, path), "scanned")
    rows.select("file", "at", "bytes", "doc_id", "n_tokens").write.parquet(f"{path}/index")
    return _with_starts(rows, rows)
