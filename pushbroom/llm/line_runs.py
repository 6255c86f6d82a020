"""Line dedup over levelled sorted runs of line hashes.

Each batch of documents contributes its lines' keys as 128-bit hashes, with the number of documents and the largest doc_id of each. A run is a table of
distinct keys in buckets by key, sorted there, so a new batch, dealt and sorted once, is merged with the runs bucket by bucket; the runs themselves are
neither shuffled nor sorted again but where they are compacted. Keys that no run has (the anti-join) become a run of their own at level 0; the others stay in the batch's table as a log of
repeats, so every key is in one run only. When a level has ``FANOUT`` runs they are merged into one run of the next level, so a batch meets
a number of runs that grows with the logarithm of the batches.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Workspace, bound_arrow, broadcast_within, partitions

MIN_POINTS, MIN_DOCS, BATCHES, FANOUT = 20, 3, 4, 3
#: Common keys up to which they are broadcast (about 40 bytes each).
MANY_KEYS = 200_000
_KEY = ["k1", "k2"]


def line_key(line: bytes) -> bytes:
    """A line without white space at both ends, A-Z lower-cased."""
    return line.strip().lower()


def counted(key: bytes, least: int = MIN_POINTS) -> bool:
    """Whether a key has at least so many code points."""
    return len(key) >= least and (len(key) >= 4 * least or sum(b & 0xC0 != 0x80 for b in key) >= least)


def key_hash(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


def _encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def line_keys(docs: DataFrame, least: int = MIN_POINTS) -> DataFrame:
    """(doc_id, same, k1, k2): the distinct hashed keys of each row's lines. same tells rows without a doc_id apart by their texts; it is 0 for others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, same, k1, k2 = [], [], [], []
            for d, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                keys = {k for k in map(line_key, _encode(t.as_py()).split(b"\n")) if counted(k, least)}
                for a, c in map(key_hash, keys):
                    ids.append(d)
                    same.append(h)
                    k1.append(a)
                    k2.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, same, k1, k2)], ["doc_id", "same", *_KEY])

    return _told_apart(docs).mapInArrow(run, "doc_id long, same long, k1 long, k2 long")


def _told_apart(docs: DataFrame) -> DataFrame:
    """(doc_id, same, text)."""
    i, t = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(i.alias("doc_id"), F.when(i.isNull(), F.xxhash64(t)).otherwise(0).alias("same"), t.alias("text"))


class LineRuns:
    """The runs, and the batches' own tables with their repeats, in one workspace. Runs have the columns k1, k2, docs, last and old, which is false."""

    def __init__(self, ws: Workspace, fanout: int = FANOUT):
        self.ws, self.fanout, self.levels, self.batches = ws, fanout, defaultdict(list), []

    def runs(self) -> list[DataFrame]:
        return [r for level in sorted(self.levels) for r in self.levels[level]]

    def add(self, keys: DataFrame) -> DataFrame:
        """Adds a batch of (doc_id, k1, k2) and returns its fresh keys: those that no batch before it had."""
        batch = keys.groupBy(*_KEY).agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
        old = F.lit(False)
        for n, r in enumerate(self.runs()):
            batch = batch.join(r.select(*_KEY, F.lit(True).alias(f"_in{n}")).hint("merge"), _KEY, "left")
            old = old | F.coalesce(f"_in{n}", F.lit(False))
        whole = self.ws.sorted_table(batch.select(*_KEY, "docs", "last", old.alias("old")), "run", _KEY)
        self.batches.append(whole)
        fresh = whole.where("NOT old")
        self.levels[0].append(fresh)
        self.compact()
        return fresh

    def compact(self) -> None:
        """Merges the runs of every full level into one run of the next."""
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs = self.levels.pop(level)
            merged = _union(runs).repartition(partitions(self.ws.spark), *_KEY)  # else each run would leave a file of its own in a bucket
            self.levels[level + 1].append(self.ws.sorted_table(merged, "merged", _KEY))
            level += 1

    def totals(self) -> DataFrame | None:
        """(k1, k2, docs, last) over all batches."""
        if not self.batches:
            return None
        return _union(self.batches).groupBy(*_KEY).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def repeated_lines(spark: SparkSession, docs: DataFrame, least: int = MIN_POINTS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, same, drops array<struct<k1,k2>>): for each document, the keys whose lines it loses.

    Keys of at least ``least`` code points in at least ``min_docs`` documents lose their lines
    everywhere but in the largest doc_id that holds them (all its rows, if it repeats; null ids count as documents,
    and are never the largest unless all are null). The documents are read once and split into ``batches`` by a hash of doc_id, or of the text without one.
    """
    bound_arrow(spark)
    ws = Workspace(spark, "lines")
    keys = line_keys(docs, least).withColumn("batch", F.pmod(F.xxhash64("doc_id", "same"), F.lit(batches)).cast("int"))
    keys = ws.table(keys, "keys", by="batch")
    runs = LineRuns(ws)
    for n in range(batches):
        runs.add(keys.where(F.col("batch") == n).drop("batch"))
    common = ws.table(runs.totals().where(F.col("docs") >= min_docs).select(*_KEY, "last"), "common")
    drops = keys.join(broadcast_within(common, common.count(), MANY_KEYS), _KEY).where("NOT doc_id <=> last").select("doc_id", "same", F.struct(*_KEY).alias("k"))
    return ws.table(drops.groupBy("doc_id", "same").agg(F.collect_set("k").alias("drops")), "drops")


def dedup_lines(spark: SparkSession, docs: DataFrame, least: int = MIN_POINTS, min_docs: int = MIN_DOCS, batches: int = BATCHES, texts: bool = True) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256 and, if ``texts``, text) for each row of ``docs`` (doc_id, text).

    Null and empty texts are one empty line, which stays. Lines shorter than ``least`` code points stay. Equal rows are each a document, and so are rows without a doc_id.
    A text is split whole, whatever its length. Columns besides the two are ignored; an empty table gives an empty result.
    """
    drops = repeated_lines(spark, docs, least, min_docs, batches).toDF("_d", "_s", "drops")
    rows = _told_apart(docs).join(drops, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("same") == F.col("_s")), "left").select("doc_id", "text", "drops")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, t, gone in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                lines = kept = _encode(t.as_py()).split(b"\n")
                if gone:
                    gone = {(g["k1"], g["k2"]) for g in gone}
                    kept = [x for x in lines if not (counted(k := line_key(x), least) and key_hash(k) in gone)]
                text = b"\n".join(kept)
                out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256(text).hexdigest()) + ((text.decode("utf-8", "surrogatepass"),) if texts else ()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            cols = list(zip(*out)) if out else [[]] * (4 + texts)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "n_lines", "n_dropped", "kept_sha256", "text"][: 4 + texts])

    return rows.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", text string" * texts)
