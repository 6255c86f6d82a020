"""Quality classifier by compression.

Two zstandard dictionaries are built, one from chunks of texts labelled good and one from bad ones.
A text is cut into chunks of ``CHUNK`` bytes, each compressed with either dictionary, so every part of a long text
meets the dictionaries as its start does. The difference of the compressed sizes over the plain size is
all that a score knows of a text: it is the bytes that the good dictionary saves beyond the bad one, and near nothing where
a text repeats itself, as both then save the same. A logistic regression with bends at the difference's own quantiles calibrates it to a probability, on
labelled texts that the dictionaries have not seen.

Only the fit uses a bounded sample of labelled rows: ``Sample`` documents its bounds. Scores cover whole texts of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import bound_arrow, kept

CHUNK, DICTIONARY, LEVEL, THRESHOLD = 1024, 112 << 10, 3, 0.3
#: Quantiles of the difference at which the calibration bends.
BENDS = (0.05, 0.1, 0.2, 0.35, 0.6, 0.9)


class Sample(NamedTuple):
    """Labelled rows of each class used at most (half of them for the dictionaries, half to calibrate), and chunks of each class for a dictionary."""

    rows: int = 3000
    chunks: int = 3000


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the doc_id as text, modulo n; null for null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def chunks(text: str | None) -> list[bytes]:
    b = (text or "").encode("utf-8", "surrogatepass")
    return [b[k : k + CHUNK] for k in range(0, len(b), CHUNK)]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY:] or b" " * 8


class Sizes:
    """Compressed sizes of texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = (zstandard.ZstdCompressor(level=LEVEL, dict_data=self._load(d), write_content_size=False, write_dict_id=False) for d in (good, bad))

    @staticmethod
    def _load(d: bytes) -> zstandard.ZstdCompressionDict:
        out = zstandard.ZstdCompressionDict(d)
        out.precompute_compress(level=LEVEL)
        return out

    def __call__(self, text: str | None) -> float:
        """Compressed bytes under the bad dictionary less those under the good one, for each plain byte; 0 for an empty text."""
        g = b = n = 0
        for c in chunks(text):
            g += len(self.good.compress(c))
            b += len(self.bad.compress(c))
            n += len(c)
        return (b - g) / n if n else 0.0


def features(d: np.ndarray, bends: np.ndarray) -> np.ndarray:
    """The difference, and how far it lies beyond each bend."""
    return np.column_stack([np.clip(d, -1, 1), *(np.maximum(d - c, 0) for c in bends)])


class Logistic(NamedTuple):
    bends: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def __call__(self, d: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.ones(len(d)), (features(d, self.bends) - self.mean) / self.scale]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibrate(d: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> Logistic:
    """Newton's method; without rows of both classes the score is near their class, or a half."""
    bends = np.unique(np.quantile(d, BENDS)) if len(set(y)) > 1 else np.empty(0)
    if len(set(y)) < 2:
        return Logistic(bends, np.zeros(1), np.ones(1), np.array([{0: -4.0, 1: 4.0}.get(int(y[0]), 0.0) if len(y) else 0.0, 0]))
    f = features(d, bends)
    mean, scale = f.mean(0), f.std(0) + 1e-9
    z, w = np.column_stack([np.ones(len(f)), (f - mean) / scale]), np.zeros(1 + f.shape[1])
    pull = ridge * len(f) * np.array([0.0] + [1.0] * f.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull + 1e-9), z.T @ (p - y) + pull * w)
    return Logistic(bends, mean, scale, w)


class Model(NamedTuple):
    good: bytes
    bad: bytes
    calibration: Logistic


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, sample: Sample = Sample()) -> Model:
    """Learns from ``labels`` (doc_id, quality 0 or 1) of rows outside the held-out fold; null labels and ids teach nothing.

    Labels are drawn by a hash of doc_id, so the sample is the same on every run and bounded by ``sample``.
    """
    bound_arrow(spark)
    known = labels.where((fold(F.col("doc_id"), folds) != held_out) & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    drawn = None
    for q in (0, 1):
        some = known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample.rows)
        drawn = some if drawn is None else drawn.unionByName(some)
    drawn = drawn.distinct().withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)))
    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(drawn), "doc_id")  # at most 2 * sample.rows labels

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(q, d, n, c) for d, t, q in zip(*(c.to_pylist() for c in b.columns)) for n, c in enumerate(chunks(t))]
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["quality", "doc_id", "nth", "chunk"])

    pieces = rows.where("half = 0").select("doc_id", "text", F.col("quality").cast("int")).mapInArrow(cut, "quality int, doc_id long, nth long, chunk binary")
    chosen = {}
    for q in (0, 1):
        some = pieces.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id", "nth"), "chunk").limit(sample.chunks)
        chosen[q] = dictionary([bytes(r.chunk) for r in some.collect()])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(chosen[1], chosen[0])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([sizes(t.as_py()) for t in b.column(0)], pa.float64())], ["quality", "d"])

    got = rows.where("half = 1").select("text", F.col("quality").cast("int")).mapInArrow(measure, "quality int, d double").orderBy("d", "quality").collect()
    return Model(chosen[1], chosen[0], calibrate(np.array([r.d for r in got], dtype=float), np.array([r.quality for r in got], dtype=float)))


def score(spark: SparkSession, docs: DataFrame, model: Model, column: str = "text", output: str = "score") -> DataFrame:
    """``docs`` with a double in [0, 1] in ``output`` (replacing a column of that name): higher where label 1 is likelier.

    Null and empty texts differ by nothing either way and get the calibrated score of that. Texts are compressed whole, a chunk at a time; rows that repeat
    score alike, and an empty table gives an empty result.
    """
    bound_arrow(spark)

    return docs.withColumn(output, _scorer(model)(F.col(column).cast("string")))


def _scorer(model: Model):
    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = kept(("sizes", model.good, model.bad), lambda: Sizes(model.good, model.bad))
        for t in texts:
            yield pd.Series(model.calibration(np.array([sizes(x) for x in t], dtype=float)), dtype="float64")

    return scored


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score and predicted (1 where the score reaches ``threshold``), learned outside the held-out fold.

    Columns of those names are replaced. A null doc_id is in no fold: it is not held out and teaches nothing.
    """
    scored = score(spark, docs, fit(spark, docs, labels, folds, held_out))
    out = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    return scored.withColumns({"held_out": out, "predicted": (F.col("score") >= threshold).cast("int")})
