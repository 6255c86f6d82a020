"""Embedding near-dedup by cross-polytope hashing.

A vector is rotated at random (three rounds of random signs and a fast Hadamard transform) and hashed to the signed axis
nearest to it; ``functions`` of these hashes make a bucket code, and ``TABLES`` or more independent codes are taken. Besides
its own bucket a vector looks into the ``PROBES`` buckets that it misses by least in each table. Short vectors are padded to ``LEAST_AXES`` axes first, as
there are too few rotations of a plane for tables to be independent.

Buckets get sketches, not vectors: some axes of one more rotation, rounded, and the length of the rest, which bound a cosine from
above. Vectors whose bound with another of their bucket reaches the threshold are compared there exactly, in double precision. Large
buckets are cut into blocks, so a hot bucket feeds many tasks and pairs are never listed. A pair that meets several times counts where it meets first.

``functions`` grows with the logarithm of the vectors of the largest label, so buckets stay small however many there are. A pair
meets less often in a table of more functions, so the tables grow with them.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import forest, grouped, link_rows, own_pairs
from .components import connected_components
from .store import Workspace, bound_arrow, broadcast_within, partitions

THRESHOLD, TABLES, PROBES, SEED = 0.98, 6, 3, 17
#: Vectors that a bucket should hold about, and members of a block of a larger bucket.
BUCKET, BLOCK = 64, 512
#: Axes to which short vectors are padded; axes of a sketch, at least and as a share of all; what rounding may take from a bound.
LEAST_AXES, SKETCH, SKETCH_SHARE, SLACK = 64, 16, 4, 0.005
#: Large buckets up to which a join broadcasts them (about 60 bytes each).
MANY_BUCKETS = 100_000


def tables_for(functions: int) -> int:
    """Independent tables for codes of so many functions."""
    return TABLES + 4 * max(0, functions - 2)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, whose length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def axes_of(dim: int) -> int:
    """A power of two, of at least the dimension and ``LEAST_AXES``."""
    return max(LEAST_AXES, 1 << max(0, dim - 1).bit_length())


def rotated(x: np.ndarray, table: int, function: int) -> np.ndarray:
    """Rows padded to ``axes_of`` their dimension and rotated as this hash function does."""
    n = axes_of(x.shape[1])
    x = np.pad(x, ((0, 0), (0, n - x.shape[1])))
    rng = np.random.default_rng([SEED, table, function, n])
    for _ in range(3):
        x = hadamard(x * rng.choice((-1.0, 1.0), n))
    return x


def codes(x: np.ndarray, functions: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """(row, table, 1 + probes) bucket codes of unit vectors, the own bucket first and then those missed by least."""
    out = np.empty((len(x), tables, 1 + probes), np.int64)
    rows = np.arange(len(x))[:, None]
    for t in range(tables):
        axes, gaps = [], []
        for f in range(functions):
            y = rotated(x, t, f)
            n = y.shape[1]
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, : probes + 1]
            if top.shape[1] <= probes:
                top = np.pad(top, ((0, 0), (0, probes + 1 - top.shape[1])), mode="edge")
            value = np.take_along_axis(y, top, axis=1)
            axes.append(top + n * (value < 0))
            gaps.append((np.abs(value[:, :1]) - np.abs(value)) ** 2)
        # every choice of an axis for each function, by what it gives away
        choices = [c for c in itertools.product(range(probes + 1), repeat=functions) if sum(c) <= probes + 1]
        cost = np.stack([sum(gaps[f][:, c[f]] for f in range(functions)) for c in choices], axis=1)
        best = np.argsort(cost, axis=1, kind="stable")[:, : probes + 1]
        code = np.stack([sum(axes[f][:, c[f]] * (2 * n) ** f for f in range(functions)) for c in choices], axis=1)
        out[:, t] = code[rows, best]
    return out


def sketch(x: np.ndarray) -> np.ndarray:
    """(row, 1 + axes) of unit vectors in half precision: some axes of a rotation, and first the length of what the others hold."""
    y = rotated(x, 1 << 20, 0)[:, : max(SKETCH, axes_of(x.shape[1]) // SKETCH_SHARE)] if x.shape[1] > SKETCH else np.pad(x, ((0, 0), (0, SKETCH - x.shape[1])))
    rest = np.sqrt(np.maximum(0.0, 1 - (y * y).sum(1, keepdims=True)))
    return np.concatenate([rest, y], axis=1).astype(np.float16)


def bounds(s: np.ndarray) -> np.ndarray:
    """The least number that no cosine of two rows exceeds, from their sketches."""
    s = s.astype(np.float32)
    return s @ s.T + SLACK


def _coded(rows: DataFrame, functions: int) -> DataFrame:
    """(h, copies, label, dim, vector, sketch, codes) of rows (h, copies, label, embedding): doubles, halves and bucket codes by table and probe as bytes and numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(3)
            sizes = np.array([len(v) for v in vectors])
            codes_, sketches, doubles = ([None] * len(vectors) for _ in range(3))
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = unit(np.array([vectors[int(i)].as_py() for i in at], dtype=np.float64))
                for i, c, s, v in zip(at, codes(x, functions, tables_for(functions)).reshape(len(at), -1), sketch(x), x):
                    codes_[i], sketches[i], doubles[i] = c, s.tobytes(), v.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sizes, pa.int32()), pa.array(doubles, pa.binary()), pa.array(sketches, pa.binary()), pa.array(codes_, pa.list_(pa.int64()))], ["h", "copies", "label", "dim", "vector", "sketch", "codes"])

    return rows.mapInArrow(run, "h long, copies long, label string, dim int, vector binary, sketch binary, codes array<bigint>")


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so neither tiny nor huge components lose their digits."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _meets(threshold: float):
    """Members (h, right, table, bucket, unit) of a unit that may link with another there, by their sketches."""

    def near(held: dict[str, list]) -> list[tuple]:
        may = bounds(np.stack([np.frombuffer(s, np.float16) for s in held["sketch"]])) >= threshold
        right = np.array(held["right"])
        np.fill_diagonal(may, False)
        if right.any() and not right.all():
            may &= right[:, None] != right[None, :]
        return [(held["h"][i], int(right[i]), held["table"][i], held["bucket"][i], held["unit"][i]) for i in np.flatnonzero(may.any(1))]

    return near


def _compare(threshold: float):
    def links(held: dict[str, list]) -> list[tuple]:
        x = np.stack([np.frombuffer(v, np.float64) for v in held["vector"]])
        ids, copies, right, t, bucket = held["h"], np.array(held["copies"]), np.array(held["right"]).astype(bool), held["table"][0], held["bucket"][0]
        linked = x @ x.T >= threshold
        if right.any() and not right.all():
            linked &= right[:, None] != right[None, :]
        a, b = np.nonzero(np.triu(linked, 1))
        c = np.array(held["codes"]).reshape(len(ids), -1, 1 + PROBES)
        # they meet in each bucket of a table that both are in or look into
        common = lambda s: (c[a, s, :, None] == c[b, s, None, :]).any(2)
        edges = forest(_symmetric(a, b, len(ids)))
        first = np.ones(len(a), bool)
        for s in range(t):
            first &= ~common(s).any(1)
        # and of the buckets of this table in which they meet, in the least
        first &= np.where(common(t), c[a, t], np.iinfo(np.int64).max).min(1) == bucket
        n = np.bincount(a[first], copies[b[first]], len(ids)) + np.bincount(b[first], copies[a[first]], len(ids))
        return link_rows({ids[i]: int(n[i]) for i in np.flatnonzero(n)}, [(ids[i], ids[j]) for i, j in edges])

    return links


def _symmetric(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, n), bool)
    out[a, b] = out[b, a] = True
    return out


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label).

    Vectors link when their labels are equal, their dimensions too, and their cosine is at least ``threshold``. A null label or id, and a vector that is null,
    empty, zero or holds a null or non-finite component, links with nothing. n_links counts the other vectors linked directly; equal vectors of a label
    are hashed once (known by 64-bit keys), and rows that repeat a vec_id are one vector. kept marks the least vec_id of each
    component. Other columns are ignored; an empty table gives an empty result.
    """
    bound_arrow(spark, 2000)
    ws = Workspace(spark, "embeddings")
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string"))
    sound = F.forall("embedding", lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)) & ~F.isnan(e)) & F.exists("embedding", lambda e: e != 0)
    v = v.withColumn("ok", F.coalesce(sound, F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    v = ws.table(v.withColumn("h", F.when(F.col("ok"), F.xxhash64("label", "embedding"))), "vectors")
    # a class for each distinct vector of a label
    equal = v.where("ok").groupBy("h").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    equal = ws.table(equal, "equal")
    sizes = equal.groupBy("label", F.size("embedding").alias("dim")).count().agg(F.max("count"), F.max("dim")).first()
    most, dim = sizes[0] or 0, sizes[1] or 1
    functions = max(1, math.ceil(math.log(max(1, most / BUCKET)) / math.log(2 * axes_of(dim))))
    coded = ws.table(_coded(equal.select("h", "copies", "label", "embedding"), functions), "coded")

    each = F.explode(F.array_distinct(F.transform("codes", lambda c, n: F.struct(F.floor(n / (1 + PROBES)).cast("int").alias("table"), c.alias("bucket")))))
    met = coded.select("h", "label", "dim", "sketch", each.alias("m")).select("h", F.xxhash64("label", "dim", "m.table", "m.bucket").alias("at"), "sketch", "m.table", "m.bucket")
    large = ws.table(met.groupBy("at").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1").withColumnRenamed("at", "_at"), "large")
    met = met.join(broadcast_within(large, large.count(), MANY_BUCKETS), F.col("at") == F.col("_at"), "left")
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    met = met.select("h", "at", "table", "bucket", "sketch", F.explode(own_pairs(F.pmod(F.xxhash64("h"), blocks), blocks)).alias("p"))
    met = met.select("h", "table", "bucket", "sketch", "p.right", F.xxhash64("at", "p.i", "p.j").alias("unit"))
    near = ws.table(grouped(met, "unit", _meets(threshold), partitions(spark), "h long, right long, table long, bucket long, unit long"), "near")
    rows = near.join(coded, "h").select("unit", "h", "copies", "vector", "codes", "table", "bucket", "right")
    pairs = ws.table(grouped(rows, "unit", _compare(threshold), partitions(spark)), "links")

    counts = pairs.where("other IS NULL").groupBy(F.col("node").alias("h")).agg(F.sum("links").alias("links"))
    # components of classes, then of the ids that share them
    edges = pairs.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
    comp = connected_components(ws, edges).join(equal.select(F.col("h").alias("node"), "rep"), "node")
    least = comp.join(comp.groupBy("component").agg(F.min("rep").alias("least")), "component").select(F.col("node").alias("h"), "least")
    by_class = ws.table(equal.select("h", "rep", "copies").join(least, "h", "left").join(counts, "h", "left").select("h", F.coalesce("least", "rep").alias("class"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n")), "classes")
    member = v.where("ok").select("vec_id", "h").distinct().join(by_class, "h")
    by_id = ws.table(member.groupBy("vec_id").agg(F.sum("n").alias("n_links"), F.min("class").alias("low"), F.max("class").alias("high")), "ids")
    # ids of several vectors join the components of all
    bridges = member.join(by_id.where("low <> high").select("vec_id", "low"), "vec_id").where("class <> low").select(F.col("class").alias("a"), F.col("low").alias("b"))
    whole = connected_components(ws, bridges).select(F.col("node").alias("low"), F.col("component").alias("whole"))
    out = v.select("vec_id").join(by_id, "vec_id", "left").join(whole, "low", "left").withColumn("component_id", F.coalesce("whole", "low", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("component_id").eqNullSafe(F.col("vec_id")).alias("kept"))
