"""Look-up tables of the detector, and what is computed from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import radiometry as R


def denoise(lut: DataFrame, gain_z: float, offset_z: float, keys: tuple[str, ...] = ("exp_gain",)) -> DataFrame:
    """Gains and offsets NULL where they stray from the median of five neighbouring samples of their band.

    ``lut`` is (keys, band, x, gain, offset). A residual counts in standard deviations of all residuals of the table.
    """
    near = Window.partitionBy(*keys, "band").orderBy("x").rowsBetween(-2, 2)
    whole = Window.partitionBy(*keys)
    for c, z in (("gain", gain_z), ("offset", offset_z)):
        lut = lut.withColumn("_r", F.col(c) - F.percentile(c, F.lit(0.5)).over(near))
        score = F.abs(F.try_divide(F.col("_r"), F.stddev_pop("_r").over(whole)))
        lut = lut.withColumn(c, F.when(score < z, F.col(c))).drop("_r")
    return lut


def buffered(flags: DataFrame, buffer: int, keys: tuple[str, ...] = ("exp_gain",)) -> DataFrame:
    """``bad`` also within ``buffer`` bands of a bad band."""
    w = Window.partitionBy(*keys).orderBy("band").rowsBetween(-buffer, buffer)
    return flags.withColumn("bad", F.max("bad").over(w))


def bad_bands(validity: DataFrame, exp_gain: str, buffer: int = 0) -> DataFrame:
    """(exp_gain, band, bad) of one setting of a validity table (band, a 0/1 column for each setting)."""
    rows = validity.select(F.lit(exp_gain).alias("exp_gain"), "band", (~F.col(exp_gain).cast("boolean")).alias("bad"))
    return buffered(rows, buffer)


def calibrate(cube: DataFrame, lut: DataFrame, convert_offset: bool = False, rows: int = K.BANDS * K.SAMPLES * 4) -> DataFrame:
    """Counts to radiance by band and sample; cells without an entry fall out, as labels that do not align do.

    ``lut`` has at most a detector's cells for each of four settings; within that bound it is broadcast.
    """
    keys = [k for k in ("exp_gain", "band", "x") if k in lut.columns and k in cube.columns]
    table = F.broadcast(lut) if lut.limit(rows + 1).count() <= rows else lut
    joined = cube.join(table.select(*keys, "gain", "offset"), keys)
    return joined.withColumn("value", R.radiance(F.col("value"), F.col("gain"), F.col("offset"), convert_offset)).drop("gain", "offset")


def band_array(rows: DataFrame, value: str, bands: int, kind: str = "double") -> Column:
    """A band table as one array literal, NULL for absent bands; at most ``bands`` rows come to the driver."""
    held = {r[0]: r[1] for r in rows.where(F.col("band").between(1, bands)).select("band", F.col(value).cast(kind)).limit(bands).collect()}
    return F.array(*(F.lit(held.get(b)).cast(kind) for b in range(1, bands + 1)))


def stripes(cube: DataFrame, sigma: float = 1.0) -> DataFrame:
    """(product_id, band, x, n_off, is_stripe): samples that stand strictly above or strictly below both neighbours in
    more lines than ``sigma`` standard deviations of noise would explain.

    Neighbours of an edge repeat the edge, so edges are never stripes. The window needs a line of a band together; counts are
    partial sums.
    """
    w = Window.partitionBy("product_id", "band", "y").orderBy("x")
    v = F.col("value")
    left, right = F.coalesce(F.lag("value").over(w), v), F.coalesce(F.lead("value").over(w), v)
    off = ((v < left) & (v < right)) | ((v > left) & (v > right))
    seen = cube.withColumn("_off", F.coalesce(off, F.lit(False)))
    counts = seen.groupBy("product_id", "band", "x").agg(F.count_if("_off").alias("n_off"), F.count("*").alias("lines"))
    return counts.select("product_id", "band", "x", "n_off", (F.col("n_off") > F.lit(R.stripe_fraction(sigma)) * F.col("lines")).alias("is_stripe"))
