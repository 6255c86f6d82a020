"""Calibration chains on pixels (product_id, y, x, spectrum): counts to radiance to I/F reflectance.

Every step is a column expression on the spectrum but for the look-up of gains by sample and of the sun by
line, both joins with small tables. The chains never shuffle pixels.
"""

from __future__ import annotations

import math
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import radiometry as R
from ..operators import spectra as S
from ..operators.sun import small


def gain_arrays(lut: DataFrame, bands: int) -> DataFrame:
    """(exp_gain, x, gains, offsets): the table of a sample as arrays by band, NULL where a band has no entry."""
    m = lut.groupBy("exp_gain", "x").agg(F.map_from_entries(F.collect_list(F.struct("band", F.struct("gain", "offset")))).alias("m"))
    arr = lambda c: F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda b: F.col("m")[b][c])
    return m.select("exp_gain", "x", arr("gain").alias("gains"), arr("offset").alias("offsets"))


def to_radiance(pixels: DataFrame, lut: DataFrame, saturation: Column | None, bands: int = K.BANDS, max_gap: int | None = 11, interpolated: bool = True, masked: tuple[int, ...] = K.ORDER_SORTING + K.NO_SIGNAL, convert_offset: bool = False) -> DataFrame:
    """Counts to radiance: gain and offset, joint and empty bands, saturation, and holes along bands.

    ``pixels`` may have exp_gain; samples without gains fall out. ``saturation`` is an array by band.
    """
    table = gain_arrays(lut, bands)
    keys = ["exp_gain", "x"] if "exp_gain" in pixels.columns else ["x"]
    p = pixels.join(small(table if len(keys) == 2 else table.drop("exp_gain")), keys)
    s = F.transform("spectrum", lambda v, i: R.radiance(v, F.get("gains", i), F.get("offsets", i), convert_offset))
    s = S.mask_bands(s, masked)
    if saturation is not None:
        s = S.mask_saturated(s, saturation)
    p = p.withColumn("spectrum", s).drop("gains", "offsets")
    return p.withColumn("spectrum", S.interpolate(F.col("spectrum"), max_gap)) if interpolated else p


def with_lines(pixels: DataFrame, lines: DataFrame) -> DataFrame:
    """Adds what ``lines`` (product_id, y, ...) knows of each line; lines without an entry stay, with NULLs."""
    return pixels.join(small(lines), ["product_id", "y"], "left")


def to_reflectance(pixels: DataFrame, wl: Column, flux: Column, thermal: str = "", cos_inc: Column | None = None, thermal_bands: tuple[int, int] = K.THERMAL_BANDS) -> DataFrame:
    """Radiance to I/F, with cosines from column ``inc`` or given; ``thermal`` is "" or "verma". ``wl`` is in metres."""
    if thermal not in ("", "verma"):
        raise ValueError(f"unknown thermal correction: {thermal!r}")
    c = R.cos_incidence(F.col("inc")) if cos_inc is None else cos_inc
    heat = S.thermal_radiance(F.col("spectrum"), wl, thermal_bands) if thermal else None
    return pixels.withColumn("spectrum", S.reflect(F.col("spectrum"), heat, c, flux))


def _covers(spark: SparkSession, bad: Column, bands: tuple[int, int]) -> bool:
    """Whether flags that do not depend on a row are true in all of ``bands``."""
    n = bands[1] - bands[0] + 1
    part = F.filter(F.slice(bad, bands[0], n), lambda b: F.coalesce(b, F.lit(False)))
    try:
        return spark.range(1).select(F.size(part) == n).first()[0]
    except AnalysisException:  # flags by row: their pixels tell
        return False


def full_reflectance(pixels: DataFrame, wl: Column, flux: Column, bad: Column | None = None, cos_inc: Column | None = None, thermal: str = "verma", signal_band: int = 10, least_signal: float = 0.5, max_refl: float = math.inf, polish: Column | None = None, smoothing: str = "none", width: int = 1, thermal_bands: tuple[int, int] = K.THERMAL_BANDS) -> DataFrame:
    """The whole chain from scaled radiance: bad bands, low signal, thermal removal, I/F, range, polish, smoothing.

    Bad bands that cover all thermal bands leave no temperature and so no reflectance at all; then a warning says so.
    """
    if thermal and bad is not None and _covers(pixels.sparkSession, bad, thermal_bands):
        warnings.warn("a setting whose bad bands hold every thermal band gives NULL reflectance; use thermal=''", stacklevel=2)
    s = F.col("spectrum")
    p = pixels.withColumn("spectrum", S.mask_flagged(s, bad)) if bad is not None else pixels
    p = p.withColumn("spectrum", S.mask_low_signal(s, signal_band, least_signal))
    c = R.valid_cosine(R.cos_incidence(F.col("inc")) if cos_inc is None else cos_inc)
    p = to_reflectance(p, wl, flux, thermal, c, thermal_bands)
    if max_refl != math.inf:
        p = p.withColumn("spectrum", S.at_most(s, max_refl))
    if polish is not None:
        p = p.withColumn("spectrum", S.polish(s, polish))
    return p.withColumn("spectrum", S.smooth(s, smoothing, width)) if smoothing.lower() != "none" else p


def verma_reflectance(pixels: DataFrame, wl: Column, flux: Column, coefficients: Column, inc: Column | None = None, smoothing: int = 3, thermal_bands: tuple[int, int] = K.THERMAL_BANDS) -> DataFrame:
    """The other chain: scale, thermal removal, flux, clip at zero, polish of every band that has a coefficient (others NULL), incidence, full-window boxcar."""
    s = F.col("spectrum")
    p = pixels.withColumn("spectrum", S.scale(s))
    p = p.withColumn("spectrum", S.reflect(s, S.thermal_radiance(s, wl, thermal_bands), F.lit(1.0), flux))
    p = p.withColumn("spectrum", F.transform(s, R.clip_at_zero)).withColumn("spectrum", S.polish(s, coefficients, None, "null"))
    if inc is not None:
        p = p.withColumn("spectrum", F.transform(s, lambda v: F.try_divide(v, R.cos_incidence(inc))))
    return p.withColumn("spectrum", S.boxcar(s, smoothing, smoothing)) if smoothing > 0 else p
