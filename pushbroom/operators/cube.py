"""The two forms of an image cube and operators that keep its shape.

Long: (product_id, band, y, x, value), a row a value. Spectral: (product_id, y, x, spectrum), a row a pixel. Operators along
bands work on the spectral form without a shuffle; those over lines and samples on the long one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import radiometry as R

Range = tuple[float | None, float | None]
PIXEL = ("product_id", "y", "x")


def to_long(pixels: DataFrame, spectrum: str = "spectrum") -> DataFrame:
    """One row a band; a NULL value keeps its row."""
    rest = [c for c in pixels.columns if c != spectrum]
    return pixels.select(*rest, F.posexplode(spectrum).alias("_p", "value")).select(*rest, (F.col("_p") + 1).alias("band"), "value")


def to_spectral(cube: DataFrame, bands: int, keys: Sequence[str] = PIXEL) -> DataFrame:
    """One row a pixel: values of bands 1..``bands``, NULL where a band has no row."""
    held = F.map_from_entries(F.collect_list(F.struct("band", "value")))
    got = cube.groupBy(*keys).agg(held.alias("_m"))
    return got.select(*keys, F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda b: F.col("_m")[b]).alias("spectrum"))


def within(c: Column, bounds: Range, pad: float = 0.0) -> Column:
    low, high = bounds
    out = F.lit(True)
    if low is not None:
        out = out & (c >= F.lit(low - pad))
    if high is not None:
        out = out & (c <= F.lit(high + pad))
    return out


def crop(rows: DataFrame, x: Range = (None, None), y: Range = (None, None), bands: Range = (None, None), pad: float = 0.0) -> DataFrame:
    """Rows whose labels lie within inclusive bounds (None is open); plain comparisons, so they reach the scan."""
    keep = within(F.col("x"), x, pad) & within(F.col("y"), y, pad)
    return rows.where(keep & within(F.col("band"), bands) if "band" in rows.columns else keep)


def lines(rows: DataFrame, start: int, stop: int, ordinal: str = "line") -> DataFrame:
    """Lines by position, the last excluded."""
    return rows.where((F.col(ordinal) >= start) & (F.col(ordinal) < stop))


def flip_lines(rows: DataFrame, descending: Column, key: str = "product_id") -> DataFrame:
    """y of products from a descending orbit counted the other way, as their least y less each y."""
    least = F.min("y").over(Window.partitionBy(key))
    return rows.withColumn("y", F.when(descending, R.flip_down(F.col("y"), least)).otherwise(F.col("y")))


def preview(cube: DataFrame, band: int, most: int = 2000, stride_to: int = 1000) -> DataFrame:
    """One band, thinned to every k-th line where a product has over ``most`` lines, k being lines // ``stride_to``.

    Lines are numbered among a product's distinct lines, which are few, and joined back.
    """
    one = cube.where(F.col("band") == band)
    w = Window.partitionBy("product_id")
    ys = one.select("product_id", "y").distinct()
    ys = ys.withColumns({"n": F.count("*").over(w), "i": F.row_number().over(w.orderBy("y")) - 1})
    k = F.when(F.col("n") > most, F.floor(F.col("n") / stride_to)).otherwise(F.lit(1))
    return one.join(ys.where(F.col("i") % k == 0).select("product_id", "y"), ["product_id", "y"], "left_semi")


def median_spectrum(cube: DataFrame) -> DataFrame:
    return cube.groupBy("band").agg(F.median("value").alias("median_value"))


def chunk_lines(bands: int, samples: int, size: float = 200e6) -> int:
    """Lines of a cube of 4-byte values in a chunk of ``size`` bytes."""
    return int(size / (bands * samples * 4))
