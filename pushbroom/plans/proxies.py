"""Stand-ins for a product's tables, made from the driver's tables.

Each embedding is the spectrum of a pixel; 25 pixels make a line, 64 bands a spectrum.
"""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cube as C
from ..sources import files, qub

BANDS, SAMPLES = 64, 25
#: Bands that stand for those of the surface temperature.
THERMAL = (41, 60)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, y, x, spectrum) of raw values."""
    e = table(spark, sf_dir, "embeddings")
    x, y = F.col("vec_id") % SAMPLES + 0.5, F.floor(F.col("vec_id") / SAMPLES) + 0.5
    return e.select(F.lit("p").alias("product_id"), y.cast("double").alias("y"), x.cast("double").alias("x"), F.col("embedding").cast("array<double>").alias("spectrum"))


def lit_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with positive, radiance-like values."""
    return pixels(spark, sf_dir).withColumn("spectrum", F.transform("spectrum", lambda v: (F.abs(v) + 0.01) * 10.0))


def holed_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with small values missing, and two long holes."""
    hole = lambda v, i: F.when((F.abs(v) >= 0.05) & ~(i + 1).between(20, 29) & ~(i + 1).between(40, 50), v)
    return pixels(spark, sf_dir).withColumn("spectrum", F.transform("spectrum", hole))


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.to_long(pixels(spark, sf_dir))


def lut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(exp_gain, band, x, gain, offset): a row for each part, as many bands as parts reach; a cube takes those it has."""
    p = table(spark, sf_dir, "part")
    band = (F.floor(F.col("p_partkey") / SAMPLES) + 1).cast("int")
    return p.select(F.lit("e1g2").alias("exp_gain"), band.alias("band"), (F.col("p_partkey") % SAMPLES + 0.5).cast("double").alias("x"), (F.col("p_retailprice") / 1e5).alias("gain"), (F.col("p_size") / 100.0).alias("offset"))


def luts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(exp_gain, band, x, gain, offset): a row for each part; those that fill the cells of a cube's bands and samples make a table, numbered by exp_gain."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    band = (F.floor(k / SAMPLES) % BANDS + 1).cast("int")
    return p.select(F.floor(k / (BANDS * SAMPLES)).cast("long").alias("exp_gain"), band.alias("band"), (k % SAMPLES + 0.5).cast("double").alias("x"), (F.col("p_retailprice") / 1e5).alias("gain"), (F.col("p_size") / 100.0).alias("offset"))


def wavelengths() -> Column:
    """Metres by band."""
    return F.array(*(F.lit((4000.0 + 13.0 * b) * 1e-9) for b in range(1, BANDS + 1)))


def irradiance() -> list[float]:
    return [100.0 + 3.0 * b for b in range(1, BANDS + 1)]


def flux() -> Column:
    from math import pi

    return F.array(*(F.lit(v * 10.0 / (pi * 1.0 * 1.0)) for v in irradiance()))


def flux_rounded() -> Column:
    return F.array(*(F.lit(round(v * 10.0 / 3.14, 4)) for v in irradiance()))


def saturation() -> Column:
    return F.array(*(F.lit(0.3 + 0.001 * b) for b in range(1, BANDS + 1)))


def polish_coefficients() -> Column:
    """Bands 8 to 63 have one."""
    return F.array(*(F.lit(1.0 + 0.001 * b if 8 <= b <= 63 else None).cast("double") for b in range(1, BANDS + 1)))


def bad_flags() -> Column:
    """Every ninth band is bad."""
    return F.array(*(F.lit(b % 9 == 0) for b in range(1, BANDS + 1)))


def knots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sun-parameter series of all events."""
    return table(spark, sf_dir, "events").select((F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("timestamp"), (F.col("value") % 60.0).alias("sun_elev"), (F.col("value") % 360.0).alias("sun_az"))


def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, y, line, t): a line each of the cube, a minute apart from half an hour before the series starts."""
    e = table(spark, sf_dir, "events")
    start = e.agg((F.min(F.unix_micros(F.col("ts").cast("timestamp"))) / 1e6 - 1800.0).alias("t0"))
    n = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / SAMPLES).alias("line")).distinct()
    return n.crossJoin(F.broadcast(start)).select(F.lit("p").alias("product_id"), (F.col("line") + 0.5).cast("double").alias("y"), "line", (F.col("t0") + 60.0 * F.col("line")).alias("t"))


def dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, y, x, z): band 12, a hundredfold."""
    return pixels(spark, sf_dir).select("product_id", "y", "x", (F.get("spectrum", F.lit(11)) * 100.0).alias("z"))


def regrid_targets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """x a sample apart and y a line and a half apart, from a quarter and a half beyond the grid's least, over its whole extent."""
    e = dem(spark, sf_dir).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    at = lambda c, off, step: e.select(F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col(f"{c}1") - F.col(f"{c}0") - off) / step)))).alias("i"), f"{c}0").select((F.col(f"{c}0") + off + F.col("i") * step).alias(c))
    return at("x", 0.25, 1.0), at("y", 0.5, 1.5)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, y, inc, iaz, lat) by formula."""
    y = table(spark, sf_dir, "embeddings").select((F.floor(F.col("vec_id") / SAMPLES) + 0.5).cast("double").alias("y")).distinct()
    return y.select(F.lit("p").alias("product_id"), "y", (20.0 + F.col("y") / 2.0 % 60.0).alias("inc"), (F.col("y") * 3.0 % 360.0).alias("iaz"), (-30.0 + F.col("y") / 10.0).alias("lat"))


def geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Pixel, Scan, Longitude, Latitude): a sparse grid, a point a supplier."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select((k % 6 * 50.0).alias("Pixel"), (F.floor(k / 6) * 50.0).alias("Scan"), (150.0 + k % 6 * 8.0 + F.floor(k / 6) * 0.5).alias("Longitude"), (-20.0 + F.floor(k / 6) * 0.9 + k % 6 * 0.1).alias("Latitude"))


def scratch(spark: SparkSession, name: str) -> str:
    """A path for a file that a query writes to read it again: below ``spark.checkpoint.dir``, which executors share, or a local folder on one machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(root or tempfile.gettempdir()).rstrip('/')}/queries-{uuid.uuid4().hex}/{name}"


def text_file(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """The path of a written file of ``lines`` (n, value) in the order of n."""
    path = scratch(spark, name)
    lines.repartition(1).sortWithinPartitions("n").select("value").write.text(path)
    return path


def cube_file(spark: SparkSession, sf_dir: str) -> str:
    """The path of a band-sequential file of the pixels; those that fill up the last line are missing values."""
    p = pixels(spark, sf_dir)
    grid = p.select("product_id", "y").distinct().crossJoin(spark.range(SAMPLES).select((F.col("id") + 0.5).alias("x")))  # 25 samples
    whole = grid.join(p, ["product_id", "y", "x"], "left").withColumn("spectrum", F.coalesce("spectrum", F.array_repeat(F.lit(None).cast("double"), BANDS)))
    path = files.local(scratch(spark, "cube.img"))
    if path is None:
        raise ValueError("a cube file is written by the driver, to a mounted folder")
    Path(path).parent.mkdir(parents=True)
    qub.write_envi(C.to_long(whole), path)
    return path


def part_lines(spark: SparkSession, sf_dir: str, *fields: Column, sep: str = ",") -> DataFrame:
    """(n, value): a line a part, of its fields."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("n"), F.concat_ws(sep, *(f.cast("string") for f in fields)).alias("value"))


def headed(spark: SparkSession, lines: DataFrame, *headers: str) -> DataFrame:
    """``lines`` (n, value) below header lines."""
    return lines.unionByName(spark.createDataFrame([(k - len(headers), h) for k, h in enumerate(headers)], "n long, value string"))
