"""From files to files: a calibrated image, its sun parameters and its geometry grid to I/F reflectance on disk.

The steps are those of ``calibration``; this module finds what they need in the files beside the image. Pixels stay in the order of
the file's lines throughout; only destriping, which works by band, and an elevation grid deal them anew.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import radiometry as R
from ..operators import cube as C
from ..operators import detector, fourier, geometry, sun, terrain
from ..operators import spectra as S
from ..sources import files, integrity, qub, tables
from . import calibration

Extent = tuple[float | None, float | None, float | None, float | None]
NONE: Extent = (None, None, None, None)
#: The body's longitudes and latitudes.
MAP_CRS = "IAU:30100"


def metadata(spark: SparkSession, image: str) -> dict:
    """The label beside an image, typed."""
    return tables.products(tables.read_labels(spark, files.with_suffix(image, ".xml"))).first().asDict()


def read_pixels(spark: SparkSession, path: str, chunk: int | None = None, x: C.Range = (None, None), y: C.Range = (None, None)) -> DataFrame:
    """(product_id, y, x, spectrum) within inclusive labels of a band-sequential file with a header, or of a long cube in Parquet; other rasters are a ValueError."""
    kind = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    if kind in ("qub", "img"):
        return qub.read_qub(spark, path, chunk, "spectral", x, y)
    if kind in ("tif", "tiff"):
        raise ValueError(f"cannot read {kind} files: {path}; give a band-sequential file with a header, or Parquet")
    cube = spark.read.parquet(path)
    return C.to_spectral(C.crop(cube, x, y), cube.agg(F.max("band")).first()[0])


def read_dem(spark: SparkSession, path: str) -> DataFrame:
    """(y, x, z): an elevation grid from a one-band file with a header, a Parquet table, or a CSV file with those columns."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind in ("qub", "img"):
        return qub.read_qub(spark, path, bands=(1, 1)).select("y", "x", F.col("value").alias("z"))
    if kind in ("tif", "tiff"):
        raise ValueError(f"cannot read {kind} files: {path}")
    raw = spark.read.csv(path, header=True) if kind == "csv" else spark.read.parquet(path)
    return raw.select(*(F.col(c).cast("double").alias(c) for c in ("y", "x", "z")))


def _line_count(pixel_extent: Extent, lines: int) -> tuple[int, int]:
    """The first line within inclusive label bounds, from 0, and how many there are."""
    low, high = pixel_extent[2:]
    first = max(0, math.ceil((0.5 if low is None else low) - 0.5))
    last = min(lines - 1, math.floor((lines - 0.5 if high is None else high) - 0.5))
    return first, max(0, last - first + 1)


def preprocess(spark: SparkSession, image: str, spm: str, geometry_grid: str = "", radiance: str = "", extent: Extent = NONE, yrange: tuple[int | None, int | None] = (None, None), chunk: int | None = None) -> tuple[DataFrame, dict]:
    """Pixels (product_id, y, x, spectrum, inc, iaz and, with a geometry grid, lon and lat) of an image in W/m2/sr/um, and its label.

    ``extent`` bounds longitudes and latitudes where there is a geometry grid, else samples and lines. ``yrange`` are the image's own lines that those read are
    (their count must agree); without it lines are known by their place. ``radiance`` is read instead of the image, as it is, when it was cropped before. Lines of a descending orbit are
    counted the other way, as their least label less each, and their azimuths turned.
    """
    label = metadata(spark, image)
    points = None
    if geometry_grid:
        points = geometry.in_box(tables.read_geometry(spark, geometry_grid), extent)
        extent = tuple(geometry.pixel_extent(points).first())
        if extent[0] is None:
            raise ValueError("no geometry points within extent")
    if radiance:
        pixels = read_pixels(spark, radiance, chunk)
        low, high, count = pixels.agg(F.min("y"), F.max("y"), F.countDistinct("y")).first()
        first = math.floor(low) if low is not None else 0
    else:
        pixels = read_pixels(spark, image, chunk, extent[:2], extent[2:])
        first, count = _line_count(extent, label["lines"])
    start, stop = first if yrange[0] is None else yrange[0], first + count if yrange[1] is None else yrange[1]
    if stop - start != count:
        raise ValueError(f"yrange has {stop - start} lines, the image {count}")
    pixels = pixels.withColumns({"spectrum": S.scale(F.col("spectrum")), "_line": F.floor(F.col("y")) - first + start})
    if points is not None:
        pixels = geometry.spline_at(_centres(points), pixels.withColumn("_scan", F.col("_line").cast("double")), ("x", "_scan"), ("lon", "lat")).drop("_scan")
    descending = label["orbit_direction"] == "descending"
    clock = sun.line_times(spark, label["start_time"].timestamp(), label["line_exposure_duration"], label["lines"])
    lit = sun.illumination(clock, tables.read_spm(spark, spm), descending).select(F.col("line").alias("_line"), "inc", "iaz")
    pixels = pixels.join(sun.small(lit), "_line").drop("_line")
    if descending:
        pixels = pixels.withColumn("y", R.flip_down(F.col("y"), F.lit(first + 0.5)))
    return pixels, label


def _centres(points: DataFrame) -> DataFrame:
    return points.select(F.col("Pixel").alias("u"), F.col("Scan").alias("v"), F.col("Longitude").alias("a"), F.col("Latitude").alias("b"))


def bad_flags(spark: SparkSession, validity: str, exp_gain: str, bands: int, buffer: int = 0) -> Column:
    """The flags of a setting as an array, from a validity file."""
    return detector.band_array(detector.bad_bands(tables.read_validity(spark, validity), exp_gain, buffer), "bad", bands, "boolean")


def destriped(pixels: DataFrame, bands: int, **thresholds: float) -> DataFrame:
    """Pixels with each band's image filtered; other columns of a pixel stay."""
    key = ["product_id", "y", "x"]
    out = C.to_spectral(fourier.destripe(C.to_long(pixels.select(*key, "spectrum")).select("product_id", "band", "y", "x", "value"), **thresholds), bands)
    rest = pixels.drop("spectrum")
    return rest.join(out, key) if len(rest.columns) > len(key) else out


def slope_cosines(pixels: DataFrame, dem: DataFrame) -> DataFrame:
    """Adds cos_inc to ``pixels`` (y, x, inc, iaz, lat): the sun's angle to the slopes of ``dem`` (y, x, z), read off at the pixels."""
    axis = lambda c: pixels.select(c).distinct()
    at = terrain.regrid(dem, axis("x"), axis("y")).withColumn("_p", F.lit(0))
    slopes = terrain.gradient(at, keys=("_p",)).select("y", "x", "dz_dx", "dz_dy")
    c = R.local_cosine(F.col("dz_dx"), F.col("dz_dy"), F.col("inc"), F.col("iaz"), F.col("lat"))
    return pixels.join(slopes, ["y", "x"], "left").withColumn("cos_inc", c).drop("dz_dx", "dz_dy")


def reflectance(
    spark: SparkSession, image: str, spm: str, flux: str, geometry_grid: str = "", out: str = "", radiance: str = "", checksums: bool = False, dem: str | DataFrame | None = None, extent: Extent = NONE,
    yrange: tuple[int | None, int | None] = (None, None), smoothing: str = "none", window: int = 1, polish: str = "", validity: str = "", buffer: int = 0, bad: list[bool] | None = None, thermal: str = "verma",
    max_refl: float = math.inf, destripe: bool = False, chunk: int | None = None, thermal_bands: tuple[int, int] = K.THERMAL_BANDS, signal_band: int = 10, **thresholds: float,
) -> DataFrame:
    """Pixels (product_id, y, x, spectrum, and what ``preprocess`` adds) of I/F reflectance; written to ``out`` if that is given.

    ``flux``, ``polish`` and ``validity`` are files of the instrument; without the last two nothing is polished or flagged (``bad`` flags bands itself). ``checksums`` holds image, sun
    parameters and geometry against their labels first. ``dem`` is a path or a table (y, x, z), in the labels of the pixels, and needs a geometry grid for latitudes. Thresholds go to the destriper.
    """
    if checksums:
        for path in filter(None, (image, spm, geometry_grid)):
            integrity.label(path)
    if dem is not None and not geometry_grid:
        raise ValueError("an elevation grid needs a geometry grid, for latitudes")
    pixels, label = preprocess(spark, image, spm, geometry_grid, radiance, extent, yrange, chunk)
    bands = label["bands"]
    flags = F.array(*map(F.lit, bad)) if bad is not None else bad_flags(spark, validity, label["exp_gain"], bands, buffer) if validity else None
    if destripe:
        masked = pixels if flags is None else pixels.withColumn("spectrum", S.mask_flagged(F.col("spectrum"), flags))
        pixels = destriped(masked, bands, **thresholds)
    sun_flux = tables.read_solar_flux(spark, flux, label["solar_distance"])
    wl, f = detector.band_array(sun_flux.withColumn("wl", F.col("wl") * 1e-9), "wl", bands), detector.band_array(sun_flux, "flux", bands)
    coefficients = detector.band_array(tables.read_polish(spark, polish), "polish", bands) if polish else None
    cos = None
    if dem is not None:
        pixels, cos = slope_cosines(pixels, read_dem(spark, dem) if isinstance(dem, str) else dem), F.col("cos_inc")
    got = calibration.full_reflectance(pixels, wl, f, flags, cos, thermal, signal_band, 0.5, max_refl, coefficients, smoothing, window, thermal_bands)
    if out:
        qub.write_output(C.to_long(got.select("product_id", "y", "x", "spectrum")), out, label["wl"])
    return got


def with_control_points(spark: SparkSession, image: str, geometry_grid: str, out: str = "", extent: Extent = NONE, corners_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """The pixels of an image within half a pixel of the geometry points inside ``extent`` (longitudes, latitudes), and those points (row, col, x, y).

    With ``out`` the cube is written there, and the points beside it, in ``out`` with the suffix ``.points``, with their coordinate system.
    """
    points = geometry.in_box(tables.read_geometry(spark, geometry_grid), extent)
    e = tuple(geometry.pixel_extent(points).first())
    if e[0] is None:
        raise ValueError("no geometry points within extent")
    pixels = read_pixels(spark, image, None, (e[0] - 0.5, e[1] + 0.5), (e[2] - 0.5, e[3] + 0.5))
    controls = geometry.control_points(points, corners_only)
    if out:
        qub.write_output(C.to_long(pixels), out)
        tables.write_control_points(controls, files.with_suffix(out.rstrip("/"), ".points"), MAP_CRS)
    return pixels, controls


def warped(spark: SparkSession, image: str, points: str, out: str = "", shape: tuple[int, int] | None = None, method: str = "bilinear") -> DataFrame:
    """(product_id, x, y, spectrum) of an image on a regular map grid, led there by the control points of a points file; ``shape`` is samples and lines, by default the image's own."""
    pixels = read_pixels(spark, image)
    controls, _ = tables.read_control_points(spark, points)
    n_x, n_y = shape or tuple(pixels.agg(F.countDistinct("x"), F.countDistinct("y")).first())
    name = pixels.select("product_id").first()[0]
    got = geometry.warp(pixels, controls, n_x, n_y, method).select(F.lit(name).alias("product_id"), "x", "y", "spectrum")
    if out:
        qub.write_output(C.to_long(got), out)
    return got


def gridded(spark: SparkSession, image: str, geometry_grid: str, out: str = "", extent: Extent = NONE, shape: tuple[int, int] | None = None, method: str = "bilinear") -> DataFrame:
    """(product_id, lon, lat, spectrum) of the part of an image inside ``extent`` (longitudes, latitudes), on a regular grid of both; ``shape`` is columns and rows, by default the part's own."""
    points = geometry.in_box(tables.read_geometry(spark, geometry_grid), extent)
    e = tuple(geometry.pixel_extent(points).first())
    if e[0] is None:
        raise ValueError("no geometry points within extent")
    pixels = read_pixels(spark, image, None, (e[0] - 0.5, e[1] + 0.5), (e[2] - 0.5, e[3] + 0.5))
    n_x, n_y = shape or tuple(pixels.agg(F.countDistinct("x"), F.countDistinct("y")).first())
    name = pixels.select("product_id").first()[0]
    got = geometry.warp(pixels, geometry.control_points(points), n_x, n_y, method)
    if out:
        qub.write_output(C.to_long(got.select(F.lit(name).alias("product_id"), "y", "x", "spectrum")), out)
    return got.select(F.lit(name).alias("product_id"), F.col("x").alias("lon"), F.col("y").alias("lat"), "spectrum")
