"""Readers of the ancillary files: sun parameters, geometry grids, look-up tables, labels, control points, catalogues."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import names as N
from ..functions import radiometry as R
from .files import local


def read_spm(spark: SparkSession, path: str) -> DataFrame:
    """Sun parameters: the 19 fields, with datetime and timestamp (seconds)."""
    return parse_spm(spark.read.text(path))


def parse_spm(lines: DataFrame) -> DataFrame:
    """``lines`` (value) of white-space separated fields; the third fuses a block length with the four digits of a year."""
    ints = set(K.SPM_FIELDS[3:9]) | {"row"}
    tok = F.split(F.trim("value"), r"\s+")
    cols = []
    for n, name in enumerate(K.SPM_FIELDS):
        c = F.get(tok, n)
        cols.append((F.substring(c, 4, 4) if name == "year" else c.cast("int") if name in ints else c if name == "type" else c.cast("double")).alias(name))
    out = lines.where(F.trim("value") != "").select(*cols)
    at = F.make_timestamp(F.col("year").cast("int"), "month", "day", "hour", "minute", F.col("second") + F.col("millisecond") / 1000)
    return out.withColumn("datetime", at).withColumn("timestamp", F.unix_micros("datetime") / 1e6)


def read_geometry(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, header=True)
    return raw.select(*(F.col(c).cast("double").alias(c) for c in ("Pixel", "Scan", "Longitude", "Latitude")))


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """(n, value) of one small file's lines by their place in it: the whole file is a row, so its order is sure."""
    text = spark.read.text(path, wholetext=True)
    lines = F.filter(F.split("value", r"\r?\n"), lambda v: F.trim(v) != "")
    return text.select(F.posexplode(lines).alias("n", "value"))


def read_gain_offset(spark: SparkSession, path: str, exp_gain: str | None = None, samples: int = K.SAMPLES) -> DataFrame:
    """(exp_gain, band, x, gain, offset): lines run through the samples of band 1, then of band 2, and so on."""
    tok = F.split("value", ",")
    key = F.lit(exp_gain) if exp_gain else F.lit(setting_of(path))
    return _numbered(spark, path).select(key.alias("exp_gain"), (F.floor(F.col("n") / samples) + 1).cast("int").alias("band"), (F.col("n") % samples + 0.5).alias("x"), F.get(tok, 0).cast("double").alias("gain"), F.get(tok, 1).cast("double").alias("offset"))


def read_saturation(spark: SparkSession, path: str, field: str = "dynamic_range", sentinels: bool = True) -> DataFrame:
    """(exp_gain, band, saturation): band by place, as first fields disagree on where they start.

    ``field`` is ``dynamic_range`` (the third, which the calibration reads) or ``radiance`` (the second); ``sentinels`` keeps -9999 and 16384.
    """
    tok = F.split("value", ",")
    v = F.get(tok, 2 if field == "dynamic_range" else 1).cast("double")
    v = v if sentinels else F.when(~v.isin(-9999.0, 16384.0), v)
    return _numbered(spark, path).select(F.lit(setting_of(path)).alias("exp_gain"), (F.col("n") + 1).alias("band"), (v * K.RADIANCE_SCALE).alias("saturation"))


def read_solar_flux(spark: SparkSession, path: str, distance: float = 1.0) -> DataFrame:
    """(band, wl, irradiance, flux, flux_rounded): wavelengths at three digits."""
    tok = F.split("value", "\t")
    rows = _numbered(spark, path).select((F.col("n") + 1).alias("band"), F.round(F.get(tok, 0).cast("double"), 3).alias("wl"), F.get(tok, 1).cast("double").alias("irradiance"))
    return rows.withColumns({"flux": R.solar_flux(F.col("irradiance"), distance), "flux_rounded": R.solar_flux_rounded(F.col("irradiance"))})


def read_validity(spark: SparkSession, path: str) -> DataFrame:
    """(band, a 0/1 column for each setting)."""
    raw = spark.read.csv(path, header=True)
    return raw.select(*(F.col(c).cast("int").alias(c) for c in raw.columns))


def read_polish(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True).select(F.col("band").cast("int").alias("band"), F.col("polish").cast("double").alias("polish"))


def setting_of(path: str) -> str | None:
    """The exposure and gain key in a calibration file's name."""
    return next((t for t in Path(path).name.split("_") if len(t) == 4 and t[0] == "e" and t[2] == "g"), None)


def lut_path(calib_dir: str, exp_gain: str, kind: str = "lut_coeff") -> str:
    """Path of a setting's table; FileNotFoundError without one."""
    found = sorted(Path(calib_dir).glob(f"*_{exp_gain}_{kind}.csv"))
    if not found:
        raise FileNotFoundError(f"no {kind} table for {exp_gain} in {calib_dir}")
    return str(found[0])


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(path, xml): a label a row."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("xml"))


def metaget(labels: DataFrame, key: str, xml: str = "xml") -> DataFrame:
    """Adds ``value``: the first element of that name."""
    return labels.withColumn("value", N.xml_text(F.col(xml), key))


def products(labels: DataFrame) -> DataFrame:
    """Typed metadata of labels (path, xml)."""
    x = F.col("xml")
    text = lambda k: N.xml_text(x, k)
    axes = N.xml_numbers(x, "elements", "int")
    return labels.select(
        N.basename(F.col("path")).alias("product_id"), text("projection").alias("projection"), text("area").alias("area"), F.lower(text("orbit_limb_direction")).alias("orbit_direction"),
        F.to_timestamp(text("start_date_time")).alias("start_time"), F.to_timestamp(text("stop_date_time")).alias("stop_time"), text("exposure").alias("exposure"), text("gain").alias("gain"),
        N.exposure_gain(text("exposure"), text("gain")).alias("exp_gain"), text("line_exposure_duration").cast("double").alias("line_exposure_duration"), text("md5_checksum").alias("md5_checksum"),
        F.get(axes, 0).alias("bands"), F.get(axes, 1).alias("lines"), F.get(axes, 2).alias("samples"), N.xml_numbers(x, "center_wavelength").alias("wl"),
        N.projection_wkt(N.projection_key(text("projection"), text("area"))).alias("wkt"), N.solar_distance(F.col("path")).alias("solar_distance"),
    )


def read_control_points(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """(row, col, x, y) points and the CRS text of a points file: a CRS line, a header, then sourceX, sourceY, mapX, mapY."""
    lines = _numbered(spark, path)
    crs = lines.where("n = 0").select(N.crs_text(F.col("value"))).first()[0]
    header = [h.strip() for h in lines.where("n = 1").first()["value"].split(",")]
    tok = F.split("value", ",")
    at = lambda c: F.trim(F.get(tok, header.index(c))).cast("double")
    rows = lines.where("n > 1").select(at("sourceY").alias("row"), at("sourceX").alias("col"), at("mapX").alias("x"), at("mapY").alias("y"))
    return rows, crs


def write_control_points(points: DataFrame, path: str, crs: str) -> None:
    """``points`` (row, col, x, y), at most some thousands, as a points file at a local path that ``read_control_points`` reads."""
    rows = points.select("x", "y", "col", "row").orderBy("row", "col").collect()
    text = [f"#CRS: {crs}", "mapX,mapY,sourceX,sourceY,enable", *(",".join(repr(float(v)) for v in r) + ",1" for r in rows)]
    Path(local(path) or path).write_text("\n".join(text) + "\n")


def catalogue(paths: DataFrame, level: int = 1, exts: tuple[str, ...] = tuple(K.ARCHIVE_FOLDERS), basenames: list[str] | None = None) -> DataFrame:
    """(ext, basename, path) of archive files among ``paths`` (path): files whose folder and suffix are those of a kind at a product level.

    The basename is the fourth token of the stem. Other kinds and basenames fall out; of two files of a kind and basename the greater path stays.
    """
    found = None
    for ext in exts:
        if ext not in K.ARCHIVE_FOLDERS:
            raise ValueError(f"unknown file kind: {ext}")
        sub = K.ARCHIVE_FOLDERS[ext]
        where = f"{sub}/{'calibrated' if sub == 'geometry' else K.LEVEL_NAMES[level]}"
        some = paths.where(F.col("path").rlike(rf"(^|/){where}/([^?#]*/)?[^/]*\.{ext.split('-')[0]}$")).withColumn("ext", F.lit(ext))
        found = some if found is None else found.unionByName(some)
    out = found.select("ext", N.stem_token(F.col("path")).alias("basename"), "path").where("basename IS NOT NULL")
    if basenames is not None:
        out = out.where(F.col("basename").isin(basenames))
    return out.groupBy("ext", "basename").agg(F.max("path").alias("path"))


def catalogue_maps(files: DataFrame) -> DataFrame:
    """(ext, files map<basename, path>)."""
    return files.groupBy("ext").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("basename", "path")))).alias("files"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of every file below ``folder``; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
