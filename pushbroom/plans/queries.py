"""Queries over the driver's tables, by name: an operator each, on the stand-ins of ``proxies``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import names as N
from ..functions import radiometry as R
from ..operators import cube as C
from ..operators import detector, fourier, geometry, sun, terrain
from ..operators import spectra as S
from ..sources import integrity, qub, tables
from . import calibration
from . import proxies as P
from .sql import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _s() -> Column:
    return F.col("spectrum")



def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _rounded(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _values(pixels: DataFrame, name: str = "value") -> DataFrame:
    """(band, y, x, value) of spectra, rounded."""
    return C.to_long(pixels).select("band", "y", "x", _rounded("value").alias(name))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts to radiance to I/F, and its mean by band."""
    rad = P.lit_pixels(spark, sf_dir).withColumn("spectrum", S.mask_bands(_s()))
    refl = calibration.to_reflectance(rad, P.wavelengths(), P.flux(), cos_inc=F.lit(0.5))
    return C.to_long(refl).groupBy("band").agg(_rounded(F.avg("value")).alias("mean_reflectance"), F.count("value").alias("n"))


# the two forms, and subsets


@query
def cube_long(spark, sf_dir):
    return P.cube(spark, sf_dir).select("band", "y", "x", _rounded("value").alias("value"))


@query
def cube_spectral(spark, sf_dir):
    s = C.to_spectral(P.cube(spark, sf_dir).where("value > 0"), P.BANDS)
    n = F.size(F.filter("spectrum", lambda v: v.isNotNull()))
    return s.select("y", "x", F.size("spectrum").cast("long").alias("bands"), n.cast("long").alias("present"), _rounded(F.get("spectrum", F.lit(6))).alias("band_7"))


@query
def crop_xy(spark, sf_dir):
    return C.crop(P.pixels(spark, sf_dir), x=(5, 8), y=(None, 12)).select("y", "x", _rounded(F.get("spectrum", F.lit(0))).alias("band_1"))


@query
def crop_padded(spark, sf_dir):
    return C.crop(P.pixels(spark, sf_dir), x=(5, 8), y=(2, 9), pad=0.5).select("y", "x")


@query
def crop_bands(spark, sf_dir):
    return C.crop(P.cube(spark, sf_dir), bands=(10, 12)).groupBy("band").agg(F.count("*").alias("n"), _rounded(F.avg("value")).alias("mean"))


@query
def line_slice(spark, sf_dir):
    return C.lines(P.clock(spark, sf_dir), 2, 5).select("line", "y")


@query
def flip_descending(spark, sf_dir):
    return C.flip_lines(P.pixels(spark, sf_dir), F.lit(True)).select("y", "x")


@query
def preview_stride(spark, sf_dir):
    return C.preview(P.cube(spark, sf_dir), 30, most=10, stride_to=5).select("band", "y", "x", _rounded("value").alias("value"))


@query
def median_spectrum(spark, sf_dir):
    return C.median_spectrum(P.cube(spark, sf_dir)).select("band", _rounded("median_value").alias("median_value"))


# counts to radiance, masks


@query
def dn_to_radiance(spark, sf_dir):
    return detector.calibrate(P.cube(spark, sf_dir), P.lut(spark, sf_dir)).select("band", "y", "x", _rounded("value").alias("value"))


@query
def mask_osf_invalid(spark, sf_dir):
    return _values(P.pixels(spark, sf_dir).withColumn("spectrum", S.mask_bands(_s())))


@query
def mask_bad_bands(spark, sf_dir):
    return _values(P.pixels(spark, sf_dir).withColumn("spectrum", S.mask_flagged(_s(), P.bad_flags())))


@query
def mask_saturation(spark, sf_dir):
    return _values(P.pixels(spark, sf_dir).withColumn("spectrum", S.mask_saturated(_s(), P.saturation())))


@query
def low_signal_mask(spark, sf_dir):
    return _values(P.lit_pixels(spark, sf_dir).withColumn("spectrum", S.mask_low_signal(_s())))


@query
def max_refl(spark, sf_dir):
    return _values(P.pixels(spark, sf_dir).withColumn("spectrum", S.at_most(_s(), 0.1)))


@query
def cosinc_mask(spark, sf_dir):
    return P.lines(spark, sf_dir).select("y", _rounded(R.valid_cosine(R.cos_incidence(F.col("inc") * 1.2))).alias("cos_inc"))


@query
def interp_bands_maxgap(spark, sf_dir):
    return _values(P.holed_pixels(spark, sf_dir).withColumn("spectrum", S.interpolate(_s(), 11)))


@query
def bad_band_buffer(spark, sf_dir):
    """All parts: a block of as many as there are bands is a setting, so no window holds more."""
    block, band = F.floor(F.col("p_partkey") / K.BANDS).cast("long"), (F.col("p_partkey") % K.BANDS + 1).cast("int")
    flags = P.table(spark, sf_dir, "part").select(block.alias("exp_gain"), band.alias("band"), (F.col("p_size") > 45).alias("bad"))
    return detector.buffered(flags, 2).select(F.col("exp_gain").alias("block"), "band", "bad")


@query
def lut_denoise(spark, sf_dir):
    out = detector.denoise(P.luts(spark, sf_dir), 1.0, 0.5)
    return out.select(F.col("exp_gain").alias("lut"), "band", "x", _rounded("gain").alias("gain"), _rounded("offset").alias("offset"))


@query
def stripe_counts(spark, sf_dir):
    return detector.stripes(P.cube(spark, sf_dir)).select("band", "x", "n_off")


@query
def stripe_flags(spark, sf_dir):
    return detector.stripes(P.cube(spark, sf_dir), 1.0).select("band", "x", "is_stripe")


# sun geometry


@query
def line_times(spark, sf_dir):
    return sun.line_times(spark, 1_600_000_000.0, 24.8, 500).select("line", _rounded("t").alias("t"))


@query
def sun_incidence(spark, sf_dir):
    lit = sun.illumination(P.clock(spark, sf_dir), P.knots(spark, sf_dir), descending=True)
    return lit.select("line", _rounded("inc").alias("inc"), _rounded("iaz").alias("iaz"))


@query
def solar_flux(spark, sf_dir):
    c = spark.createDataFrame([(b, v) for b, v in enumerate(P.irradiance(), 1)], "band int, l double")
    return c.select("band", _rounded(R.solar_flux(F.col("l"), 0.9855)).alias("flux"), _rounded(R.solar_flux_rounded(F.col("l"))).alias("flux_rounded"))


@query
def reflectance(spark, sf_dir):
    lit = sun.illumination(P.clock(spark, sf_dir), P.knots(spark, sf_dir)).select("product_id", "y", "inc", "iaz")
    p = calibration.with_lines(P.lit_pixels(spark, sf_dir), lit)
    return _values(calibration.to_reflectance(p, P.wavelengths(), P.flux()))


@query
def brightness_temp(spark, sf_dir):
    return _values(P.lit_pixels(spark, sf_dir).withColumn("spectrum", F.transform(_s(), lambda v, i: R.brightness_temperature(v, F.get(P.wavelengths(), i)))))


@query
def mean_temperature(spark, sf_dir):
    return P.lit_pixels(spark, sf_dir).select("y", "x", _rounded(S.mean_temperature(_s(), P.wavelengths(), P.THERMAL)).alias("t"))


@query
def thermal_radiance(spark, sf_dir):
    return _values(P.lit_pixels(spark, sf_dir).withColumn("spectrum", S.thermal_radiance(_s(), P.wavelengths(), P.THERMAL)))


# along bands


@query
def boxcar_w3(spark, sf_dir):
    return _values(P.holed_pixels(spark, sf_dir).withColumn("spectrum", S.boxcar(_s(), 3)))


@query
def boxcar_w4(spark, sf_dir):
    return _values(P.holed_pixels(spark, sf_dir).withColumn("spectrum", S.boxcar(_s(), 4)))


@query
def boxcar_strict(spark, sf_dir):
    return _values(P.holed_pixels(spark, sf_dir).withColumn("spectrum", S.boxcar(_s(), 3, 3)))


@query
def gaussian_w3(spark, sf_dir):
    return _values(P.holed_pixels(spark, sf_dir).withColumn("spectrum", S.gaussian(_s(), 3)))


@query
def polish(spark, sf_dir):
    return _values(P.pixels(spark, sf_dir).withColumn("spectrum", S.polish(_s(), P.polish_coefficients(), 40)))


# terrain and location


@query
def dem_gradient(spark, sf_dir):
    return terrain.gradient(P.dem(spark, sf_dir), 2.0, 3.0).select("y", "x", _rounded("dz_dx").alias("dz_dx"), _rounded("dz_dy").alias("dz_dy"))


@query
def dem_cos_inc(spark, sf_dir):
    return terrain.cos_incidence(P.dem(spark, sf_dir), P.lines(spark, sf_dir)).select("y", "x", _rounded("cos_inc").alias("cos_inc"))


@query
def illumination_report(spark, sf_dir):
    c = terrain.cos_incidence(P.dem(spark, sf_dir), P.lines(spark, sf_dir))
    return terrain.illumination_report(c).select("has_missing", _rounded("least").alias("least"), "any_negative")


@query
def dem_regrid(spark, sf_dir):
    """Targets of a last line that is not whole sum the cells it has."""
    xs, ys = P.regrid_targets(spark, sf_dir)
    return terrain.regrid(P.dem(spark, sf_dir).select("y", "x", "z"), xs, ys, step=1.0).select("y", "x", _rounded("z").alias("z"))


@query
def lon_wrap(spark, sf_dir):
    return P.table(spark, sf_dir, "customer").select("c_custkey", _rounded(R.wrap_longitude(F.col("c_acctbal"))).alias("lon"))


@query
def geom_points(spark, sf_dir):
    p = geometry.in_box(P.geometry(spark, sf_dir), (150.0, None, -20.0, 5.0), 1.0, center=True)
    return p.select("Pixel", "Scan", _rounded("Longitude").alias("Longitude"), _rounded("Latitude").alias("Latitude"))


@query
def geom_extent(spark, sf_dir):
    return geometry.pixel_extent(geometry.in_box(P.geometry(spark, sf_dir), (155.0, 178.0, -19.0, None), 0.5))


@query
def geom_corners(spark, sf_dir):
    p = geometry.control_points(geometry.in_box(P.geometry(spark, sf_dir), (155.0, 178.0, -19.5, None)), corners_only=True)
    return p.select("row", "col", _rounded("x").alias("x"), _rounded("y").alias("y"))


@query
def latlon_pivot(spark, sf_dir):
    out = geometry.pivot(P.geometry(spark, sf_dir), "Latitude", [50.0 * k for k in range(6)])
    return out.select("y", *(_rounded(c).alias(c) for c in out.columns[1:]))


@query
def tps_grid(spark, sf_dir):
    """The splines through every point of the geometry grid, evaluated at every pixel; longitudes are not wrapped, so they have no jump."""
    out = geometry.spline_grid(P.geometry(spark, sf_dir), P.pixels(spark, sf_dir).select("x", "y"))
    return out.select("x", "y", _rounded("lon").alias("lon"), _rounded("lat").alias("lat"))


@query
def regular_grid(spark, sf_dir):
    p = P.pixels(spark, sf_dir).select((F.col("x") * 1.1 + F.col("y") * 0.2).alias("lon"), (F.col("y") * 0.9 - F.col("x") * 0.1).alias("lat"), F.get("spectrum", F.lit(0)).alias("value"))
    out = geometry.regular_grid(p, 12, 10)
    return out.select(*(_rounded(c).alias(c) for c in out.columns))


# names, labels, files


@query
def basename(spark, sf_dir):
    made = F.concat(F.lit("sat_img_nci_"), F.lpad(F.col("p_partkey").cast("string"), 8, "2"), F.when(F.col("p_partkey") % 3 > 0, "T"), F.lpad((F.col("p_partkey") * 7).cast("string"), 10, "1"), F.lit("_g_grd_d32.csv"))
    return P.table(spark, sf_dir, "part").select("p_partkey", N.basename(F.coalesce(made, F.col("p_name"))).alias("basename"), N.stem_token(F.coalesce(made, F.col("p_name"))).alias("token"))


@query
def exp_gain_key(spark, sf_dir):
    return P.table(spark, sf_dir, "part").select("p_partkey", N.exposure_gain(F.concat(F.lit("E"), (F.col("p_size") % 4 + 1).cast("string")), F.lit("G2")).alias("exp_gain"))


@query
def proj_lookup(spark, sf_dir):
    n = P.table(spark, sf_dir, "nation")
    proj = F.when(F.col("n_nationkey") % 3 > 0, "Polar Stereographic")
    area = F.when(F.col("n_nationkey") % 3 == 1, "South Pole").when(F.col("n_nationkey") % 3 == 2, "North Pole")
    key = N.projection_key(proj, area)
    return n.select("n_nationkey", key.alias("key"), F.substring(N.projection_wkt(key), 1, 40).alias("wkt"))


@query
def solar_distance(spark, sf_dir):
    ids = F.array(*(F.lit(k) for k in K.SOLAR_DISTANCE))
    name = F.concat(F.lit("sat_img_nci_"), F.coalesce(F.get(ids, (F.col("p_partkey") % 8).cast("int")), F.lit("20000101T0000000000")))
    return P.table(spark, sf_dir, "part").select("p_partkey", N.solar_distance(name).alias("au"))


@query
def md5_verify(spark, sf_dir):
    d = P.table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    files = d.select("doc_id", integrity.md5(F.col("text").cast("binary")).alias("md5"))
    said = d.select("doc_id", F.when(F.col("doc_id") % 10 == 0, F.md5(F.lit(b"other"))).otherwise(F.upper(F.md5(F.col("text").cast("binary")))).alias("md5_checksum"))
    return integrity.verify(files, said, "doc_id").select("doc_id", "md5", "ok")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label a page, with namespaces, repeated elements and a missing field now and then."""
    k = F.col("page_id")
    xml = F.format_string('<p:Product xmlns:p="urn:p" xmlns:isda="urn:i"><isda:exposure>E%d</isda:exposure><isda:gain>G2</isda:gain>%s<start_date_time>2021-06-22T12:%02d:56.344Z</start_date_time><Axis_Array><elements>256</elements></Axis_Array><Axis_Array><elements>%d</elements></Axis_Array><Band_Bin><center_wavelength>%d.5</center_wavelength></Band_Bin><Band_Bin><center_wavelength>%d.25</center_wavelength></Band_Bin></p:Product>', k % 4 + 1, F.when(k % 2 == 0, "<isda:area>Equatorial</isda:area>").otherwise(""), k % 60, k, k, k + 17)
    return P.table(spark, sf_dir, "pages").select("page_id", xml.alias("xml"))


@query
def label_metaget(spark, sf_dir):
    x = F.col("xml")
    wl = N.xml_numbers(x, "center_wavelength")
    at = F.unix_micros(F.to_timestamp(N.xml_text(x, "start_date_time"))) / 1e6
    return _labels(spark, sf_dir).select(
        "page_id", N.exposure_gain(N.xml_text(x, "isda:exposure"), N.xml_text(x, "isda:gain")).alias("exp_gain"), N.xml_text(x, "area").alias("area"), at.alias("start"),
        F.get(N.xml_numbers(x, "elements", "long"), F.lit(1)).alias("lines"), F.array_join(F.transform(wl, N.wavelength_label), "; ").alias("labels"),
    )


@query
def catalog_files(spark, sf_dir):
    k = F.col("page_id")
    kinds = F.array(*map(F.lit, ("data/raw/a.qub", "data/calibrated/20210622/{}.qub", "miscellaneous/calibrated/x/{}.spm", "geometry/calibrated/{}.csv", "data/calibrated/{}.xml", "browse/calibrated/{}.png", "data/calibrated/{}.hdr")))
    path = F.replace(F.concat(F.lit("/archive/"), F.get(kinds, (k % 7).cast("int"))), F.lit("{}"), F.concat(F.lit("sat_img_nci_"), k.cast("string"), F.lit("_d_img_d32")))
    return tables.catalogue(P.table(spark, sf_dir, "pages").select(path.alias("path")), level=1)


@query
def spm_records(spark, sf_dir):
    k = F.col("event_id")
    t = F.col("ts").cast("timestamp")
    two = lambda e: F.lpad(e.cast("string"), 2, "0")
    line = F.concat_ws(" ", F.lit(" SPM"), k.cast("string"), F.concat(F.lit("142"), F.year(t).cast("string")), two(F.month(t)), two(F.day(t)), two(F.hour(t)), two(F.minute(t)), two(F.second(t)), (k % 1000).cast("string"), *([F.lit("1.5")] * 8), (k % 360).cast("string"), (F.lit(-0.25) * k).cast("string"))
    r = tables.parse_spm(P.table(spark, sf_dir, "events").select(line.alias("value")))
    return r.select(F.col("row").cast("long").alias("row"), "year", _rounded("timestamp").alias("timestamp"), "sun_az", "sun_elev")


# readers, of files that are written from the tables first


@query
def qub_long(spark, sf_dir):
    c = qub.read_qub(spark, P.cube_file(spark, sf_dir)).where("value IS NOT NULL")
    return c.select("band", "y", "x", _rounded("value").alias("value"))


@query
def qub_to_rad(spark, sf_dir):
    """The calibration of counts, on spectra as the reader of cube files yields them."""
    p = qub.read_qub(spark, P.cube_file(spark, sf_dir), 7, "spectral").where(F.exists("spectrum", lambda v: v.isNotNull()))
    return _values(calibration.to_radiance(p, P.lut(spark, sf_dir), P.saturation(), P.BANDS))


@query
def gain_offset_file(spark, sf_dir):
    lines = P.part_lines(spark, sf_dir, F.col("p_retailprice") / 1e5, F.col("p_size") / 100.0)
    t = tables.read_gain_offset(spark, P.text_file(spark, lines, "sat_cal_e3g2_lut_coeff.csv"), samples=P.SAMPLES)
    return t.select("exp_gain", "band", "x", _rounded("gain").alias("gain"), _rounded("offset").alias("offset"))


@query
def saturation_file(spark, sf_dir):
    k = F.col("p_partkey")
    lines = P.part_lines(spark, sf_dir, k, F.col("p_size"), F.when(k % 7 == 0, -9999.0).when(k % 7 == 1, 16384.0).otherwise(F.col("p_retailprice")))
    path = P.text_file(spark, lines, "sat_cal_e4g2_saturations_radiance.csv")
    t = tables.read_saturation(spark, path, sentinels=False).withColumnRenamed("saturation", "range")
    both = t.join(tables.read_saturation(spark, path, "radiance"), ["exp_gain", "band"])
    return both.select("exp_gain", "band", _rounded("range").alias("range"), _rounded("saturation").alias("saturation"))


@query
def validity_file(spark, sf_dir):
    k = F.col("p_partkey")
    lines = P.headed(spark, P.part_lines(spark, sf_dir, k + 1, F.lit(1), (F.col("p_size") <= 45).cast("int")), "band,e1g2,e2g2")
    return detector.bad_bands(tables.read_validity(spark, P.text_file(spark, lines, "validity.csv")), "e2g2", 2)


@query
def polish_file(spark, sf_dir):
    lines = P.headed(spark, P.part_lines(spark, sf_dir, F.col("p_partkey") + 8, 1 + F.col("p_size") / 1000.0), "band,polish")
    return tables.read_polish(spark, P.text_file(spark, lines, "polish.csv")).select("band", _rounded("polish").alias("polish"))


@query
def solar_flux_file(spark, sf_dir):
    lines = P.part_lines(spark, sf_dir, F.lit(800.1234) + 17.25 * F.col("p_partkey"), F.col("p_retailprice") / 10.0, sep="\t")
    t = tables.read_solar_flux(spark, P.text_file(spark, lines, "flux.txt"), 0.9855)
    return t.select("band", "wl", _rounded("flux").alias("flux"))


@query
def geometry_file(spark, sf_dir):
    g = P.geometry(spark, sf_dir).select(F.monotonically_increasing_id().alias("n"), F.concat_ws(",", F.col("Latitude") + 0.0, "Scan", "Pixel", "Longitude").alias("value"))
    t = geometry.wrapped(tables.read_geometry(spark, P.text_file(spark, P.headed(spark, g, "Latitude,Scan,Pixel,Longitude"), "grid.csv")), center=True)
    return t.select("Pixel", "Scan", _rounded("Longitude").alias("Longitude"), _rounded("Latitude").alias("Latitude"))


@query
def points_file(spark, sf_dir):
    g = P.geometry(spark, sf_dir).select(F.monotonically_increasing_id().alias("n"), F.concat_ws(",", "Longitude", "Latitude", "Pixel", "Scan", F.lit(1)).alias("value"))
    points, crs = tables.read_control_points(spark, P.text_file(spark, P.headed(spark, g, "#CRS: SOME WKT", "mapX,mapY,sourceX,sourceY,enable"), "a.points"))
    return points.select("row", "col", _rounded("x").alias("x"), _rounded("y").alias("y"), F.lit(crs).alias("crs"))


# chains


@query
def verma_pipeline(spark, sf_dir):
    p = P.lit_pixels(spark, sf_dir).withColumn("spectrum", F.transform(_s(), lambda v: v * 100.0))
    p = p.join(F.broadcast(P.lines(spark, sf_dir).select("product_id", "y", "inc")), ["product_id", "y"])  # a row a line
    return _values(calibration.verma_reflectance(p, P.wavelengths(), P.flux_rounded(), P.polish_coefficients(), F.col("inc"), 3, P.THERMAL).drop("inc"))


@query
def l0_to_rad(spark, sf_dir):
    return _values(calibration.to_radiance(P.pixels(spark, sf_dir), P.lut(spark, sf_dir), P.saturation(), P.BANDS))


@query
def l1_to_refl(spark, sf_dir):
    p = calibration.with_lines(P.lit_pixels(spark, sf_dir), P.lines(spark, sf_dir))
    return _values(calibration.to_reflectance(p, P.wavelengths(), P.flux(), "verma", thermal_bands=P.THERMAL).drop("inc", "iaz", "lat"))


@query
def full_refl(spark, sf_dir):
    p = calibration.with_lines(P.lit_pixels(spark, sf_dir), P.lines(spark, sf_dir))
    out = calibration.full_reflectance(p, P.wavelengths(), P.flux(), P.bad_flags(), signal_band=10, least_signal=0.5, max_refl=0.005, polish=P.polish_coefficients(), smoothing="boxcar", width=3, thermal_bands=P.THERMAL)
    return _values(out.drop("inc", "iaz", "lat"))


@query
def fourier_destripe_default(spark, sf_dir):
    out = fourier.destripe(P.cube(spark, sf_dir))
    return out.select("band", "y", "x", _rounded("value").alias("value"))


@query
def fourier_destripe_tilted(spark, sf_dir):
    out = fourier.destripe(P.cube(spark, sf_dir), 0.7, 0.2, 0.4, 0.1)
    return out.select("band", "y", "x", _rounded("value").alias("value"))
