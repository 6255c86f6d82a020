"""L0 and L1 products: thin objects over lazily read tables. Constructors look up paths and labels and run no job on the cube."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import radiometry as R
from ..operators import cube as C
from ..operators import detector, geometry, spectra, sun, terrain
from ..sources import files, integrity, qub, tables
from . import calibration

Extent = tuple[float | None, float | None, float | None, float | None]


class Product:
    """An observation of one level below an archive folder."""

    level = 1

    def __init__(self, spark: SparkSession, basename: str, directory: str, extent: Extent = (None,) * 4, chunk: int | None = None):
        found = re.search(r"\d{8}T\d{10}", basename)
        if not found:
            raise ValueError(f"no observation id in: {basename}")
        self.spark, self.basename, self.directory, self.chunk = spark, found.group(), directory, chunk
        self.paths = self._find()
        if "qub" not in self.paths:
            integrity.unpack(directory, self.basename, self.level)
            self.paths = self._find()
        if "qub" not in self.paths:
            raise FileNotFoundError(f"no image of {self.basename} below {directory}")
        self.labels = tables.read_labels(spark, self.paths["xml"])
        self.metadata = tables.products(self.labels).first().asDict()
        self._open(extent)

    def _open(self, extent: Extent) -> None:
        """The image within inclusive labels: in long form, and as pixels in the order of the file's lines, so no operator along bands shuffles the cube."""
        self.extent = extent
        self.cube, self.pixels = (qub.read_qub(self.spark, self.paths["qub"], self.chunk, form, extent[:2], extent[2:]) for form in ("long", "spectral"))

    def _find(self) -> dict[str, str]:
        """The first file of each kind below the archive folder, in whatever store it is."""
        names = [p for p in files.listing(self.spark, self.directory) if self.basename in p.rsplit("/", 1)[-1].rsplit(".", 1)[0]]
        out = {}
        for ext, folder in K.ARCHIVE_FOLDERS.items():
            below = f"/{folder}/{'calibrated' if folder == 'geometry' else K.LEVEL_NAMES[self.level]}/"
            if found := next((p for p in names if below in p and p.endswith("." + ext.split("-")[0])), None):
                out[ext] = found
        return out

    def metaget(self, key: str) -> str | None:
        return tables.metaget(self.labels, key).first()["value"]

    def checksum(self) -> None:
        """ChecksumError if the image is not what its label says."""
        files = integrity.file_md5(self.spark, self.spark.createDataFrame([(self.paths["qub"],)], "path string"))
        said = self.spark.createDataFrame([(self.paths["qub"], self.metadata["md5_checksum"])], "path string, md5_checksum string")
        integrity.require(integrity.verify(files, said))

    def preview(self, band: int, x: C.Range = (None, None), y: C.Range = (None, None)) -> DataFrame:
        """One band, thinned, in the order of display: an L0 image and a descending L1 image are upside down."""
        up = self.level == 0 or self.metadata["orbit_direction"] == "descending"
        return C.preview(C.crop(self.cube, x, y), band).orderBy(F.col("y").desc() if up else F.col("y"), "x")

    def line_geometry(self) -> DataFrame:
        """(product_id, y, inc, iaz) of every line."""
        m = self.metadata
        start = m["start_time"].timestamp()
        clock = sun.line_times(self.spark, start, m["line_exposure_duration"], m["lines"])
        spm = tables.read_spm(self.spark, self.paths["spm"])
        lit = sun.illumination(clock, spm, m["orbit_direction"] == "descending")
        return lit.select(F.lit(self.basename).alias("product_id"), (F.col("line") + 0.5).alias("y"), "inc", "iaz")


class L0(Product):
    """Raw counts."""

    level = 0

    def calibrate_to_rad(self, denoise_gain: bool = False, interp_bands: str | None = "linear", calib_dir: str = ".") -> DataFrame:
        """Pixels of radiance. Gains come from ``calib_dir``; FileNotFoundError where the setting's table is not there."""
        key = self.metadata["exp_gain"]
        lut = tables.read_gain_offset(self.spark, tables.lut_path(calib_dir, key), key)
        if denoise_gain:
            lut = detector.denoise(lut, *K.OUTLIER_Z.get(key, (1.0, 1.0)))
        limit = tables.read_saturation(self.spark, tables.lut_path(calib_dir, key, "saturations_radiance"))
        bands = self.metadata["bands"]
        return calibration.to_radiance(self.pixels, lut, detector.band_array(limit, "saturation", bands), bands, interpolated=interp_bands is not None)

    def calibrate_to_l1(self, **options) -> L1:
        """The L1 product of the same observation with its image replaced by this one's radiance; RuntimeError without one."""
        try:
            l1 = L1(self.spark, self.basename, self.directory, self.extent, chunk=self.chunk)
        except FileNotFoundError as e:
            raise RuntimeError(f"no L1 product of {self.basename}") from e
        l1.pixels = self.calibrate_to_rad(**options)
        l1.cube = C.to_long(l1.pixels)
        return l1

    def detect_stripes(self, sigma: float = 1.0) -> DataFrame:
        return detector.stripes(self.cube, sigma)


class L1(Product):
    """Radiance in W/m2/sr/um, with geometry."""

    level = 1

    def __init__(self, spark: SparkSession, basename: str, directory: str, extent: Extent = (None,) * 4, latlon_extent: Extent = (None,) * 4, chunk: int | None = None):
        if any(e is not None for e in extent) and any(e is not None for e in latlon_extent):
            raise ValueError("give extent or latlon_extent, not both")
        super().__init__(spark, basename, directory, extent, chunk)
        self.points = None
        if "csv" in self.paths:
            grid = tables.read_geometry(spark, self.paths["csv"])
            self.points = geometry.in_box(grid, latlon_extent, center=True)
            if any(e is not None for e in latlon_extent):
                e = geometry.pixel_extent(self.points).first()
                if e[0] is None:
                    raise ValueError("no geometry points within latlon_extent")
                self._open(tuple(e))
        self.cube = self.cube.withColumn("value", F.col("value") * K.RADIANCE_SCALE)
        self.pixels = self.pixels.withColumn("spectrum", spectra.scale(F.col("spectrum"), K.RADIANCE_SCALE))

    def control_points(self, corners_only: bool = False) -> DataFrame:
        return geometry.control_points(self.points, corners_only)

    def located(self) -> DataFrame:
        """(x, y, lon, lat) of every pixel of the crop, by splines through the geometry grid."""
        return geometry.spline_grid(self.points, self.pixels.select("x", "y"))

    def calibrate_to_refl(self, solar: str, dem: DataFrame | None = None, thermal_corr: str = "", lat: DataFrame | None = None) -> DataFrame:
        """Pixels of I/F. ``solar`` is a solar flux file; ``dem`` (y, x, z) and ``lat`` (y, lat) give slopes their own incidence."""
        flux = tables.read_solar_flux(self.spark, solar, self.metadata["solar_distance"])
        bands = self.metadata["bands"]
        wl, f = detector.band_array(flux.withColumn("wl", F.col("wl") * 1e-9), "wl", bands), detector.band_array(flux, "flux", bands)
        lines = self.line_geometry()
        if dem is None:
            return calibration.to_reflectance(calibration.with_lines(self.pixels, lines), wl, f, thermal_corr)
        cos = terrain.cos_incidence(dem.withColumn("product_id", F.lit(self.basename)), lines.join(lat, "y"))
        return calibration.to_reflectance(self.pixels.join(cos, ["product_id", "y", "x"]), wl, f, thermal_corr, F.col("cos_inc")).drop("cos_inc")
