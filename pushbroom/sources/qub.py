"""Band-sequential image cubes as a Spark data source, and writers of them.

``spark.read.format("qub").load(path)`` gives (product_id, band, y, x, value), and with option form=spectral
(product_id, y, x, spectrum), a partition a block of lines. Options bands, y and x ("low:high", inclusive, either may be empty) say
which part to read, and only those bytes are read. They are options and not pushed filters, as Spark 4.1 keeps what was once pushed to a Python
reader for all queries of one table. A block of lines has all bands of its pixels, so the spectral form needs no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.workers import importable
from ..operators.cube import Range, chunk_lines
from .files import opened, with_suffix

SCHEMA = "product_id string, band int, y double, x double, value double"
SPECTRA = "product_id string, y double, x double, spectrum array<double>"
#: Bytes of 4-byte values in a block of spectra, and values in a batch of them.
SPECTRA_BYTES, BATCH_VALUES = 16e6, 1_000_000
#: Types of the header's data type codes.
_KINDS = {1: "u1", 2: "i2", 3: "i4", 4: "f4", 5: "f8", 12: "u2", 13: "u4"}


def read_header(path: str) -> dict:
    """Fields of the text header beside a cube: samples, lines, bands, type, byte order, offset and wavelengths."""
    with opened(with_suffix(path, ".hdr")) as f:
        text = f.read().decode()
    got = {k.strip().lower(): v.strip() for k, v in re.findall(r"^([^=\n]+)=\s*(\{[^}]*\}|[^\n]*)", text, re.M)}
    kind = np.dtype((">" if got.get("byte order", "0") == "1" else "<") + _KINDS[int(got["data type"])])
    if got.get("interleave", "bsq").lower() != "bsq":
        raise ValueError("only band-sequential cubes are read")
    wl = [float(v) for v in got.get("wavelength", "{}").strip("{}").split(",") if v.strip()]
    return {"samples": int(got["samples"]), "lines": int(got["lines"]), "bands": int(got["bands"]), "kind": kind, "offset": int(got.get("header offset", 0)), "wavelength": wl}


class Block(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class QubReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.bounds = {"band": self._range("bands"), "y": self._range("y"), "x": self._range("x")}

    def _range(self, name: str) -> tuple[float, float]:
        low, _, high = self.options.get(name, ":").partition(":")
        return float(low or "-inf"), float(high or "inf")

    def partitions(self) -> list[Block]:
        out = []
        for path in sorted(self.options["path"].split(",")):
            h = read_header(path)
            low, high = self.bounds["y"]
            first, last = max(0, int(np.ceil(max(low, 0.5) - 0.5))), int(np.floor(min(high, h["lines"] - 0.5) - 0.5))
            size = {"size": SPECTRA_BYTES} if self.options.get("form") == "spectral" else {}
            step = int(self.options.get("chunklines", 0)) or max(1, chunk_lines(h["bands"], h["samples"], **size))
            out += [Block(path, y, min(y + step, last + 1)) for y in range(first, last + 1, step)]
        return out or [Block("", 0, 0)]

    def read(self, part: Block) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        h = read_header(part.path)
        span = lambda name, n, off: np.flatnonzero((np.arange(n) + off >= self.bounds[name][0]) & (np.arange(n) + off <= self.bounds[name][1]))
        bands, xs = span("band", h["bands"], 1), span("x", h["samples"], 0.5)
        found = re.search(r"\d{8}T\d{10}", part.path)
        name = found.group() if found else part.path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        names = lambda n: pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, np.int32)), [name]).cast(pa.string())

        def image(file, band: int) -> np.ndarray:
            """The block's lines of a band, as far as samples are wanted."""
            file.seek(h["offset"] + (band * h["lines"] + part.start) * h["samples"] * h["kind"].itemsize)
            got = np.frombuffer(file.read((part.stop - part.start) * h["samples"] * h["kind"].itemsize), h["kind"])
            return got.reshape(-1, h["samples"])[:, xs[0] : xs[-1] + 1].astype(np.float64)

        if not len(xs):
            return
        with opened(part.path) as file:
            if self.options.get("form") == "spectral":
                lines = np.arange(part.start, part.stop)
                step = max(1, BATCH_VALUES // (h["bands"] * len(xs)))
                cube = np.stack([image(file, b) for b in range(h["bands"])], axis=2) if len(lines) else np.empty((0, len(xs), h["bands"]))
                for n in range(0, len(lines), step):
                    v, ys = cube[n : n + step], lines[n : n + step] + 0.5
                    flat = v.ravel()
                    spectra = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, h["bands"], dtype=np.int32)), pa.array(flat, mask=np.isnan(flat)))
                    yield pa.RecordBatch.from_arrays([names(len(spectra)), pa.array(np.repeat(ys, len(xs))), pa.array(np.tile(xs + 0.5, len(ys))), spectra], ["product_id", "y", "x", "spectrum"])
                return
            for b in bands:
                v = image(file, int(b))
                ny, nx = v.shape
                value = pa.array(v.ravel(), mask=np.isnan(v.ravel()))  # missing is NULL
                y, x = np.repeat(np.arange(part.start, part.stop) + 0.5, nx), np.tile(xs + 0.5, ny)
                yield pa.RecordBatch.from_arrays([names(ny * nx), pa.array(np.full(ny * nx, b + 1, np.int32)), pa.array(y), pa.array(x), value], ["product_id", "band", "y", "x", "value"])


class QubSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "qub"

    def schema(self) -> str:
        return SPECTRA if self.options.get("form") == "spectral" else SCHEMA

    def reader(self, schema) -> QubReader:
        return QubReader(dict(self.options))


def read_qub(spark: SparkSession, path: str, chunk: int | None = None, form: str = "long", x: Range = (None, None), y: Range = (None, None), bands: Range = (None, None)) -> DataFrame:
    """The part of the cube at ``path`` within inclusive labels, in long or spectral ``form`` (which has all bands); ``chunk`` lines a partition (by size if None)."""
    importable(spark)
    spark.dataSource.register(QubSource)
    span = lambda r: ":".join("" if v is None else repr(float(v)) for v in r)
    return spark.read.format("qub").options(chunkLines=chunk or 0, form=form, x=span(x), y=span(y), bands=span(bands)).load(path)


def write_cube(cube: DataFrame, path: str, crs: str = "IAU_2015:30135", wl: list[float] | None = None) -> None:
    """Parquet by product, with CRS and wavelengths as metadata of the value column; missing values are NULL."""
    value = F.col("value").alias("value", metadata={"crs": crs, "nodata": "NULL", "wavelength": [f"{w:g}" for w in wl or []]})
    cube.withColumn("value", F.when(~F.isnan("value"), F.col("value"))).select(*(c for c in cube.columns if c != "value"), value).write.partitionBy("product_id").parquet(path)


def write_envi(cube: DataFrame, path: str, wl: list[float] | None = None) -> None:
    """One product's cube as a band-sequential float file with a text header; band names are wavelengths to two digits.

    Rows stream to the driver in file order, a partition at a time, for cubes that one machine is to open.
    """
    shape = cube.agg(F.countDistinct("band"), F.countDistinct("y"), F.countDistinct("x")).first()
    with open(path, "wb") as out:
        for rows in _blocks(cube.orderBy("band", "y", "x").select("value").toLocalIterator()):
            out.write(np.array([np.nan if v is None else v for v in rows], "<f4").tobytes())
    names = f"band names = {{{', '.join(f'{w:.2f}' for w in wl)}}}\nwavelength = {{{', '.join(f'{w:g}' for w in wl)}}}\n" if wl else ""
    Path(path).with_suffix(".hdr").write_text(f"ENVI\nsamples = {shape[2]}\nlines = {shape[1]}\nbands = {shape[0]}\nheader offset = 0\ndata type = 4\ninterleave = bsq\nbyte order = 0\ndata ignore value = nan\n{names}")


def _blocks(rows: Iterator, size: int = 65536) -> Iterator[list]:
    block = []
    for r in rows:
        block.append(r[0])
        if len(block) == size:
            yield block
            block = []
    yield block


def write_output(cube: DataFrame, path: str, wl: list[float] | None = None) -> None:
    """By suffix: ``.img`` as ENVI, ``.parquet`` or none as Parquet. Raster suffixes are a ValueError: no library here writes those."""
    kind = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")
    if kind[1] and kind[2].lower() in ("tif", "tiff", "jp2", "nc", "vrt"):
        raise ValueError(f"cannot write {kind[2]} files: {path}; give .img for ENVI or .parquet")
    (write_envi if path[-4:].lower() == ".img" else write_cube)(cube, path, wl=wl)
