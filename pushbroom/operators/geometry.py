"""Geometry grids: extents, control points, and thin-plate splines over them."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import radiometry as R
from ..functions.workers import importable
from .sun import small

Extent = tuple[float | None, float | None, float | None, float | None]
#: Centres up to which one spline is solved, on the driver, in time with their cube; and those of a tile of a larger grid, about.
MANY_CENTRES, TILE_CENTRES = 5000, 60


def wrapped(grid: DataFrame, center: bool = False) -> DataFrame:
    """``grid`` (Pixel, Scan, Longitude, Latitude) with longitudes in [-180, 180) and, if ``center``, pixel centres."""
    out = grid.withColumn("Longitude", R.wrap_longitude(F.col("Longitude")))
    return out.withColumns({c: F.col(c) + 0.5 for c in ("Pixel", "Scan")}) if center else out


def in_box(grid: DataFrame, extent: Extent = (None,) * 4, buffer: float = 0.0, center: bool = False) -> DataFrame:
    """Grid points within inclusive longitude and latitude bounds, widened by ``buffer`` degrees; None is the whole globe."""
    lon0, lon1, lat0, lat1 = (d if e is None else e for e, d in zip(extent, (-180, 180, -90, 90)))
    g = wrapped(grid, center)
    return g.where(F.col("Longitude").between(lon0 - buffer, lon1 + buffer) & F.col("Latitude").between(lat0 - buffer, lat1 + buffer))


def pixel_extent(points: DataFrame) -> DataFrame:
    """(min_pixel, max_pixel, min_scan, max_scan), all NULL for no points."""
    return points.agg(F.min("Pixel").alias("min_pixel"), F.max("Pixel").alias("max_pixel"), F.min("Scan").alias("min_scan"), F.max("Scan").alias("max_scan"))


def control_points(points: DataFrame, corners_only: bool = False, compat: bool = False) -> DataFrame:
    """(row, col, x, y) control points. Corners are points at an extreme pixel and an extreme scan; with
    ``compat`` an extreme of either kind serves for both, as in the original selection.
    """
    p = points
    if corners_only:
        e = pixel_extent(points)
        p = p.crossJoin(F.broadcast(e))  # one row
        pixel, scan = ("min_pixel", "max_pixel"), ("min_scan", "max_scan")
        any_of = lambda c, names: F.col(c).isin(*(F.col(n) for n in names))
        p = p.where(any_of("Pixel", pixel + scan if compat else pixel) & any_of("Scan", pixel + scan if compat else scan))
    return p.select(F.col("Scan").alias("row"), F.col("Pixel").alias("col"), F.col("Longitude").alias("x"), F.col("Latitude").alias("y"))


def pivot(grid: DataFrame, value: str, pixels: list[float], center: bool = False) -> DataFrame:
    """A two-dimensional grid: one row a scan line, one column a pixel of ``pixels``; labels shift to 1-based, or to centres."""
    shift = 0.5 if center else 1.0
    g = wrapped(grid).select((F.col("Scan") + shift).alias("y"), (F.col("Pixel") + shift).alias("x"), value)
    out = g.groupBy("y").pivot("x", [p + shift for p in pixels]).agg(F.first(value))
    return out.toDF("y", *(f"x_{p:g}".replace(".", "_") for p in pixels))


def _kernel(d2: np.ndarray) -> np.ndarray:
    return np.where(d2 > 0, 0.5 * d2 * np.log(np.where(d2 > 0, d2, 1.0)), 0.0)


def spline_weights(x: np.ndarray, y: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, polynomial, frame) of the thin-plate spline through (x, y): values, its columns.

    Coordinates are shifted and scaled to [-1, 1] by ``frame`` (2 x 2), which keeps the system well conditioned.
    """
    n = len(x)
    p = np.column_stack([x, y]).astype(float)
    shift = (p.max(0) + p.min(0)) / 2
    size = np.where(np.ptp(p, axis=0) > 0, np.ptp(p, axis=0) / 2, 1.0)
    q = (p - shift) / size
    poly = np.column_stack([np.ones(n), q])
    d2 = ((q[:, None] - q[None]) ** 2).sum(2)
    a = np.block([[_kernel(d2), poly], [poly.T, np.zeros((3, 3))]])
    sol = np.linalg.solve(a, np.vstack([values, np.zeros((3, values.shape[1]))]))
    return sol[:n], sol[n:], np.array([shift, size])


def spline_values(x: np.ndarray, y: np.ndarray, values: np.ndarray, u: np.ndarray, v: np.ndarray, block: int = 2000) -> np.ndarray:
    """The spline through (x, y): values at (u, v), a block of places at a time."""
    w, poly, (shift, size) = spline_weights(x, y, values)
    q = (np.column_stack([x, y]) - shift) / size
    t = (np.column_stack([u, v]) - shift) / size
    out = np.empty((len(t), values.shape[1]))
    for k in range(0, len(t), block):
        p = t[k : k + block]
        out[k : k + block] = _kernel(((p[:, None] - q[None]) ** 2).sum(2)) @ w + np.column_stack([np.ones(len(p)), p]) @ poly
    return out


def spline_grid(centres: DataFrame, targets: DataFrame) -> DataFrame:
    """Longitude and latitude at ``targets`` (x, y) of the splines through ``centres`` (Pixel, Scan, Longitude, Latitude)."""
    c = centres.select(F.col("Pixel").alias("u"), F.col("Scan").alias("v"), F.col("Longitude").alias("a"), F.col("Latitude").alias("b"))
    return spline_at(c, targets, ("x", "y"), ("lon", "lat"))


def spline_at(centres: DataFrame, targets: DataFrame, at: tuple[str, str], names: tuple[str, str]) -> DataFrame:
    """Adds ``names`` to ``targets``: the thin-plate splines through ``centres`` (u, v, a, b) at the columns ``at``.

    Up to ``MANY_CENTRES`` centres are solved at once on the driver; their weights go to the targets in one broadcast row,
    and each target sums over them by itself, without a join or a shuffle. A larger grid is cut into tiles of about ``TILE_CENTRES``: each
    tile's targets are valued by the spline through its own centres and those of the eight tiles around it. That is exact at centres and for
    planes; between centres of a smooth grid it departs from the one spline by far less than the spline from the truth.
    """
    rows = centres.select("u", "v", "a", "b").orderBy("v", "u").limit(MANY_CENTRES + 1).collect()
    if len(rows) > MANY_CENTRES:
        return _tiled(centres, targets, at, names)
    got = np.array([tuple(r) for r in rows], dtype=float)
    w, poly, (shift, size) = spline_weights(got[:, 0], got[:, 1], got[:, 2:])
    q = (got[:, :2] - shift) / size
    spark = targets.sparkSession
    table = spark.createDataFrame([([(float(a), float(b), float(c), float(d)) for (a, b), (c, d) in zip(q, w)],)], "c array<struct<x:double,y:double,a:double,b:double>>")
    t = targets.withColumns({f"_{k}": (F.col(at[n]) - float(shift[n])) / float(size[n]) for n, k in enumerate("uv")})
    t = t.crossJoin(F.broadcast(table))  # one row

    def total(name: str, k: int):
        def term(s, c):
            d2 = (F.col("_u") - c["x"]) * (F.col("_u") - c["x"]) + (F.col("_v") - c["y"]) * (F.col("_v") - c["y"])
            return s + F.when(d2 > 0, c[name] * 0.5 * d2 * F.ln(d2)).otherwise(0.0)

        return F.aggregate("c", F.lit(0.0), term) + float(poly[0, k]) + F.col("_u") * float(poly[1, k]) + F.col("_v") * float(poly[2, k])

    return t.withColumns({names[0]: total("a", 0), names[1]: total("b", 1)}).drop("_u", "_v", "c")


def _spans_a_plane(p: np.ndarray) -> bool:
    return len(p) >= 3 and bool(np.linalg.matrix_rank(np.column_stack([np.ones(len(p)), p - p.mean(0)])) == 3)


def _tiled(centres: DataFrame, targets: DataFrame, at: tuple[str, str], names: tuple[str, str]) -> DataFrame:
    """``spline_at`` by tiles: centres and targets meet by tile, a task for some tiles.

    An axis is cut in proportion to its distinct places, so a grid of few columns is cut along its lines. Targets whose tile and the eight around it
    hold no plane, too few centres or all on one line, are dealt to tiles twice as wide, until they do.
    """
    importable(targets.sparkSession)
    e = centres.agg(F.count("*").alias("n"), *(f(c).alias(f"{k}{c}") for c in "uv" for f, k in ((F.min, "lo_"), (F.max, "hi_"), (F.approx_count_distinct, "n_")))).first()
    tiles = e.n / TILE_CENTRES
    along = min(max((tiles * e.n_u / e.n_v) ** 0.5, 1.0), max(tiles, 1.0))
    across = {"u": max(1, round(along)), "v": max(1, round(tiles / along))}

    def run(some: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        if not len(here):
            return here.drop(columns=["_i", "_j"]).assign(**{n: 0.0 for n in names})
        p = some[["u", "v"]].to_numpy(float)
        got = spline_values(p[:, 0], p[:, 1], some[["a", "b"]].to_numpy(float), here[at[0]].to_numpy(float), here[at[1]].to_numpy(float)) if _spans_a_plane(p) else np.full((len(here), 2), np.nan)
        return here.drop(columns=["_i", "_j"]).assign(**{names[0]: got[:, 0], names[1]: got[:, 1]})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in targets.schema.fields)
    parts, left = [], targets
    while True:
        cell = lambda c, k, n: F.least(F.greatest(F.floor((c - F.lit(e[f"lo_{k}"])) / F.lit((e[f"hi_{k}"] - e[f"lo_{k}"]) or 1.0) * n), F.lit(0)), F.lit(n - 1)).cast("int")
        near = F.array(*(F.struct((cell(F.col("u"), "u", across["u"]) + i).alias("i"), (cell(F.col("v"), "v", across["v"]) + j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
        c = centres.select("u", "v", "a", "b", F.explode(near).alias("t")).select("u", "v", "a", "b", "t.i", "t.j")
        t = left.withColumns({"_i": cell(F.col(at[0]), "u", across["u"]), "_j": cell(F.col(at[1]), "v", across["v"])})
        last = max(across.values()) == 1
        if not last:
            held = c.groupBy("i", "j").applyInPandas(lambda g: g[["i", "j"]].head(int(_spans_a_plane(g[["u", "v"]].to_numpy(float)))), "i int, j int").persist()
            on = (F.col("_i") == F.col("i")) & (F.col("_j") == F.col("j"))
            left = t.join(small(held), on, "left_anti").drop("_i", "_j")
            last = left.isEmpty()
            t = t if last else t.join(small(held), on, "left_semi")
        parts.append(c.groupBy("i", "j").cogroup(t.groupBy("_i", "_j")).applyInPandas(run, f"{schema}, {names[0]} double, {names[1]} double"))
        if last:
            return reduce(DataFrame.unionByName, parts)
        across = {k: -(-n // 2) for k, n in across.items()}


def warp(pixels: DataFrame, points: DataFrame, n_x: int, n_y: int, method: str = "bilinear") -> DataFrame:
    """(x, y, spectrum): ``pixels`` (y, x, spectrum) on a regular map grid of ``n_x`` by ``n_y`` cells over the extent of control points (row, col, x, y).

    Splines through the points lead from the map to the image. ``method`` is ``nearest`` or ``bilinear``; cells outside the image, and bilinear
    bands with a missing neighbour, are NULL. Pixel labels are half-integers at centres, as rows and columns of points count from a corner.
    """
    if method not in ("nearest", "bilinear"):
        raise ValueError(f"unknown resampling: {method!r}")
    spark = pixels.sparkSession
    e = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    at = lambda n, k, low, high: F.lit(low) + (n + F.lit(0.5)) * F.lit((high - low) / k)
    ids = spark.range(n_x * n_y)
    grid = ids.select(at(F.col("id") % n_x, n_x, e.x0, e.x1).alias("x"), at(F.floor(F.col("id") / n_x), n_y, e.y0, e.y1).alias("y"))
    centres = points.select(F.col("x").alias("u"), F.col("y").alias("v"), F.col("col").alias("a"), F.col("row").alias("b"))
    t = spline_at(centres, grid, ("x", "y"), ("_col", "_row"))
    source = pixels.select(F.col("x").alias("_sx"), F.col("y").alias("_sy"), "spectrum")
    if method == "nearest":
        t = t.withColumns({"_sx": F.floor("_col") + 0.5, "_sy": F.floor("_row") + 0.5})
        return t.join(source, ["_sx", "_sy"], "left").select("x", "y", "spectrum")
    fx, fy = F.col("_col") - 0.5 - F.floor(F.col("_col") - 0.5), F.col("_row") - 0.5 - F.floor(F.col("_row") - 0.5)
    near = F.array(*(F.struct((F.floor(F.col("_col") - 0.5) + 0.5 + i).alias("sx"), (F.floor(F.col("_row") - 0.5) + 0.5 + j).alias("sy"), ((fx if i else 1 - fx) * (fy if j else 1 - fy)).alias("w")) for i in (0, 1) for j in (0, 1)))
    four = t.select("x", "y", F.explode(F.filter(near, lambda p: p["w"] > 0)).alias("p")).select("x", "y", F.col("p.sx").alias("_sx"), F.col("p.sy").alias("_sy"), "p.w")
    met = four.join(source, ["_sx", "_sy"], "left").groupBy("x", "y").agg(F.collect_list(F.struct("w", "spectrum")).alias("m"), F.count_if(F.col("spectrum").isNull()).alias("gaps"))
    scaled = F.transform("m", lambda p: F.transform(p["spectrum"], lambda v: v * p["w"]))
    total = F.aggregate(F.slice(scaled, 2, 3), F.get(scaled, 0), lambda s, p: F.zip_with(s, p, lambda a, b: a + b))
    return met.select("x", "y", F.when(F.col("gaps") == 0, total).alias("spectrum"))


def regular_grid(located: DataFrame, n_lon: int, n_lat: int, value: str = "value") -> DataFrame:
    """(lon, lat, value) on a regular grid over the extent of ``located`` (lon, lat, value): the mean of the points of each cell.

    Cells without a point are absent. Points find their cell by arithmetic, so the only shuffle is of partial sums.
    """
    e = located.agg(F.min("lon").alias("lon0"), F.max("lon").alias("lon1"), F.min("lat").alias("lat0"), F.max("lat").alias("lat1"))
    p = located.crossJoin(F.broadcast(e))  # one row
    cell = lambda c, n: F.least(F.floor((F.col(c) - F.col(f"{c}0")) / F.nullif(F.col(f"{c}1") - F.col(f"{c}0"), F.lit(0.0)) * n), F.lit(n - 1))
    back = lambda c, n: F.col(f"{c}0") + (F.col(f"_{c}") + 0.5) * (F.col(f"{c}1") - F.col(f"{c}0")) / n
    p = p.withColumns({"_lon": F.coalesce(cell("lon", n_lon), F.lit(0)), "_lat": F.coalesce(cell("lat", n_lat), F.lit(0))})
    g = p.groupBy("_lon", "_lat", "lon0", "lon1", "lat0", "lat1").agg(F.avg(value).alias(value))
    return g.select(back("lon", n_lon).alias("lon"), back("lat", n_lat).alias("lat"), value)
