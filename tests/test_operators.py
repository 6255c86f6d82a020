"""Small cases worked out by hand, and properties that hold whatever the data."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pushbroom.functions import fixed as K
from pushbroom.functions import names as N
from pushbroom.functions import radiometry as R
from pushbroom.operators import cube as C
from pushbroom.operators import detector, fourier, geometry, sun, terrain
from pushbroom.operators import spectra as S


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def spectrum(values):
    return F.array(*(F.lit(v).cast("double") for v in values))


@pytest.mark.parametrize("missing, filled", [(10, True), (11, False)])
def test_a_hole_is_filled_up_to_a_gap_of_eleven(spark, missing, filled):
    got = one(spark, S.interpolate(spectrum([1.0] + [None] * missing + [12.0]), 11))
    assert all(v is not None for v in got) == filled
    if filled:
        assert got[1] == 2.0


def test_interpolation_leaves_ends_and_empty_spectra(spark):
    assert one(spark, S.interpolate(spectrum([None, 1.0, None, 3.0, None]))) == [None, 1.0, 2.0, 3.0, None]
    assert one(spark, S.interpolate(F.array().cast("array<double>"))) == []
    assert one(spark, S.interpolate(spectrum([None, None]), None)) == [None, None]


def test_smoothing_keeps_a_constant_and_masks(spark):
    flat = spectrum([2.0, 2.0, None, 2.0, 2.0])
    assert one(spark, S.boxcar(flat, 3)) == [2.0] * 5
    assert one(spark, S.boxcar(flat, 3, 3)) == [None] * 5
    got = one(spark, S.gaussian(flat, 3))
    assert got[0] is None and got[2] is None and got[1] == pytest.approx(2.0)
    with pytest.raises(ValueError):
        S.gaussian_weights(4)


def test_planck_inverts(spark):
    wl = F.lit(4.6e-6)
    assert one(spark, R.brightness_temperature(K.EMISSIVITY * R.planck(F.lit(380.0), wl), wl)) == pytest.approx(380.0)
    wls = F.array(*(F.lit((4000 + 3 * b) * 1e-9) for b in range(1, 257)))
    body = F.transform(wls, lambda w: K.EMISSIVITY * R.planck(F.lit(350.0), w))
    assert one(spark, S.mean_temperature(body, wls)) == pytest.approx(350.0)


def test_division_by_zero_and_bad_input_are_null(spark):
    assert one(spark, R.reflectance(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(2.0))) is None
    assert one(spark, R.brightness_temperature(F.lit(0.0), F.lit(1e-6))) is None
    assert one(spark, R.clip_at_zero(F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("lon, want", [(181.0, -179.0), (180.0, -180.0), (-180.5, 179.5)])
def test_longitudes_wrap(spark, lon, want):
    assert one(spark, R.wrap_longitude(F.lit(lon))) == want


def test_names(spark):
    name = F.lit("sat_img_nci_20210622T1256344234_g_grd_d32.csv")
    assert one(spark, N.basename(name)) == one(spark, N.stem_token(name)) == "20210622T1256344234"
    assert one(spark, N.basename(F.lit("none"))) is None
    with pytest.raises(Exception, match="no observation id"):
        one(spark, N.basename(F.lit("none"), strict=True))
    assert one(spark, N.solar_distance(name)) == 1.0184
    assert one(spark, N.crs_text(F.lit("#CRS: SOMETHING"))) == "SOMETHING"
    assert one(spark, N.projection_key(F.lit("Polar Stereographic"), F.lit("South Pole"))) in K.PROJECTIONS


def cube_of(spark, images):
    rows = [("p", b + 1, float(y), x + 0.5, float(v)) for b, im in enumerate(images) for y, row in enumerate(im) for x, v in enumerate(row)]
    return spark.createDataFrame(rows, "product_id string, band int, y double, x double, value double")


def image_of(rows, shape):
    out = np.empty(shape)
    for r in rows.collect():
        out[int(r.y), int(r.x)] = np.nan if r.value is None else r.value
    return out


def test_crop_and_lines(spark):
    c = spark.range(10).select((F.col("id") + 0.5).alias("x"), F.lit(0.0).alias("y"), F.col("id").alias("line"))
    assert sorted(r.x for r in C.crop(c, x=(5, 8)).collect()) == [5.5, 6.5, 7.5]
    assert sorted(r.line for r in C.lines(c, 2, 5).collect()) == [2, 3, 4]


def test_forms_of_a_cube_round_trip(spark):
    c = cube_of(spark, np.random.default_rng(0).normal(size=(3, 2, 2)))
    back = C.to_long(C.to_spectral(c, 3)).select(c.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, c.collect()))


def test_a_stripe_beyond_its_neighbours_is_flagged_and_edges_never_are(spark):
    im = np.tile([5.0, 1.0, 9.0, 1.0, 0.0], (4, 1))
    got = {r.x: r.is_stripe for r in detector.stripes(cube_of(spark, [im])).collect()}
    assert got == {0.5: False, 1.5: True, 2.5: True, 3.5: False, 4.5: False}


def test_bad_bands_spread(spark):
    flags = spark.createDataFrame([("e", i, bool(b)) for i, b in enumerate([0, 1, 0, 0, 0, 1, 0])], "exp_gain string, band int, bad boolean")
    assert [r.bad for r in detector.buffered(flags, 1).orderBy("band").collect()] == [True, True, True, False, True, True, True]


def test_convolution_sign(spark):
    z = np.add.outer(3.0 * np.arange(4), 2.0 * np.arange(5))
    d = cube_of(spark, [z]).select("product_id", "y", "x", F.col("value").alias("z"))
    inner = terrain.gradient(d).where("x between 1 and 4 and y between 1 and 2").first()
    assert (inner.dz_dx, inner.dz_dy) == (-2.0, 3.0)


def test_time_series_extrapolate(spark):
    knots = spark.createDataFrame([(0.0, 0.0), (10.0, 10.0), (20.0, 40.0), (20.0, 40.0)], "timestamp double, v double")
    at = spark.createDataFrame([(-5.0,), (5.0,), (10.0,), (25.0,)], "t double")
    assert [r.v for r in sun.interpolate_at(at, knots, "t", ["v"]).orderBy("t").collect()] == [-5.0, 5.0, 10.0, 55.0]


def test_many_knots_take_the_bucketed_way(spark, monkeypatch):
    knots = spark.createDataFrame([(float(i * i), math.sin(i)) for i in range(30)], "timestamp double, v double")
    at = spark.createDataFrame([(k * 7.3 - 20,) for k in range(130)], "t double")
    plain = sorted(map(tuple, sun.interpolate_at(at, knots, "t", ["v"]).collect()))
    monkeypatch.setattr(sun, "MANY_KNOTS", 0)
    assert sorted(map(tuple, sun.interpolate_at(at, knots, "t", ["v"]).collect())) == plain


def test_splines_give_back_their_centres():
    rng = np.random.default_rng(1)
    x, y = rng.uniform(0, 250, 40), rng.uniform(0, 900, 40)
    values = np.column_stack([np.sin(x / 40) + y / 300, x * y / 1e5])
    w, poly, (shift, size) = geometry.spline_weights(x, y, values)
    q = (np.column_stack([x, y]) - shift) / size
    d2 = ((q[:, None] - q[None]) ** 2).sum(2)
    got = geometry._kernel(d2) @ w + np.column_stack([np.ones(40), q]) @ poly
    assert np.allclose(got, values, atol=1e-9)


def test_corners_of_an_extent(spark):
    g = spark.createDataFrame([(float(p), float(s), 10.0 + p, 20.0 + s) for p in (0, 5, 9) for s in (0, 4, 7)], "Pixel double, Scan double, Longitude double, Latitude double")
    assert {(r.col, r.row) for r in geometry.control_points(g, corners_only=True).collect()} == {(0, 0), (0, 7), (9, 0), (9, 7)}


def test_default_mask():
    m = fourier.filter_mask(40, 250)
    assert (m[20, :102] == 0).all() and (m[20, 149:] == 0).all() and m[20, 102:149].all() and m[0, 125] == 0
    assert m.sum() == 40 * 250 - (102 + 101) - 1


def test_open_mask_gives_the_image_back():
    im = np.random.default_rng(2).uniform(1, 2, (6, 7))
    assert np.allclose(fourier.filtered(im, np.ones(im.shape)), im)


@pytest.mark.parametrize("ny", [6, 7])
def test_closed_form_is_the_transform(spark, ny):
    im = np.random.default_rng(3).uniform(1, 2, (ny, 10))
    im[1, 1] = 0
    got = image_of(fourier.destripe(cube_of(spark, [im])), im.shape)
    assert np.allclose(got, fourier.filtered(im, fourier.filter_mask(*im.shape)))


def drawn_mask(height, width, vthresh, vtilt, hthresh, htilt):
    """The mask pixel by pixel with exact fractions: a pixel goes if a triangle covers it or an edge, rounded along its steeper axis, passes through it."""
    cy, cx = height // 2, width // 2
    a, b, c, d = int(cy * vtilt), int(cx * (1 - vthresh)), int(cx * htilt), int(cy * (1 - hthresh))
    triangles = [[(x, cy - a), (cx + s * b, cy), (x, cy + a)] for x, s in ((0, -1), (width, 1))]
    triangles += [[(cx - c, y), (cx, cy + s * d), (cx + c, y)] for y, s in ((0, -1), (height, 1))]
    half = Fraction(1, 2)

    def on_edge(x, y, p, q):
        (x0, y0), (x1, y1) = p, q
        if p == q:
            return (x, y) == p
        if abs(x1 - x0) >= abs(y1 - y0):
            return min(x0, x1) <= x <= max(x0, x1) and math.floor(y0 + Fraction((x - x0) * (y1 - y0), x1 - x0) + half) == y
        return min(y0, y1) <= y <= max(y0, y1) and math.floor(x0 + Fraction((y - y0) * (x1 - x0), y1 - y0) + half) == x

    def covers(t, x, y):
        turns = [(q[0] - p[0]) * (y - p[1]) - (q[1] - p[1]) * (x - p[0]) for p, q in zip(t, t[1:] + t[:1])]
        flat = (t[1][0] - t[0][0]) * (t[2][1] - t[0][1]) == (t[1][1] - t[0][1]) * (t[2][0] - t[0][0])
        return not flat and (all(v >= 0 for v in turns) or all(v <= 0 for v in turns))

    gone = lambda x, y: any(covers(t, x, y) or any(on_edge(x, y, p, q) for p, q in zip(t, t[1:] + t[:1])) for t in triangles)
    return np.array([[0.0 if gone(x, y) else 1.0 for x in range(width)] for y in range(height)])


def summed_filter(image, mask):
    """The filter by sums of waves, frequency by frequency."""
    ny, nx = image.shape
    u, v = np.arange(nx) - nx // 2, np.arange(ny) - ny // 2
    fx, fy = np.exp(-2j * np.pi * np.outer(u, np.arange(nx)) / nx), np.exp(-2j * np.pi * np.outer(v, np.arange(ny)) / ny)
    f = np.array([[sum(fy[k, i] * fx[m, j] * image[i, j] for i in range(ny) for j in range(nx)) for m in range(nx)] for k in range(ny)]) * mask
    back = np.array([[sum(np.conj(fy[k, i] * fx[m, j]) * f[k, m] for k in range(ny) for m in range(nx)) for j in range(nx)] for i in range(ny)]) / (nx * ny)
    return np.where(image != 0, np.abs(back), 0.0), f


@pytest.mark.parametrize("shape", [(6, 9), (7, 8), (12, 10)])
@pytest.mark.parametrize("thresholds", [(0.6, 0.3, 0.2, 0.2), (0.7, 0.2, 0.4, 0.1), (0.8, 0.9, 0.9, 0.5)])
def test_masks_are_drawn_triangles(shape, thresholds):
    assert (fourier.filter_mask(*shape, *thresholds) == drawn_mask(*shape, *thresholds)).all()


def test_tilted_masks_run_by_band(spark):
    rng = np.random.default_rng(4)
    images, thresholds = [rng.uniform(1, 2, (6, 9)) for _ in range(2)], (0.6, 0.3, 0.2, 0.2)
    out = fourier.destripe(cube_of(spark, images), *thresholds)
    for b, im in enumerate(images):
        want, f = summed_filter(im, drawn_mask(6, 9, *thresholds))
        assert np.allclose(image_of(out.where(F.col("band") == b + 1), im.shape), want)
    tuned = fourier.spectrum_at(cube_of(spark, images), 2, vthresh=0.6, vtilt=0.3, hthresh=0.2, htilt=0.2).collect()
    assert len(tuned) == 54
    for r in tuned:
        assert r.decibels == (None if abs(f[r.v, r.u]) == 0 else pytest.approx(20 * np.log(abs(f[r.v, r.u])), abs=1e-6))
