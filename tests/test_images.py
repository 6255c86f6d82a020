"""The entry points from files to files, against the closed formulas."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pushbroom.operators import cube as C
from pushbroom.operators import geometry
from pushbroom.plans import images
from pushbroom.sources import integrity, qub, tables

ID = "20210622T1256344234"


@pytest.fixture(scope="module", params=["Ascending", "Descending"])
def product(request, tmp_path_factory):
    """A calibrated image of 12 bands, 8 lines and 6 samples with all that goes with it."""
    root = tmp_path_factory.mktemp("image")
    data = np.random.default_rng(0).uniform(80, 200, (12, 8, 6)).astype("<f4")
    image = root / f"x_nci_{ID}_d_img.qub"
    image.write_bytes(data.tobytes())
    image.with_suffix(".hdr").write_text("ENVI\nsamples = 6\nlines = 8\nbands = 12\nheader offset = 0\ndata type = 4\ninterleave = bsq\nbyte order = 0\n")
    axes = "".join(f"<Axis_Array><elements>{n}</elements></Axis_Array>" for n in data.shape)
    label = '<P xmlns:isda="urn:i"><start_date_time>2021-06-22T12:56:34Z</start_date_time><stop_date_time>2021-06-22T12:57:00Z</stop_date_time><md5_checksum>{}</md5_checksum>'
    label += f"<isda:exposure>E2</isda:exposure><isda:gain>G2</isda:gain><isda:orbit_limb_direction>{request.param}</isda:orbit_limb_direction><isda:line_exposure_duration>1000</isda:line_exposure_duration>{axes}</P>"
    image.with_suffix(".xml").write_text(label.format(hashlib.md5(image.read_bytes()).hexdigest()))
    spm = root / f"x_{ID}.spm"
    spm.write_text("".join(f"SPM {i} 1422021 06 22 12 56 {30 + 10 * i} 0 1 2 3 4 5 6 7 8 {100 + i} {-60 + i}\n" for i in range(3)))
    spm.with_suffix(".xml").write_text(label.format("0" * 32))
    grid = root / f"x_{ID}_grd.csv"
    grid.write_text("Longitude,Latitude,Pixel,Scan\n" + "".join(f"{10 + 0.1 * p},{20 + 0.2 * s},{p},{s}\n" for p in (0, 2, 5) for s in (0, 3, 7)))
    (root / "flux.txt").write_text("".join(f"{800.1234 + 17 * i}\t{50 + i}\n" for i in range(12)))
    (root / "valid.csv").write_text("band,e1g2,e2g2\n" + "".join(f"{b},1,{int(b != 4)}\n" for b in range(1, 13)))
    (root / "polish.csv").write_text("band,polish\n" + "".join(f"{b},{1 + b / 100}\n" for b in range(8, 13)))
    return root, str(image), str(spm), str(grid), data, request.param == "Descending"


def expected(data, descending, cos=None):
    """I/F by line of the file, without thermal removal."""
    t = np.arange(8.0) + 4
    inc, flux = 90 - np.abs(-60 + t / 10), (50 + np.arange(12)) * 10 / (np.pi * 1.0184**2)
    c = np.cos(np.radians(inc))[None, :, None] if cos is None else cos
    return 0.01 * data / (c * flux[:, None, None]), 100 + t / 10 - (180 if descending else 0), inc


def test_image_to_reflectance(spark, product, tmp_path):
    root, image, spm, grid, data, descending = product
    want, iaz, inc = expected(data.astype(float), descending)
    options = dict(flux=str(root / "flux.txt"), thermal="", validity=str(root / "valid.csv"), polish=str(root / "polish.csv"))
    out = images.reflectance(spark, image, spm, geometry_grid=grid, out=str(tmp_path / f"{ID}.img"), **options)
    rows = out.collect()
    assert len(rows) == 7 * 5  # centres of the last line and sample lie beyond the last geometry point
    for r in rows:
        line = int(0.5 - r.y if descending else r.y - 0.5)
        col = want[:, line, int(r.x)].copy()
        col[7:] /= 1 + np.arange(8, 13) / 100
        assert r.spectrum[3] is None and r.iaz == pytest.approx(iaz[line]) and r.inc == pytest.approx(inc[line])
        assert [v for b, v in enumerate(r.spectrum) if b != 3] == pytest.approx(list(np.delete(col, 3)), rel=1e-5)
        assert (r.lon, r.lat) == (pytest.approx(10 + 0.1 * r.x), pytest.approx(20 + 0.2 * line))
    back = np.fromfile(tmp_path / f"{ID}.img", "<f4").reshape(12, -1, 5)
    assert back.shape[1] == 7 and np.isnan(back[3]).all()


def test_lines_of_a_crop_are_known_by_place_or_by_range(spark, product):
    root, image, spm, _, data, descending = product
    want, _, _ = expected(data.astype(float), descending)
    get = lambda **kw: images.reflectance(spark, image, spm, str(root / "flux.txt"), thermal="", extent=(None, None, 2, 5), **kw)
    by_place = {(r.y, r.x): r.spectrum for r in get().collect()}
    assert by_place == {(r.y, r.x): r.spectrum for r in get(yrange=(2, 5)).collect()}
    assert by_place[(0.0 if descending else 2.5, 1.5)] == pytest.approx(list(want[:, 2, 1]), rel=1e-5)
    with pytest.raises(ValueError, match="yrange"):
        get(yrange=(0, 8))


def test_destriping_and_smoothing_are_steps_of_the_chain(spark, product):
    root, image, spm, _, data, _ = product
    plain, smooth = (images.reflectance(spark, image, spm, str(root / "flux.txt"), thermal="", destripe=True, vthresh=0.5, **kw).collect() for kw in ({}, {"smoothing": "boxcar", "window": 3}))
    assert len(plain) == len(smooth) == 48 and {"inc", "iaz"} <= set(plain[0].asDict())
    from pushbroom.operators.fourier import filter_mask, filtered

    b5 = filtered(0.01 * data[4].astype(float), filter_mask(8, 6, 0.5))
    got = sorted(abs(r.spectrum[4] * np.cos(np.radians(r.inc)) * 54 * 10 / (np.pi * 1.0184**2)) for r in plain)
    assert got == pytest.approx(sorted(b5.ravel()), rel=1e-5)


def test_slopes_and_checksums(spark, product, tmp_path):
    root, image, spm, grid, _, descending = product
    with pytest.raises(integrity.ChecksumError, match="spm"):
        images.reflectance(spark, image, spm, str(root / "flux.txt"), checksums=True)
    with pytest.raises(ValueError, match="latitudes"):
        images.reflectance(spark, image, spm, str(root / "flux.txt"), dem="x.csv")
    ys = [-k - 1.0 for k in range(-2, 9)] if descending else [float(k) for k in range(-1, 10)]
    (tmp_path / "dem.csv").write_text("y,x,z\n" + "".join(f"{y},{x},5\n" for y in ys for x in range(-1, 8)))
    flat = {(r.y, r.x): r for r in images.reflectance(spark, image, spm, str(root / "flux.txt"), geometry_grid=grid, dem=str(tmp_path / "dem.csv"), thermal="").collect()}
    assert len(flat) == 35
    for r in flat.values():
        inc, iaz, lat = (np.radians(v) for v in (r.inc, r.iaz, r.lat))
        assert r.cos_inc == pytest.approx(np.sin(inc) * np.cos(iaz) * np.sin(lat) + np.cos(inc) * np.cos(lat))


def test_control_points_travel_with_the_image(spark, product, tmp_path):
    _, image, _, grid, data, _ = product
    pixels, points = images.with_control_points(spark, image, grid, str(tmp_path / "c.img"), extent=(10.15, 10.6, None, 20.7), corners_only=True)
    assert {(r.y, r.x) for r in pixels.select("y", "x").collect()} == {(y + 0.5, x + 0.5) for y in range(4) for x in range(1, 6)}
    back, crs = tables.read_control_points(spark, str(tmp_path / "c.points"))
    assert crs == images.MAP_CRS and sorted(map(tuple, back.collect())) == sorted(map(tuple, points.collect())) and back.count() == 4
    with pytest.raises(ValueError, match="no geometry"):
        images.with_control_points(spark, image, grid, extent=(50, 60, None, None))


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_warping_follows_the_control_points(spark, product, tmp_path, method):
    _, image, _, _, data, _ = product
    # the map is the image turned on its side and stretched
    (tmp_path / "w.points").write_text("#CRS: X\nmapX,mapY,sourceX,sourceY\n" + "".join(f"{2 * y},{3 * x},{x},{y}\n" for x in (0, 3, 6) for y in (0, 4, 8)))
    got = {(r.x, r.y): r.spectrum for r in images.warped(spark, image, str(tmp_path / "w.points"), shape=(16, 12), method=method).collect()}
    assert len(got) == 16 * 12
    for (mx, my), spectrum in got.items():
        col, row = my / 3, mx / 2
        if method == "nearest":
            assert spectrum == pytest.approx(list(data[:, int(row), int(col)]), rel=1e-6)
        else:
            c, r = col - 0.5, row - 0.5
            inside = 0 <= r <= 7 and 0 <= c <= 5
            assert (spectrum is not None) == inside
            if inside:
                r0, c0, r1, c1 = int(r), int(c), min(int(r) + 1, 7), min(int(c) + 1, 5)
                fr, fc = r - r0, c - c0
                want = (1 - fr) * ((1 - fc) * data[:, r0, c0] + fc * data[:, r0, c1]) + fr * ((1 - fc) * data[:, r1, c0] + fc * data[:, r1, c1])
                assert spectrum == pytest.approx(list(want), rel=1e-5)
    with pytest.raises(ValueError, match="resampling"):
        images.warped(spark, image, str(tmp_path / "w.points"), method="cubic")


def test_a_swath_on_a_regular_grid(spark, product, tmp_path):
    _, image, _, grid, data, _ = product
    got = images.gridded(spark, image, grid, str(tmp_path / "g.img"), shape=(5, 7), method="nearest").collect()
    assert len(got) == 35 and all(r.product_id == ID for r in got)
    for r in got:
        col, row = (r.lon - 10) / 0.1, (r.lat - 20) / 0.2
        assert r.spectrum == pytest.approx(list(data[:, int(row), int(col)]), rel=1e-6)
    assert (tmp_path / "g.hdr").exists()


def test_large_grids_are_splined_by_tiles(spark, monkeypatch):
    f = lambda u, v: (np.sin(u / 30) + v / 50, np.cos(v / 40) * u / 60)
    centres = spark.createDataFrame([(float(u), float(v), *map(float, f(u, v))) for u in range(0, 100, 4) for v in range(0, 100, 4)], "u double, v double, a double, b double")
    targets = spark.createDataFrame([(float(x), float(y), "k") for x in range(3, 97, 9) for y in (0.0, 33.5, 96.0)], "x double, y double, note string")
    whole = {(r.x, r.y): (r.lon, r.lat) for r in geometry.spline_at(centres, targets, ("x", "y"), ("lon", "lat")).collect()}
    monkeypatch.setattr(geometry, "MANY_CENTRES", 100)
    tiled = {(r.x, r.y): (r.lon, r.lat) for r in geometry.spline_at(centres, targets, ("x", "y"), ("lon", "lat")).collect()}
    assert len(tiled) == len(whole) == 33
    for k, v in tiled.items():
        assert v == pytest.approx(whole[k], abs=2e-3) and v == pytest.approx(f(*k), abs=2e-3)


def test_readers_refuse_rasters(spark, tmp_path):
    with pytest.raises(ValueError, match="tif"):
        images.read_pixels(spark, "a.tif")
    with pytest.raises(ValueError, match="tif"):
        images.read_dem(spark, "a.tiff")
    cube = spark.createDataFrame([("p", b, 0.5, x + 0.5, float(b * x)) for b in (1, 2) for x in (0, 1)], "product_id string, band int, y double, x double, value double")
    qub.write_output(cube, str(tmp_path / "c"))
    assert {r.x: r.spectrum for r in images.read_pixels(spark, str(tmp_path / "c")).collect()} == {0.5: [0.0, 0.0], 1.5: [1.0, 2.0]}
    assert C.to_long(images.read_pixels(spark, str(tmp_path / "c"))).where(F.col("band") == 2).count() == 2
