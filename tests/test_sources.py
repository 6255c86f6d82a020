"""Readers, writers and products over files made here."""

import hashlib
import zipfile

import numpy as np
import pytest

from pushbroom.operators import cube as C
from pushbroom.plans.products import L0, L1
from pushbroom.sources import integrity, qub, tables

ID = "20210622T1256344234"


def write_qub(path, cube, wl=()):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(cube.astype("<f4").tobytes())
    b, y, x = cube.shape
    path.with_suffix(".hdr").write_text(f"ENVI\nsamples = {x}\nlines = {y}\nbands = {b}\nheader offset = 0\ndata type = 4\ninterleave = bsq\nbyte order = 0\n")


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    """A small product: 12 bands, 5 lines, 4 samples, at both levels."""
    root = tmp_path_factory.mktemp("archive")
    data = np.random.default_rng(0).uniform(1, 2, (12, 5, 4))
    for level, code in (("raw", "nri"), ("calibrated", "nci")):
        at = root / "data" / level / "20210622" / f"sat_img_{code}_{ID}_d_img_d32.qub"
        write_qub(at, data)
        md5 = hashlib.md5(at.read_bytes()).hexdigest()
        axes = "".join(f"<Axis_Array><elements>{n}</elements></Axis_Array>" for n in data.shape)
        at.with_suffix(".xml").write_text(
            f'<P xmlns:isda="urn:i"><start_date_time>2021-06-22T12:56:34Z</start_date_time><stop_date_time>2021-06-22T12:57:00Z</stop_date_time><md5_checksum>{md5}</md5_checksum>'
            f"<isda:exposure>E2</isda:exposure><isda:gain>G2</isda:gain><isda:orbit_limb_direction>Descending</isda:orbit_limb_direction><isda:line_exposure_duration>1000</isda:line_exposure_duration>{axes}</P>"
        )
    spm = root / "miscellaneous/calibrated/20210622" / f"sat_img_nci_{ID}_d_oth.spm"
    spm.parent.mkdir(parents=True)
    spm.write_text("".join(f"SPM {i} 1422021 06 22 12 56 {30 + 10 * i} 0 1 2 3 4 5 6 7 8 {100 + i} {-60 + i}\n" for i in range(3)))
    geo = root / "geometry/calibrated/20210622" / f"sat_img_nci_{ID}_g_grd.csv"
    geo.parent.mkdir(parents=True)
    geo.write_text("Longitude,Latitude,Pixel,Scan\n" + "".join(f"{190 + p},{s},{p},{s}\n" for p in (0, 3) for s in (0, 4)))
    calib = root / "calib"
    calib.mkdir()
    (calib / "cal_e2g2_lut_coeff.csv").write_text("".join(f"{1 + i % 250 / 1000},{0.5}\n" for i in range(12 * 250)))
    (calib / "cal_e2g2_saturations_radiance.csv").write_text("".join(f"{i},1,{1e5 if i != 9 else -9999}\n" for i in range(12)))
    (calib / "flux.txt").write_text("".join(f"{800.1234 + 17 * i}\t{50 + i}\n" for i in range(12)))
    return root, data


def test_qub_reads_ranges(spark, archive):
    root, data = archive
    path = str(next(root.glob("data/raw/**/*.qub")))
    c = qub.read_qub(spark, path, 2)
    assert c.rdd.getNumPartitions() == 3
    got = C.crop(c, (1.0, 3.0), (2.5, None), (3, 4))
    part = qub.read_qub(spark, path, 2, x=(1.0, 3.0), y=(2.5, None), bands=(3, 4))
    assert part.rdd.getNumPartitions() == 2 and sorted(map(tuple, part.collect())) == sorted(map(tuple, got.collect()))
    # what one query of a table leaves out, another still has
    assert c.where("band = 1").unionByName(c.where("band = 2")).count() == 40 and c.count() == data.size
    assert sorted((r.band, r.y, r.x) for r in got.collect()) == [(b, y + 0.5, x + 0.5) for b in (3, 4) for y in (2, 3, 4) for x in (1, 2)]
    r = got.first()
    assert r.value == pytest.approx(data[r.band - 1, int(r.y), int(r.x)], rel=1e-6) and r.product_id == ID


def test_spectra_are_the_long_form_by_pixel(spark, archive):
    root, data = archive
    path = str(next(root.glob("data/raw/**/*.qub")))
    p = qub.read_qub(spark, path, 2, "spectral")
    assert p.rdd.getNumPartitions() == 3
    got = {(r.y, r.x): r.spectrum for r in C.crop(p, (1.0, 3.0), (2.5, None)).collect()}
    assert sorted(got) == [(y + 0.5, x + 0.5) for y in (2, 3, 4) for x in (1, 2)]
    assert all(np.allclose(v, data[:, int(y), int(x)]) for (y, x), v in got.items())
    long = C.to_spectral(qub.read_qub(spark, path), 12).select("y", "x", "spectrum")
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, p.select("y", "x", "spectrum").collect()))


def test_missing_values_are_null_in_both_forms(spark, tmp_path):
    data = np.arange(12.0).reshape(3, 2, 2)
    data[1, 0, 1] = np.nan
    write_qub(tmp_path / "a.qub", data)
    assert [r.value for r in qub.read_qub(spark, str(tmp_path / "a.qub")).where("band = 2 and y = 0.5 and x = 1.5").collect()] == [None]
    assert qub.read_qub(spark, str(tmp_path / "a.qub"), form="spectral").where("y = 0.5 and x = 1.5").first().spectrum == [1.0, None, 9.0]


def test_calibration_of_a_file_shuffles_no_pixels(spark, archive):
    root, _ = archive
    plan = L0(spark, ID, str(root)).calibrate_to_rad(calib_dir=str(root / "calib"))._jdf.queryExecution().executedPlan().toString()
    # gains are gathered by sample and broadcast; nothing is dealt by pixel
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(") == 1
    plan = L1(spark, ID, str(root)).calibrate_to_refl(str(root / "calib/flux.txt"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(y" not in plan and "hashpartitioning(product_id" not in plan


def test_raster_suffixes_are_refused(spark, archive, tmp_path):
    root, _ = archive
    c = qub.read_qub(spark, str(next(root.glob("data/raw/**/*.qub"))))
    with pytest.raises(ValueError, match="(?i)tif"):
        qub.write_output(c, str(tmp_path / "x.TIF"))
    assert not (tmp_path / "x.TIF").exists()


def test_l0_to_radiance(spark, archive):
    root, data = archive
    p = L0(spark, f"x_{ID}", str(root))
    assert p.metadata["exp_gain"] == "e2g2" and p.metaget("isda:gain") == "G2"
    p.checksum()
    rad = C.to_long(p.calibrate_to_rad(calib_dir=str(root / "calib"))).where("band = 8").collect()
    assert all(r.value == pytest.approx(10 * data[7, int(r.y), int(r.x)] * (1 + int(r.x) / 1000) + 0.5, rel=1e-6) for r in rad) and len(rad) == 20
    assert [r.value for r in C.to_long(p.calibrate_to_rad(calib_dir=str(root / "calib"), interp_bands=None)).where("band = 10").select("value").distinct().collect()] == [None]
    with pytest.raises(FileNotFoundError):
        p.calibrate_to_rad(calib_dir=str(root))
    assert p.calibrate_to_l1(calib_dir=str(root / "calib")).cube.where("band = 8").count() == 20


def test_l1_to_reflectance(spark, archive):
    root, data = archive
    p = L1(spark, ID, str(root), latlon_extent=(-170, -167, None, None))
    assert p.extent == (0.5, 3.5, 0.5, 4.5) and p.control_points(True).count() == 4
    lines = {r.y: r for r in p.line_geometry().collect()}
    assert lines[0.5].inc == pytest.approx(90 - 59.6) and lines[0.5].iaz == pytest.approx(100.4 - 180)
    r = C.to_long(p.calibrate_to_refl(str(root / "calib/flux.txt"))).where("band = 5").first()
    flux = 54 * 10 / (np.pi * 1.0184**2)
    assert r.value == pytest.approx(0.01 * data[4, int(r.y), int(r.x)] / (np.cos(np.radians(lines[r.y].inc)) * flux), rel=1e-6)
    assert p.preview(3).count() == 20
    got = p.located().where("x = 2.5 and y = 1.5").first()
    assert (got.lon, got.lat) == (pytest.approx(-168.0), pytest.approx(1.0))
    with pytest.raises(ValueError):
        L1(spark, ID, str(root), extent=(0, 1, None, None), latlon_extent=(0, 1, None, None))
    with pytest.raises(ValueError):
        p.calibrate_to_refl(str(root / "calib/flux.txt"), thermal_corr="other")


def test_catalogue(spark, archive):
    root, _ = archive
    files = tables.catalogue(tables.list_files(spark, str(root)), level=1)
    assert sorted((r.ext, r.basename) for r in files.collect()) == [(e, ID) for e in ("csv", "hdr", "qub", "spm", "xml")]
    assert tables.catalogue(tables.list_files(spark, str(root)), 1, ("qub",), ["other"]).count() == 0
    assert tables.catalogue_maps(files).count() == 5
    with pytest.raises(ValueError):
        tables.catalogue(files, 1, ("doc",))


def test_writers_round_trip(spark, archive, tmp_path):
    root, data = archive
    c = qub.read_qub(spark, str(next(root.glob("data/raw/**/*.qub"))))
    qub.write_output(c, str(tmp_path / f"{ID}.img"), wl=[800.0 + i for i in range(12)])
    back = np.fromfile(tmp_path / f"{ID}.img", "<f4").reshape(data.shape)
    assert np.allclose(back, data) and "800.00" in (tmp_path / f"{ID}.hdr").read_text()
    qub.write_output(c, str(tmp_path / "cube"), wl=[800.0])
    kept = spark.read.parquet(str(tmp_path / "cube"))
    assert kept.count() == data.size and kept.schema["value"].metadata["crs"] == "IAU_2015:30135"


def test_checksums_and_archives(spark, archive, tmp_path):
    (tmp_path / f"sat_nci_{ID}").mkdir()
    with zipfile.ZipFile(tmp_path / f"sat_img_nci_{ID}.zip", "w") as z:
        z.writestr("data/a.txt", "a")
    assert [p.endswith("data/a.txt") for p in integrity.unpack(str(tmp_path), ID)] == [True]
    with pytest.raises(FileNotFoundError):
        integrity.unpack(str(tmp_path), "none")
    for said, fails in (("0" * 32, True), (hashlib.md5(b"image").hexdigest(), False)):
        with zipfile.ZipFile(tmp_path / f"sat_img_nri_{ID}.zip", "w") as z:
            z.writestr("i.qub", "image")
            z.writestr("i.xml", f"<a><md5_checksum>{said}</md5_checksum></a>")
        if fails:
            with pytest.raises(integrity.ChecksumError, match="label says 0000"):
                integrity.unpack(str(tmp_path), ID, 0)
            assert len(integrity.unpack(str(tmp_path), ID, 0, check=False)) == 2
        else:
            assert len(integrity.unpack(str(tmp_path), ID, 0)) == 2
    f = spark.createDataFrame([("a", "AB"), ("b", "cd")], "path string, md5 string")
    said = spark.createDataFrame([("a", "ab"), ("b", "xx")], "path string, md5_checksum string")
    with pytest.raises(integrity.ChecksumError, match="^b"):
        integrity.require(integrity.verify(f, said))


def test_points_and_small_tables(spark, tmp_path):
    (tmp_path / "a.points").write_text("#CRS: SOME WKT\nmapX,mapY,sourceX,sourceY,enable\n1.5,2.5,3,4,1\n")
    pts, crs = tables.read_control_points(spark, str(tmp_path / "a.points"))
    assert crs == "SOME WKT" and tuple(pts.first()) == (4.0, 3.0, 1.5, 2.5)
    (tmp_path / "v.csv").write_text("band,e1g2\n1,1\n2,0\n")
    from pushbroom.operators.detector import bad_bands

    assert [r.bad for r in bad_bands(tables.read_validity(spark, str(tmp_path / "v.csv")), "e1g2").orderBy("band").collect()] == [False, True]
    (tmp_path / "p.csv").write_text("band,polish\n8,1.5\n")
    assert tables.read_polish(spark, str(tmp_path / "p.csv")).first().polish == 1.5
