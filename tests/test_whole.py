"""Queries take whole tables: each against its SQL where ids reach beyond the first few."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from pushbroom.operators import geometry
from pushbroom.plans import proxies as P
from pushbroom.plans import queries as Q

DATA = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def agree(spark, name):
    """The query's rows, which are those of its SQL."""
    db = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    want = db.sql(Q.ORACLE_SQL[name]).df()
    got = Q.QUERIES[name](spark, DATA).toPandas()[list(want.columns)]
    order = list(want.columns)
    a, b = (d.sort_values(order).reset_index(drop=True) for d in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False, atol=2e-6)
    return got


def count(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet").count()


@tables
def test_splines_reach_every_pixel(spark):
    assert len(agree(spark, "tps_grid")) == count(spark, "embeddings") > 60


def test_splines_between_centres_are_those_of_brute_force(spark):
    rng = np.random.default_rng(5)
    x, y = rng.uniform(0, 250, 30), rng.uniform(0, 900, 30)
    lon, lat = np.sin(x / 40) + y / 300, x * y / 1e4
    at = np.column_stack([rng.uniform(0, 250, 50), rng.uniform(0, 900, 50)])
    c = spark.createDataFrame([tuple(map(float, r)) for r in zip(x, y, lon, lat)], "Pixel double, Scan double, Longitude double, Latitude double")
    t = spark.createDataFrame([tuple(map(float, r)) for r in at], "x double, y double")
    got = {(r.x, r.y): (r.lon, r.lat) for r in geometry.spline_grid(c, t).collect()}
    scale = lambda p: np.column_stack([2 * (p[:, k] - v.min()) / np.ptp(v) - 1 for k, v in enumerate((x, y))])
    q, u = scale(np.column_stack([x, y])), scale(at)
    bend = lambda a, b: 0.0 if (r := np.hypot(*(a - b))) == 0 else r * r * np.log(r)
    a = np.zeros((33, 33))
    for i in range(30):
        for j in range(30):
            a[i, j] = bend(q[i], q[j])
        a[i, 30:] = a[30:, i] = 1, *q[i]
    sol = np.linalg.solve(a, np.vstack([np.column_stack([lon, lat]), np.zeros((3, 2))]))
    for p, v in zip(at, u):
        want = np.array([*(bend(v, c) for c in q), 1, *v]) @ sol
        assert np.allclose(got[tuple(p)], want, atol=1e-8)


@tables
@pytest.mark.parametrize("name", ["sun_incidence", "reflectance"])
def test_all_events_are_knots(spark, name):
    assert P.knots(spark, DATA).count() == count(spark, "events")
    got = agree(spark, name)
    assert len(got) == count(spark, "embeddings") * (64 if name == "reflectance" else 1) / (1 if name == "reflectance" else 25)


@tables
def test_bad_bands_of_all_parts(spark):
    got = agree(spark, "bad_band_buffer")
    assert len(got) == count(spark, "part") > 256 and got.block.nunique() == 8


@tables
def test_luts_of_all_parts(spark):
    got = agree(spark, "lut_denoise")
    assert len(got) == count(spark, "part") > 1600 and set(got.lut) == {0, 1}


@tables
def test_regrid_covers_the_whole_grid(spark):
    got = agree(spark, "dem_regrid")
    dem = P.dem(spark, DATA).toPandas()
    assert got.y.max() > dem.y.max() - 1.5 and got.x.max() > dem.x.max() - 1
