"""Grids of unusual shapes: few columns, clusters, lines that are not whole."""

import duckdb
import pandas as pd
import pytest

from pushbroom.operators import geometry, terrain
from pushbroom.plans import queries as Q


@pytest.mark.parametrize("places", [
    [(50.0 * (k % 6), 50.0 * (k // 6)) for k in range(600)],
    [(float(k % 12), float(k // 12)) for k in range(240)] + [(1000.0, 1000.0)],
], ids=["six columns", "a cluster and one point"])
def test_tiles_reach_every_target(spark, monkeypatch, places):
    monkeypatch.setattr(geometry, "MANY_CENTRES", 100)
    monkeypatch.setattr(geometry, "TILE_CENTRES", 6)
    f = lambda u, v: (150 + u / 50 * 8 + v / 50 * 0.5, -20 + v / 50 * 0.9 + u / 50 * 0.1)
    centres = spark.createDataFrame([(u, v, *f(u, v)) for u, v in places], "u double, v double, a double, b double")
    targets = spark.createDataFrame([(x, y) for x in (0.5, 24.5, 140.0, 900.0) for y in (0.5, 77.0, 500.0, 990.0)], "x double, y double")
    got = geometry.spline_at(centres, targets, ("x", "y"), ("lon", "lat")).collect()
    assert len(got) == 16
    for r in got:
        assert (r.lon, r.lat) == pytest.approx(f(r.x, r.y), abs=1e-6)


def agree(spark, root, name, ids):
    """Holds a query against its SQL on embeddings with ``ids``."""
    rows = [(i, [((i * 37 + b * 101) % 997 - 498) / 499.0 for b in range(64)]) for i in ids]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{root}/embeddings.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{root}/embeddings.parquet/*.parquet'")
    want = db.sql(Q.ORACLE_SQL[name]).df()
    got = Q.QUERIES[name](spark, str(root)).toPandas()[list(want.columns)]
    order = [c for c in ("band", "y", "x") if c in want.columns]
    a, b = (d.sort_values(order).reset_index(drop=True) for d in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False, atol=2e-6)


@pytest.mark.parametrize("ids", [range(256), range(306), [*range(100), *range(175, 260)]], ids=["odd", "even", "a gap"])
def test_regrid_of_lines_that_are_not_whole(spark, tmp_path, ids):
    agree(spark, tmp_path, "dem_regrid", ids)


def test_regrid_stays_within_shorter_lines(spark):
    grid = spark.createDataFrame([(float(y), float(x), x + 10.0 * y) for y in range(3) for x in range(5 if y < 2 else 3)], "y double, x double, z double")
    axis = lambda name, *at: spark.createDataFrame([(a,) for a in at], f"{name} double")
    got = {(r.y, r.x): r.z for r in terrain.regrid(grid, axis("x", 1.5, 3.5), axis("y", 0.5, 1.5)).collect()}
    assert got == {(0.5, 1.5): 6.5, (0.5, 3.5): 8.5, (1.5, 1.5): 16.5}


@pytest.mark.parametrize("ids", [range(256), range(281), range(250)], ids=["odd", "even", "whole"])
def test_destriping_of_images_that_are_not_whole(spark, tmp_path, ids):
    agree(spark, tmp_path, "fourier_destripe_default", ids)
