"""Every query and its SQL twin agree on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from pushbroom.plans import queries as Q

DATA = "/root/testdata/sf0.001"
CHECKED = sorted(Q.ORACLE_SQL)


def test_names_match_with_no_session():
    assert set(Q.ORACLE_SQL) == set(Q.QUERIES) - {"fourier_destripe_tilted"}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, name):
    db = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    want = db.sql(Q.ORACLE_SQL[name]).df()
    got = Q.QUERIES[name](spark, DATA).toPandas()[list(want.columns)]
    order = list(want.columns)
    a, b = (d.sort_values(order).reset_index(drop=True) for d in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False, atol=2e-6)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_flagship(spark):
    assert Q.flagship(spark, DATA).count() == 64
