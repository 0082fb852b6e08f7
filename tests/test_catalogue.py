"""Every catalogue query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from quillspark.plans import catalogue

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{SF}/{n}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns)
        return
    want = duck.execute(sql).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
