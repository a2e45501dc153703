"""Every registered query against its SQL on the smallest tables, and the driver contract."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as contract
from tickwise import workload

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(FOLDER):
        pytest.skip("no sample tables")
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    def cell(v):
        if v is None or v is pd.NA or (np.isscalar(v) and pd.isna(v)):
            return ""
        return f"{round(float(v), 6) + 0.0:.6f}" if isinstance(v, (float, np.floating)) else str(v)

    out = pd.DataFrame({c: df[c].map(cell) for c in sorted(df.columns)})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def test_every_query_has_sql():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(workload.QUERIES) == set(workload.ORACLES) and len(workload.QUERIES) == 83


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert len(got) > 0
    if name in contract.oracle_sql():
        pd.testing.assert_frame_equal(canonical(got), canonical(duck.execute(contract.oracle_sql()[name]).df()))


def test_entry(spark):
    assert contract.entry(spark).count() > 0
