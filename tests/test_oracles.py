"""Every registered query of the library against DuckDB on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pandas as pd
import pytest

from larkspur.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(frame: pd.DataFrame) -> list:
    def cell(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return "null"
        if isinstance(x, (dt.date, pd.Timestamp)):
            return str(pd.Timestamp(x))
        return f"{x:.9g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted(tuple(map(cell, row)) for row in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name in registry.ORACLES:
        want = duck.execute(registry.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)
    else:
        assert len(got)
