"""Each registered query of the engine against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from refloom.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return "NULL"
    return f"{float(v):.6f}" if isinstance(v, (int, float)) or getattr(getattr(v, "dtype", None), "kind", "") in ("i", "u", "f") else str(v)


def _rows(df):
    return sorted(tuple(map(_plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DATA).toPandas()
    assert len(got)
    if name in registry.oracle_sql():
        want = duck.sql(registry.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert _rows(got) == _rows(want)
