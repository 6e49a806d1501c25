"""Every query of the reference's operators against its SQL."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from quire.plans import registry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def canon(d: pd.DataFrame) -> list:
    d = d[sorted(d.columns)]
    return sorted(tuple(round(float(x), 6) if isinstance(x, float) else x for x in r) for r in d.astype(object).where(d.notna(), "null").itertuples(index=False))


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_against_sql(spark, con, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in registry.SQL:
        want = con.sql(registry.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canon(got) == canon(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 200
    assert set(e.oracle_sql()) <= set(e.queries())
