"""Every registered query against its SQL on the smallest tables."""

import math
import os

import pandas as pd
import pytest

from lensmill import plans
from tests import python_checks

duckdb = pytest.importorskip("duckdb")
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf}/{f}')")
    return c


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(map(plain, r)) for r in df.itertuples(index=False, name=None)), key=repr)


def as_numbers(r):
    return [tuple(float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in t) for t in r]


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, sf, db, name):
    got = plans.queries()[name](spark, sf)
    assert len(set(got.columns)) == len(got.columns)
    if name not in SQL:
        t = lambda table: pd.read_parquet(f"{sf}/{table}.parquet")
        python_checks.CHECKS[name](got.toPandas(), t)
        return
    want = db.sql(SQL[name]).df()
    have = got.toPandas()
    assert sorted(have.columns) == sorted(want.columns)
    assert sorted(as_numbers(rows(have)), key=repr) == sorted(as_numbers(rows(want)), key=repr)


def test_every_query_has_a_check():
    assert set(plans.queries()) - set(SQL) == set(python_checks.CHECKS)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
