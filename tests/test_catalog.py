"""Every registered query beside its SQL twin, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__
from conftest import SF
from corvane.plans import catalog

SF = os.environ.get("TEST_SF_DIR", SF)


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in at] for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}{'/*' if os.path.isdir(path) else ''}')")
    return con


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    found = duck.execute(__spark_entry__.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    want = ordered(columns, found.fetchall())
    assert ordered(df.columns, df.collect()) == want
    assert want or name == "uuid8_census"


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
