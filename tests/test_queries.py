"""Every core query against its SQL on the smallest tables."""

import collections
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from lamella.plans import queries as core

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query(spark, con, name):
    df = core.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = collections.Counter(str(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    if name in core.oracle_sql():
        rel = con.sql(core.oracle_sql()[name])
        assert sorted(rel.columns) == cols
        at = [rel.columns.index(c) for c in cols]
        assert got == collections.Counter(str(tuple(norm(x[i]) for i in at)) for x in rel.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
