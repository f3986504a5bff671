"""Every registered query with an oracle gives the oracle's rows."""

import glob
import math
import os

import duckdb
import pytest

from evidencelake.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{source}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    return float(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_others_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
