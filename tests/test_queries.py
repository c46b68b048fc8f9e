"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import difference, pair_joins

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return db


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    assert not pair_joins(df)
    got = df.toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
    else:
        problem = difference(got, con.execute(sql).df())
        assert problem is None, problem


def test_entry(spark):
    assert entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(oracle_sql()) <= set(queries())
