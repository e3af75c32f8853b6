"""Every registered query against its SQL on the small tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from fileload.plans.checks import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, result.fetchall()))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == spark.read.parquet(f"{SF_DIR}/events.parquet").count()
