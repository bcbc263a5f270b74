"""The relational queries against DuckDB, and the as-of join's edge cases."""

import glob
import os
import tempfile

import duckdb
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import __spark_entry__
from tidewell import plans
from tidewell.operators import asof_join
from tidewell.sources import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.local.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = plans.QUERIES[name](spark, FOLDER)
    want = duck.sql(plans.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect())))
    assert rows == sorted(map(str, want.select(*columns).fetchall()))


def test_asof_join_ties_nulls_and_clashing_names(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 1, "b"), (None, 5, "c"), (2, None, "d"), (2, 9, "e")], "k int, t int, v string")
    right = spark.createDataFrame([(1, 5, "x", 1), (1, 5, "y", 2), (1, 2, "z", 9), (None, 1, "n", 1), (2, None, "m", 1)], "k int, t int, v string, n int")
    got = {r.v: r.right_v for r in asof_join(left, right, ["k"], "t", ["v"], F.col("n")).collect()}
    assert got == {"a": "y", "b": None, "c": None, "d": None, "e": None}


def test_entry_and_unknown_table(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    with pytest.raises(ValueError):
        table(spark, FOLDER, "nothing")
