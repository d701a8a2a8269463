"""Every named query against its SQL text on the same tables."""

import math
from collections import Counter

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from salesflow.plans import oracle, registry
from salesflow.sources import sample

DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "orders"]
QUERIES = registry.queries()
ORACLES = oracle.oracle_sql()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(QUERIES) == set(ORACLES)


def assert_plain_plan(df, capsys):
    """Neither a cross join nor a Python worker takes part in the query."""
    df.explain()
    plan = capsys.readouterr().out
    assert "== Physical Plan ==" in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert bad not in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name, capsys):
    result = QUERIES[name](spark, DATA)
    assert_plain_plan(result, capsys)
    expected = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    found = rows_of(result.columns, result.collect())
    wanted = rows_of(expected.columns, expected.fetchall())
    assert found == wanted
    if name not in ("batch_second", "clean_batch_2"):  # one batch holds all rows here
        assert found


def test_entry_has_rows(spark):
    assert not spark_entry.entry(spark).isEmpty()


def test_raw_rows_do_not_depend_on_the_join_strategy(spark):
    broadcast = sample.raw_sales(spark, DATA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffled = sample.raw_sales(spark, DATA)
        assert broadcast.count() == shuffled.count()
        assert broadcast.exceptAll(shuffled).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ids_beyond_32_bits_are_an_error(spark, tmp_path):
    for name in TABLES:
        table = spark.read.parquet(f"{DATA}/{name}.parquet")
        if name == "orders":
            table = table.withColumn("o_orderkey", F.col("o_orderkey") + 2**31)
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    with pytest.raises(PySparkException, match="32 bits"):
        sample.raw_sales(spark, str(tmp_path)).agg({"orderid": "max"}).collect()
