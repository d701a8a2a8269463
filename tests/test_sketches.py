"""Merged sketches against exact values, within their stated errors."""

import pytest
from pyspark.sql import functions as F

from salesflow.operators import sketches

ERRORS = 4  # standard errors


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    return spark.range(40_000).select(
        (n % 4).cast("int").alias("batch"),
        (F.xxhash64(n) % 30_000).cast("int").alias("wide"),
        F.when(n % 5 == 0, 7).when(n % 50 == 1, None).otherwise((n % 900).cast("int")).alias("often"),
        (n + (n % 4) * 100_000).cast("int").alias("moving"),
        F.lit(None).cast("int").alias("nothing"),
    )


COLUMNS = ["wide", "often", "moving", "nothing"]


@pytest.fixture(scope="module")
def found(spark, rows):
    return sketches.summaries(rows, F.col("batch"), COLUMNS).persist()


def exact(rows, name):
    return rows.filter(F.col(name).isNotNull())


def test_one_row_for_each_batch_and_column(found):
    assert found.count() == 4 * len(COLUMNS)
    assert {(r["rows"], r["missing"]) for r in found.filter("column_name = 'nothing'").collect()} == {(10_000, 10_000)}


@pytest.mark.parametrize("name", ["wide", "often", "moving"])
def test_merged_batches_are_within_the_errors(rows, found, name):
    ranks = [0.0, 0.1, 0.5, 0.9, 1.0]
    row = sketches.report(sketches.merged(found), ranks).filter(F.col("column_name") == name).first()
    values = exact(rows, name)
    n, distinct = values.count(), values.select(name).distinct().count()
    assert row["rows"] == 40_000 and row["missing"] == 40_000 - n
    assert abs(row["distinct_values"] - distinct) <= ERRORS * sketches.DISTINCT_ERROR * distinct + 1
    for rank, value in zip(ranks, row["quantiles"], strict=True):
        below = values.filter(F.col(name) < value).count() / n
        upto = values.filter(F.col(name) <= value).count() / n
        assert below - 2 * sketches.RANK_ERROR <= rank <= upto + 2 * sketches.RANK_ERROR


def test_merging_in_parts_counts_the_same(found):
    parts = [sketches.merged(found.filter(f"batch % 2 = {i}")) for i in (0, 1)]
    again = sketches.merged(parts[0].unionByName(parts[1]))
    one, other = (
        {r["column_name"]: (r["rows"], r["missing"], r["distinct_values"]) for r in sketches.report(x, [0.5]).collect()}
        for x in (again, sketches.merged(found))
    )
    assert one == other


def test_the_most_frequent_value_comes_first(found):
    row = sketches.report(sketches.merged(found), [0.5], 3).filter("column_name = 'often'").first()
    assert row["frequent"][0]["item"] == 7 and row["frequent"][0]["count"] >= 8_000


def test_drift_between_batches(found):
    one, other = (found.filter(f"batch = {i}") for i in (0, 1))
    drift = {r["column_name"]: r["drift"] for r in sketches.drift(one, other).collect()}
    assert drift["wide"] < 0.05 and drift["moving"] > 0.9
    itself = {r["column_name"]: r["drift"] for r in sketches.drift(one, one).collect()}
    assert itself["wide"] == 0 and itself["nothing"] is None


def test_no_rows(rows):
    empty = sketches.summaries(rows.limit(0), F.col("batch"), COLUMNS)
    assert empty.isEmpty() and sketches.merged(empty).isEmpty()
