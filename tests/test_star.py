"""Star schema operators on small tables."""

import pytest

from salesflow.operators import star
from salesflow.schemas import DIM_CATEGORY, DIM_COUNTRY, DIM_DATE, DIMENSIONS
from tests.rows import FILLED, raw_rows, sales


def pairs(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_smallest_order_id_decides_the_attributes(spark):
    rows = [
        {**FILLED, "orderid": 9, "countryid": 1, "country": "Aruba"},
        {**FILLED, "orderid": 2, "countryid": 1, "country": "Brazil"},
        {**FILLED, "orderid": 5, "countryid": 2, "country": None},
        {**FILLED, "orderid": 6, "countryid": 2, "country": "Chad"},
        {**FILLED, "orderid": 1, "countryid": None, "country": "Nowhere"},
    ]
    found = star.dimension_rows(raw_rows(spark, rows), DIM_COUNTRY)
    assert pairs(found, "countryid", "country") == [(1, "Brazil"), (2, None)]


def test_dimension_rows_have_all_columns(spark):
    for dim in DIMENSIONS:
        assert star.dimension_rows(sales(spark, [1, 2]), dim).columns == dim.names


def test_fact_has_one_row_per_id(spark):
    df = sales(spark, [1, 1, 2, None], amount=7).unionByName(sales(spark, [1, 3], amount=4))
    assert pairs(star.fact_rows(df), "orderid", "amount") == [(1, 4), (2, 7), (3, 4)]
    again = star.fact_rows(df.repartition(5))
    assert star.fact_rows(df).exceptAll(again).isEmpty()


def test_null_keys_are_never_new(spark):
    rows = [{**FILLED, "orderid": i, "dateid": d} for i, d in enumerate([None, 1, 2])]
    found = star.dimension_rows(raw_rows(spark, rows), DIM_DATE)
    for existing, new in [([], [1, 2]), ([1], [2]), ([1, None], [2])]:
        stored = spark.createDataFrame([(d,) for d in existing], "dateid int")
        fresh = star.new_rows(found, stored, "dateid")
        assert pairs(fresh, "dateid") == [(d,) for d in new]
    nothing = spark.createDataFrame([], "dateid int")
    raw_key = star.new_rows(raw_rows(spark, rows), nothing, "dateid")
    assert pairs(raw_key, "dateid") == [(1,), (2,)]


def test_conflicts_count_different_values(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "b"), (2, "c"), (2, "c"), (3, None), (3, "d"), (None, "e")],
        "countryid int, country string",
    )
    found = star.attribute_conflicts(df, "countryid", "country")
    assert pairs(found, "countryid", "distinct_values") == [(1, 2)]


@pytest.mark.parametrize("broadcast_bytes", ["-1", "10m"])
def test_orphans_name_the_missing_dimensions(spark, broadcast_bytes):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_bytes)
    fact = star.fact_rows(
        raw_rows(
            spark,
            [
                {**FILLED, "orderid": 1},
                {**FILLED, "orderid": 2, "dateid": 5},
                {**FILLED, "orderid": 3, "countryid": None, "categoryid": 8},
            ],
        )
    )
    known = sales(spark, [1])
    found = star.orphan_facts(
        fact, *(star.dimension_rows(known, d) for d in (DIM_DATE, DIM_CATEGORY, DIM_COUNTRY))
    )
    assert sorted(map(tuple, found.collect())) == [
        (2, False, True, True),
        (3, True, False, False),
    ]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sales_by_country_and_quarter(spark):
    peru = sales(spark, [3], amount=1, countryid=2, country="Peru")
    rows = sales(spark, [1, 2], amount=5).unionByName(peru)
    totals = star.sales_by_country_quarter(
        star.fact_rows(rows),
        star.dimension_rows(rows, DIM_DATE),
        star.dimension_rows(rows, DIM_COUNTRY),
    )
    assert pairs(totals, "country", "quartername", "orders", "total_amount") == [
        ("Chile", "Q1", 2, 10),
        ("Peru", "Q1", 1, 1),
    ]
