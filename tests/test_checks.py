"""Constraint checks, guarded writes, quality counts and table definitions."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from salesflow.operators import checks
from salesflow.schemas import CLEANED, DIM_CATEGORY, DIM_COUNTRY, DIM_DATE, FACT, STAGING
from tests.rows import FILLED, ids_of, raw_rows, sales


def test_table_definitions():
    assert STAGING.columns == CLEANED.columns
    assert len(STAGING.names) == 16
    assert [t.key for t in (DIM_DATE, DIM_CATEGORY, DIM_COUNTRY, FACT)] == [
        "dateid", "categoryid", "countryid", "orderid",
    ]
    for table in (DIM_DATE, DIM_CATEGORY, DIM_COUNTRY, FACT):
        assert table.names[0] == table.key
        assert [f.name for f in table.struct if not f.nullable] == [table.key]
    assert STAGING.key is None and all(f.nullable for f in STAGING.struct)
    assert FACT.struct["amount"].dataType == T.IntegerType()
    assert DIM_DATE.struct["date"].dataType == T.DateType()
    assert {c.name: c.length for c in DIM_DATE.columns if c.length} == {
        "quartername": 2, "monthname": 50, "weekdayname": 50,
    }
    assert "`quartername` VARCHAR(2)" in STAGING.ddl
    assert "`dateid` INT NOT NULL" in DIM_DATE.ddl


def test_duplicate_keys(spark):
    found = checks.duplicate_keys(sales(spark, [1, 2, 2, 2, None, None]), "orderid")
    assert [tuple(r) for r in found.collect()] == [(2, 3)]


def test_null_and_long_values(spark):
    df = sales(spark, [1], country="Chile").unionByName(sales(spark, [2], country=None))
    assert ids_of(checks.null_values(df, "country")) == [2]
    assert ids_of(checks.too_long(df, "country", 4)) == [1]
    assert checks.too_long(df, "country", 5).isEmpty()


def test_guarded_rows_pass_or_fail(spark):
    good = sales(spark, [1], country="x" * 50)
    assert checks.enforced(good, CLEANED).collect() == good.collect()
    with pytest.raises(PySparkException, match="country is longer than 50"):
        checks.enforced(sales(spark, [1], country="x" * 51), CLEANED).collect()
    with pytest.raises(PySparkException, match="fact_orders.orderid must not be NULL"):
        checks.enforced(sales(spark, [None]), FACT).collect()


def test_quality_report(spark):
    rows = [
        {**FILLED, "orderid": 1, "weekdayname": None, "quartername": "", "country": "1a"},
        {**FILLED, "orderid": 2, "weekdayname": "9", "quartername": "2", "country": None},
        {**FILLED, "orderid": 3, "weekdayname": None, "weekday": None, "quartername": "Q9"},
    ]
    report = {r["stage"]: r for r in checks.quality_report(raw_rows(spark, rows)).collect()}
    assert tuple(report["raw"]) == ("raw", 3, 2, 1, 1, 2, 1)
    assert tuple(report["cleaned"]) == ("cleaned", 3, 1, 1, 0, 1, 0)
