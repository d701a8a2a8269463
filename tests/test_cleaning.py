"""One row per branch of the cleaning rules, and properties that hold for any text."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesflow.functions.cleaning import clean, is_missing
from salesflow.schemas import STAGING
from tests.rows import raw_rows

WEEKDAYS = [
    (None, 1, "Sunday"),
    ("", 2, "Monday"),
    ("3", 7, "Tuesday"),
    ("Friday", 6, "Friday"),
    ("friday", 6, "friday"),
    (None, None, None),
    ("", 9, "9"),
    ("8", 1, "8"),
    ("01", 2, "01"),
    (" ", 4, " "),
]
QUARTERS = [
    (None, 1, "Q1"),
    ("", 4, "Q4"),
    ("2", 3, "Q2"),
    ("Q3", 3, "Q3"),
    ("", 5, "5"),
    (None, None, None),
]
COUNTRIES = [
    ("12Ger3many 7", "Germany "),
    ("123", ""),
    (None, None),
    ("", ""),
    ("١٢Eg", "١٢Eg"),
]


def cleaned(spark, rows, *columns):
    result = clean(raw_rows(spark, rows)).orderBy("orderid").select(*columns).collect()
    return [row[0] for row in result]


def test_weekday_names(spark):
    rows = [{"orderid": i, "weekdayname": n, "weekday": d} for i, (n, d, _) in enumerate(WEEKDAYS)]
    assert cleaned(spark, rows, "weekdayname") == [want for *_, want in WEEKDAYS]


def test_quarter_names(spark):
    rows = [{"orderid": i, "quartername": n, "quarter": q} for i, (n, q, _) in enumerate(QUARTERS)]
    assert cleaned(spark, rows, "quartername") == [want for *_, want in QUARTERS]


def test_country_digits(spark):
    rows = [{"orderid": i, "country": c} for i, (c, _) in enumerate(COUNTRIES)]
    assert cleaned(spark, rows, "country") == [want for _, want in COUNTRIES]


def test_every_weekday_and_quarter_code(spark):
    rows = [{"orderid": i, "weekday": i, "quarter": i} for i in range(1, 8)]
    assert cleaned(spark, rows, "weekdayname") == [
        "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
    ]
    assert cleaned(spark, rows, "quartername") == ["Q1", "Q2", "Q3", "Q4", "5", "6", "7"]


def test_other_columns_pass_unchanged(spark):
    row = {
        "orderid": 4,
        "amount": 5,
        "date": datetime.date(2020, 2, 29),
        "monthname": "2",
        "category": "7 Toys",
        "weekdayname": "1",
        "quartername": "1",
        "country": "X1",
    }
    raw = raw_rows(spark, [row])
    kept = [n for n in STAGING.names if n not in ("weekdayname", "quartername", "country")]
    assert clean(raw).columns == STAGING.names
    assert clean(raw).select(*kept).collect() == raw.select(*kept).collect()


@pytest.mark.parametrize("value,missing", [(None, True), ("", True), (" ", False), ("1", False)])
def test_missing_is_null_or_empty(spark, value, missing):
    df = raw_rows(spark, [{"country": value}])
    assert df.select(is_missing("country")).first()[0] is missing


texts = st.one_of(st.none(), st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=6),
                  st.sampled_from(["", "1", "7", "8", "Q1", "4"]))
numbers = st.one_of(st.none(), st.integers(-3, 12))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(texts, numbers, texts, numbers, texts), min_size=1, max_size=30))
def test_cleaning_twice_changes_nothing_and_leaves_no_digit(spark, values):
    names = ["weekdayname", "weekday", "quartername", "quarter", "country"]
    rows = [{"orderid": i, **dict(zip(names, v))} for i, v in enumerate(values)]
    once = clean(raw_rows(spark, rows))
    assert once.exceptAll(clean(once)).isEmpty()
    assert once.filter(F.col("country").rlike("[0-9]")).isEmpty()
