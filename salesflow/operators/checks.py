"""Constraint checks and quality counts. Parquet enforces none of these by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.cleaning import (
    QUARTER_NAMES,
    WEEKDAY_NAMES,
    clean,
    is_missing,
)
from salesflow.schemas import Table


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def null_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def too_long(df: DataFrame, column: str, length: int) -> DataFrame:
    return df.filter(F.length(column) > length)


def key_violations(rows: DataFrame, table: Table) -> DataFrame:
    """Values of a table's declared key that occur more than once."""
    found = duplicate_keys(rows, table.key)
    return found.select(
        F.lit(table.name).alias("table_name"), F.col(table.key).alias("key_value"), "copies"
    )


def null_violations(rows: DataFrame, table: Table) -> DataFrame:
    """Rows without a value in a column that the table declares NOT NULL."""
    required = [c.name for c in table.columns if c.required]
    missing = F.array_compact(F.array(*(F.when(F.col(n).isNull(), F.lit(n)) for n in required)))
    return rows.select(
        F.lit(table.name).alias("table_name"), "orderid", F.explode(missing).alias("column_name")
    )


def length_violations(rows: DataFrame, table: Table) -> DataFrame:
    """Texts longer than the table declares, and their lengths."""
    limited = [c for c in table.columns if c.length]
    excess = [
        F.when(
            F.length(c.name) > c.length,
            F.struct(F.lit(c.name).alias("column_name"), F.length(c.name).alias("characters")),
        )
        for c in limited
    ]
    return rows.select(
        F.lit(table.name).alias("table_name"), "orderid", F.inline(F.array_compact(F.array(*excess)))
    )


def enforced(df: DataFrame, table: Table) -> DataFrame:
    """The table's columns, failing the query at the first NULL key or over-long text.

    The checks ride along with the write: there is no extra pass over the data.
    """

    def guarded(column):
        value = F.col(column.name)
        if column.required:
            problem = F.raise_error(F.lit(f"{table.name}.{column.name} must not be NULL"))
            return F.when(value.isNull(), problem).otherwise(value).alias(column.name)
        if column.length is not None:
            problem = F.raise_error(
                F.lit(f"{table.name}.{column.name} is longer than {column.length} characters")
            )
            return F.when(F.length(value) > column.length, problem).otherwise(value).alias(
                column.name
            )
        return value

    return df.select(*(guarded(c) for c in table.columns))


def _problems(weekday: str, quarter: str, country: str) -> dict:
    def unknown(name, known):
        return ~is_missing(name) & ~F.col(name).isin(*known)

    return {
        "missing_weekdays": is_missing(weekday),
        "unnamed_weekdays": unknown(weekday, WEEKDAY_NAMES.values()),
        "missing_quarters": is_missing(quarter),
        "unnamed_quarters": unknown(quarter, QUARTER_NAMES.values()),
        "countries_with_digits": F.col(country).rlike("[0-9]"),
    }


def quality_report(raw: DataFrame) -> DataFrame:
    """Problem counts before and after cleaning, in one pass: one row per stage."""
    names = ["weekdayname", "quartername", "country"]
    both = clean(raw.withColumns({f"raw_{n}": F.col(n) for n in names}))
    stages = {"raw": _problems(*(f"raw_{n}" for n in names)), "cleaned": _problems(*names)}
    counted = both.agg(
        F.count(F.lit(1)).alias("rows"),
        *(
            F.count_if(problem).alias(f"{stage}_{label}")
            for stage, problems in stages.items()
            for label, problem in problems.items()
        ),
    )
    lines = [
        F.struct(
            F.lit(stage).alias("stage"),
            F.col("rows"),
            *(F.col(f"{stage}_{label}").alias(label) for label in problems),
        )
        for stage, problems in stages.items()
    ]
    return counted.select(F.inline(F.array(*lines)))
