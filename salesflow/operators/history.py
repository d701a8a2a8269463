"""Dimension attributes over time: validity intervals, and facts with the version of their day.

What was seen is kept per key and day, the smallest order id of a day deciding, so observations of
later batches and of late rows merge in any order. Versions are runs of equal attributes over the
days of a key. A key has at most one observation for each day, whatever the number of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def observed(rows: DataFrame, key: str, attributes: list[str], day: str = "dateid") -> DataFrame:
    """key, day, orderid and attributes: the first row of each key and day by order id.

    Rows without a key or day are left out. Equal attribute sets collapse before the shuffle.
    """
    seen = (
        rows.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
        .groupBy(key, day, *attributes)
        .agg(F.min("orderid").alias("orderid"))
    )
    return _first_of_day(seen, key, attributes, day)


def merged(stored: DataFrame, more: DataFrame, key: str, attributes: list[str], day: str = "dateid") -> DataFrame:
    """Observations of both; for the same key and day the smaller order id stands."""
    return _first_of_day(stored.unionByName(more), key, attributes, day)


def _first_of_day(seen: DataFrame, key: str, attributes: list[str], day: str) -> DataFrame:
    first = F.min(F.struct("orderid", *attributes)).alias("first")
    return seen.groupBy(key, day).agg(first).select(key, day, "first.*")


def versions(observations: DataFrame, key: str, attributes: list[str], day: str = "dateid") -> DataFrame:
    """key, attributes, valid_from, valid_to: intervals of days, the end open or exclusive.

    A version begins on the first day with other attributes than the observation before; NULL
    attributes are a value like others. The last version of a key has no end.
    """
    days = Window.partitionBy(key).orderBy(day)
    now = F.struct(*attributes)
    begins = observations.select(
        key, *attributes, F.col(day).alias("valid_from"), F.lag(now).over(days).alias("before"), now.alias("now")
    ).filter(~F.col("now").eqNullSafe(F.col("before")))
    ends = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return begins.select(key, *attributes, "valid_from", ends.alias("valid_to"))


def as_of(
    facts: DataFrame, history: DataFrame, key: str, attributes: list[str], day: str = "dateid"
) -> DataFrame:
    """Facts with the attributes of the version that was valid on their day, NULL if none was.

    The version is looked up once for each key and day that occurs, by a scan over the days of a key;
    facts then meet these few rows by an equality join, so a hot key needs no range join.
    """
    asked = facts.select(key, day).filter(F.col(key).isNotNull() & F.col(day).isNotNull()).distinct()
    nothing = F.lit(None).cast(history.select(F.struct(*attributes).alias("v")).schema["v"].dataType)
    days = history.select(key, F.col("valid_from").alias(day), F.struct(*attributes).alias("version"))
    days = days.withColumn("asked", F.lit(False)).unionByName(
        asked.select(key, day, nothing.alias("version"), F.lit(True).alias("asked"))
    )
    upto = Window.partitionBy(key).orderBy(day, "asked").rowsBetween(Window.unboundedPreceding, 0)
    found = days.withColumn("version", F.last("version", ignorenulls=True).over(upto)).filter("asked")
    return facts.join(found.select(key, day, "version"), [key, day], "left").select(
        *facts.columns, *(F.col(f"version.{name}").alias(name) for name in attributes)
    )
