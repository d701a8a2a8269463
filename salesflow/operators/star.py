"""Star schema operators: dimension and fact rows, new keys, conflicts, orphans, star query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.schemas import DIM_CATEGORY, DIM_COUNTRY, DIM_DATE, DIMENSIONS, FACT, Table


def dimension_rows(cleaned: DataFrame, dim: Table) -> DataFrame:
    """One row per dimension key: the attributes seen with the smallest order id.

    Equal attribute sets collapse first, in a hash aggregation that is combined before the
    shuffle. What is left to choose from is about as small as the dimension, however many
    rows share one key.
    """
    seen = (
        cleaned.filter(F.col(dim.key).isNotNull())
        .groupBy(dim.key, *dim.attributes)
        .agg(F.min("orderid").alias("orderid"))
    )
    return _first_seen(seen, dim)


def _first_seen(seen: DataFrame, dim: Table) -> DataFrame:
    first = F.min(F.struct("orderid", *dim.attributes)).alias("first")
    return seen.groupBy(dim.key).agg(first).select(dim.key, "first.*").drop("orderid")


def seen_attributes(cleaned: DataFrame) -> DataFrame:
    """The attribute sets of all dimensions with their smallest order id, in one pass.

    A grouping set for each dimension; `member` tells which one a row belongs to.
    """
    sets = [dim.names for dim in DIMENSIONS]
    columns = [name for names in sets for name in names]
    # Attributes that are in no set of a row are NULL there; a bit of grouping_id marks each.
    return cleaned.groupingSets(sets, *columns).agg(
        F.grouping_id().alias("member"), F.min("orderid").alias("orderid")
    )


def dimension_of(seen: DataFrame, dim: Table) -> DataFrame:
    """One row per key of a dimension, from `seen_attributes`; the same as `dimension_rows`."""
    columns = [name for table in DIMENSIONS for name in table.names]
    absent = int("".join("0" if name in dim.names else "1" for name in columns), 2)
    own = seen.filter((F.col("member") == absent) & F.col(dim.key).isNotNull())
    return _first_seen(own.select("orderid", *dim.names), dim)


def fact_rows(cleaned: DataFrame) -> DataFrame:
    """One row per order id; among copies the smallest row, so that reruns agree."""
    return (
        cleaned.select(*FACT.names)
        .filter(F.col(FACT.key).isNotNull())
        .groupBy(FACT.key)
        .agg(F.min(F.struct(*FACT.attributes)).alias("first"))
        .select(FACT.key, "first.*")
    )


def new_rows(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not there yet. NULL keys are never new: no table takes them."""
    return rows.filter(F.col(key).isNotNull()).join(existing.select(key), key, "left_anti")


def attribute_conflicts(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys seen with more than one value of an attribute, and how many values.

    Pairs are made distinct before counting per key, so no task holds the values of a key.
    """
    pairs = df.filter(F.col(key).isNotNull() & F.col(attribute).isNotNull())
    return (
        pairs.select(key, attribute)
        .distinct()
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("distinct_values"))
        .filter("distinct_values > 1")
    )


def orphan_facts(
    fact: DataFrame, dates: DataFrame, categories: DataFrame, countries: DataFrame
) -> DataFrame:
    """Fact rows that miss at least one dimension row, with the state of all three."""

    def keys(dim: DataFrame, table: Table) -> DataFrame:
        return dim.select(table.key, F.lit(True).alias(f"has_{table.name}"))

    found = (
        fact.select("orderid", "dateid", "categoryid", "countryid")
        .join(keys(dates, DIM_DATE), "dateid", "left")
        .join(keys(categories, DIM_CATEGORY), "categoryid", "left")
        .join(keys(countries, DIM_COUNTRY), "countryid", "left")
    )
    flags = [f"has_{t.name}" for t in (DIM_DATE, DIM_CATEGORY, DIM_COUNTRY)]
    return found.select(
        "orderid", *(F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags)
    ).filter(" or ".join(f"not {f}" for f in flags))


def key_totals(fact: DataFrame, *more: str) -> DataFrame:
    """Orders and amount per country and day (and whatever else is named)."""
    return fact.groupBy(*more, "countryid", "dateid").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("amount")
    )


def sales_by_country_quarter(
    fact: DataFrame, dates: DataFrame, countries: DataFrame
) -> DataFrame:
    """Orders and amount per country, year and quarter.

    Facts are summed per key pair before they meet the dimensions, so the joins see at most
    one row per country and day and a hot country costs nothing.
    """
    return sales_of_totals(key_totals(fact), dates, countries)


def sales_of_totals(totals: DataFrame, dates: DataFrame, countries: DataFrame) -> DataFrame:
    """The same from totals per country and day, of which several may be parts of one sum."""
    return (
        totals.join(countries.select("countryid", "country"), "countryid")
        .join(dates.select("dateid", "year", "quartername"), "dateid")
        .groupBy("country", "year", "quartername")
        .agg(F.sum("orders").alias("orders"), F.sum("amount").alias("total_amount"))
    )
