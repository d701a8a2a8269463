"""Column repairs for raw sales rows: country digits, weekday names and quarter names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The name each weekday and quarter code stands for.
WEEKDAY_NAMES = {
    "1": "Sunday",
    "2": "Monday",
    "3": "Tuesday",
    "4": "Wednesday",
    "5": "Thursday",
    "6": "Friday",
    "7": "Saturday",
}
QUARTER_NAMES = {"1": "Q1", "2": "Q2", "3": "Q3", "4": "Q4"}


def without_digits(name: str) -> Column:
    """The text with every ASCII digit removed; nothing is trimmed and NULL stays NULL."""
    return F.regexp_replace(name, "[0-9]+", "")


def is_missing(name: str) -> Column:
    """True for NULL and for the empty string; a space counts as text."""
    return F.col(name).isNull() | (F.col(name) == "")


def filled(name: str, number: str) -> Column:
    """The text, or the number column as text where the text is missing."""
    return F.when(is_missing(name), F.col(number).cast("string")).otherwise(F.col(name))


def fill_names(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "weekdayname": filled("weekdayname", "weekday"),
            "quartername": filled("quartername", "quarter"),
        }
    )


def clean(df: DataFrame) -> DataFrame:
    """Repair country, weekdayname and quartername; all other columns pass unchanged.

    Codes without a name (such as weekday 9) stay as text.
    """
    return (
        fill_names(df)
        .withColumn("country", without_digits("country"))
        .na.replace(WEEKDAY_NAMES, subset=["weekdayname"])
        .na.replace(QUARTER_NAMES, subset=["quartername"])
    )
