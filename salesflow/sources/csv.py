"""CSV files as raw staging rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.schemas import STAGING

_LINE = "_line"


class CsvRows(NamedTuple):
    """Rows with the declared types, and lines that have none: file, line and reason."""

    accepted: DataFrame
    rejected: DataFrame


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows with the declared types; a header or value that does not fit is an error."""
    return (
        spark.read.schema(STAGING.struct)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def _reason(line: Column) -> Column:
    """What keeps a line from being a row: its number of fields, or the columns that do not fit."""
    texts = ", ".join(f"`{name}` string" for name in STAGING.names)
    fields = F.from_csv(line, F.lit(f"{texts}, {_LINE} string"), {"columnNameOfCorruptRecord": _LINE})
    unfit = F.array_compact(
        F.array(
            *(
                F.when(fields[f.name].isNotNull() & fields[f.name].try_cast(f.dataType).isNull(), F.lit(f.name))
                for f in STAGING.struct
            )
        )
    )
    return (
        F.when(fields[_LINE].isNotNull(), "number of fields")
        .when(F.size(unfit) > 0, F.array_join(unfit, ", "))
        .otherwise("unreadable")
    )


def read_csv_with_rejects(spark: SparkSession, path: str, header: bool = True) -> CsvRows:
    """Rows that have the declared types, and apart from them the lines that do not fit.

    Every line is either accepted or rejected, but for empty ones and, with `header`, lines that name the
    columns in their order. A rejected line comes with its file, its text and the reason: `number of
    fields`, the names of the columns whose values do not fit, or `unreadable` for what only the
    reader refuses. A record is one line. Lines are parsed as a whole, whatever columns are used later.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STAGING.struct)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "dateFormat": "yyyy-MM-dd"}
    row = F.from_csv("value", F.lit(f"{schema}, {_LINE} string"), options)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    lines = lines.filter(F.trim("value") != "")
    if header:
        lines = lines.filter(F.col("value") != ",".join(STAGING.names))
    parsed = lines.select("file", "value", row.alias("row"))
    bad = F.col(f"row.{_LINE}").isNotNull()
    rejected = parsed.filter(bad).select("file", F.col("value").alias("line"), _reason(F.col("value")).alias("reason"))
    return CsvRows(parsed.filter(~bad).select(*(F.col(f"row.{n}") for n in STAGING.names)), rejected)
