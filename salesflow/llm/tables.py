"""Reading and guarding the input tables of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A few given rows as a table, by SQL literals; `columns` is a schema such as "a long, b string"."""
    names = [c.split()[0] for c in columns.split(",")]
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs).cast(f"array<struct<{_typed(columns)}>>")))


def _typed(columns: str) -> str:
    return ",".join(":".join(c.split()) for c in columns.split(","))


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, a NULL text as the empty one; other columns cannot clash then."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def hash_bucket(column: Column, buckets: int) -> Column:
    """crc32 of the value's decimal text, modulo `buckets`; NULL for NULL."""
    return F.crc32(column.cast("string").cast("binary")) % buckets
