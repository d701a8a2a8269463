"""Small tables for the tests of the text operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their own columns.
CLASHING = (
    "row fingerprint _print _id root component_id score predicted held_out statistics words lines "
    "found spans content id position window piece start length ids_crc32 sequence_id offset label"
).split()


def documents(spark: SparkSession, texts, ids=None) -> DataFrame:
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCUMENT)


def with_clashing(df: DataFrame) -> DataFrame:
    return df.select("*", *(F.lit(-1).alias(name) for name in CLASHING if name not in df.columns))


def words(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(count)
    )


def odd_documents(spark: SparkSession) -> DataFrame:
    """NULL ids, texts and other columns, empty, blank and very long texts, repeated rows and ids."""
    rows = [
        (1, words(1, 40), "en", "a", 1),
        (1, words(1, 40), "en", "a", 1),
        (2, words(1, 40), None, None, None),
        (None, words(2, 40), "en", "a", 1),
        (None, words(2, 40), "en", "a", 1),
        (3, None, "en", "a", None),
        (4, "", "en", "a", 0),
        (5, " \n\t ", "en", "a", 4),
        (6, "x" * 300_000, "en", "a", 300_000),
        (7, "1 " * 60_000, "en", "a", 120_000),
        (8, words(3, 60_000), "en", "a", None),
        (9, "é😀 ß \u0000   end", "de", "a", 1),
        (9, words(4, 30), "de", "b", 1),
        (-5, words(5, 3), "fr", "b", 1),
    ]
    return with_clashing(spark.createDataFrame(rows, DOCUMENT))


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENT)


def labels(spark: SparkSession, rows=()) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
