"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.tables import id_and_text

# Labelled rows that a classifier is fitted on, about. Fewer labels are all taken.
SAMPLE_ROWS = 20_000


def share(column: Column) -> Column:
    """A fixed pseudo-random number from 0 to 1 for a value."""
    return (F.xxhash64(column).bitwiseAND((1 << 52) - 1)) / float(1 << 52)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(doc_id, text, label) for about `rows` labelled documents, chosen by a hash of the id.

    `usable` restricts the ids to learn from. An id labelled more than once counts as 1 if at
    least half of its labels are 1; NULL ids and labels are left out; an id that several documents
    share brings the first of their texts. The chosen labels are few, so they are broadcast.
    """
    votes = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & usable)
        .groupBy("doc_id")
        .agg(F.avg(F.col("label").cast("double")).alias("label"))
    )
    total = votes.count()
    chosen = votes.filter(share(F.col("doc_id")) < rows / max(total, rows)).select(
        "doc_id", (F.col("label") >= 0.5).cast("int").alias("label")
    )
    return (
        id_and_text(docs)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
