"""Incremental reading by order id: high-water mark, next batch, batch numbering.

A batch is an id range: all copies of an id are in one batch. Order ids are 32-bit integers, so
shifting one right by 16 bits yields at most 65,536 different buckets of at most 65,536 different
ids. That bound is what lets the running sums below work on pre-aggregated counts, whatever the
size of the table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ID = "orderid"
_BUCKET_BITS = 16
# Ids in a row of a bitmap, as a power of two.
_WORD_BITS = 6


class Batch(NamedTuple):
    """Rows of one batch, how many there are, and its largest id."""

    frame: DataFrame
    rows: int
    last_id: int


class _Cut(NamedTuple):
    last_id: int
    rows_before: int
    rows: int


class IdCounts:
    """Row counts of a table by id bucket and by id, as (slot, rows)."""

    def __init__(self, df: DataFrame):
        self._df = df

    def by_bucket(self, watermark: int) -> DataFrame:
        return _rows_per(after(self._df, watermark), F.shiftright(ID, _BUCKET_BITS))

    def by_id(self, first: int, last: int) -> DataFrame:
        return _rows_per(self._df.filter(F.col(ID).between(first, last)), F.col(ID))


def high_watermark(df: DataFrame) -> DataFrame:
    """One row: the largest order id, or 0 where there is none."""
    return df.agg(F.coalesce(F.max(ID), F.lit(0)).alias("max_orderid"))


def after(df: DataFrame, watermark: int) -> DataFrame:
    """Rows beyond the watermark. A NULL id compares as unknown and never passes."""
    return df.filter(F.col(ID) > watermark)


def between(df: DataFrame, after_id: int, last_id: int) -> DataFrame:
    return after(df, after_id).filter(F.col(ID) <= last_id)


def id_words(df: DataFrame) -> DataFrame:
    """(word, bits): an exact bitmap of the ids, 64 neighbouring ids in a row; NULL ids are none.

    Bits are set by a hash aggregation that is combined before the shuffle, so copies of an id cost
    nothing and a dense range of ids shrinks to a quarter of a byte for each.
    """
    bit = F.expr(f"shiftleft(1L, {ID} & {(1 << _WORD_BITS) - 1})")
    return (
        df.filter(F.col(ID).isNotNull())
        .groupBy(F.shiftright(ID, _WORD_BITS).alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def ids_of_words(words: DataFrame) -> DataFrame:
    """The ids whose bits are set."""
    places = F.filter(
        F.sequence(F.lit(0), F.lit((1 << _WORD_BITS) - 1)), lambda place: F.getbit("bits", place) == 1
    )
    first = F.shiftleft(F.col("word"), _WORD_BITS)
    return words.select("word", F.explode(places).alias("place")).select(
        (first + F.col("place")).cast("int").alias(ID)
    )


def lacking(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids of one bitmap that another one lacks; both are (word, bits) with a row for each word."""
    known = stored.select("word", F.col("bits").alias("known"))
    absent = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0))))
    both = wanted.join(known, "word", "left")
    return ids_of_words(both.select("word", absent.alias("bits")).filter("bits != 0"))


def missing_ids(df: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids of `df` that `stored` lacks, each once.

    Exact bitmaps of both sides are compared, one row for 64 ids; single ids exist again only for
    words that differ. Neither repeated ids nor gaps make this any slower.
    """
    return lacking(id_words(df), id_words(stored))


def _cut(counts: DataFrame, limit: int, offset: int = 0) -> _Cut | None:
    """First slot at which the running row count reaches the limit (else the last slot).

    `counts` has one row per slot, at most 65,536 of them, so its running sum may sit in one task.
    """
    running = counts.withColumn("upto", offset + F.sum("rows").over(Window.orderBy("slot")))
    found = (
        running.filter(F.col("upto") - F.col("rows") < limit)
        .agg(F.max(F.struct("slot", F.col("upto") - F.col("rows"), "upto")).alias("last"))
        .first()
    )
    return None if found["last"] is None else _Cut(*found["last"])


def _rows_per(df: DataFrame, slot) -> DataFrame:
    return df.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("rows"))


def next_batch(
    df: DataFrame, watermark: int, rows: int, counts: IdCounts | None = None
) -> Batch | None:
    """The smallest ids beyond the watermark, in all their copies, until `rows` rows are reached.

    None if nothing is left. The end of the batch is found from counts per id bucket and then per
    id inside one bucket, which read the id column only. The batch is an id range that reaches the
    scan as a pushed-down filter: there is no sort and no row limit that merges partitions. Only
    copies of its last id can make it larger than `rows`.
    """
    counts = counts or IdCounts(df)
    bucket = _cut(counts.by_bucket(watermark), rows)
    if bucket is None:
        return None
    first = max(watermark + 1, bucket.last_id << _BUCKET_BITS)
    last = ((bucket.last_id + 1) << _BUCKET_BITS) - 1
    cut = _cut(counts.by_id(first, last), rows, bucket.rows_before)
    return Batch(between(df, watermark, cut.last_id), cut.rows, cut.last_id)


def assign_batches(df: DataFrame, watermark: int, batch_rows: int) -> DataFrame:
    """Batch number of every pending order id, with all copies of an id in one batch.

    Rows are counted per id first (combined before the shuffle, so a hot id is harmless), ids
    are ranked inside their bucket, and bucket offsets come from at most 65,536 totals.
    """
    ids = (
        after(df, watermark)
        .select(ID, F.shiftright(ID, _BUCKET_BITS).alias("bucket"))
        # Stated here, because the join below would add it to one side only, and the two
        # sides could no longer share one shuffle.
        .filter(F.col("bucket").isNotNull())
        .groupBy("bucket", ID)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    offsets = (
        ids.groupBy("bucket")
        .agg(F.sum("copies").alias("bucket_rows"))
        .select(
            "bucket",
            (F.sum("bucket_rows").over(Window.orderBy("bucket")) - F.col("bucket_rows")).alias(
                "offset"
            ),
        )
    )
    inside = F.sum("copies").over(Window.partitionBy("bucket").orderBy(ID)) - F.col("copies")
    return (
        ids.withColumn("inside", inside)
        # At most 65,536 rows of two integers.
        .join(F.broadcast(offsets), "bucket")
        .select(ID, "copies", F.expr(f"(offset + inside) div {batch_rows} + 1").alias("batch_no"))
    )


def batch_bounds(assigned: DataFrame) -> DataFrame:
    """First id, last id and row count of every batch."""
    return assigned.groupBy("batch_no").agg(
        F.min(ID).alias("first_orderid"),
        F.max(ID).alias("last_orderid"),
        F.sum("copies").alias("rows"),
    )
