"""Micro-batch loading of raw files as they arrive."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesflow.functions.cleaning import clean
from salesflow.operators.star import fact_rows
from salesflow.plans.jobs import load_dimensions, load_star
from salesflow.schemas import CLEANED, FACT, STAGING, STAR
from salesflow.sources.files import names_in
from salesflow.sources.stores import ParquetStore

# Settings of the state store.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A batch uploads the ids it has added, not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _raw_files(staging: ParquetStore, max_files_per_trigger: int | None) -> DataFrame:
    """Raw rows of files as they arrive."""
    reader = staging.spark.readStream.schema(STAGING.struct)
    reader = reader.option("recursiveFileLookup", True)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(staging.path(STAGING))


def _part(rows: DataFrame, batch_id: int) -> str:
    """The name of a micro-batch's part of a table, the same whenever the batch is repeated."""
    stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"stream-{stream}-{batch_id}"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that a stream takes over when it starts; the session gets its own ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def ingest_files(
    staging: ParquetStore,
    production,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Clean and load all raw files not seen before, then stop.

    Files arrive in any id order, so progress is kept by the checkpoint, not by an id
    watermark. A repeated micro-batch rewrites its own part of the cleaned table and adds only
    facts and dimension keys that are still missing, so repeating one changes nothing. Parts
    are named after the id of the stream, which its checkpoint keeps, and the batch number.
    The staging area must be a folder, because a stream reads files and rewrites parts.
    """
    if not isinstance(staging, ParquetStore):
        raise TypeError("a stream needs a staging area in a folder, not in a catalog or database")
    staging.require(STAGING, CLEANED)
    production.require(*STAR)
    def load(rows: DataFrame, batch_id: int) -> None:
        valid = clean(rows.filter(F.col("orderid") > 0))
        stored = staging.replace_part(valid, CLEANED, _part(rows, batch_id))
        span = stored.agg(F.min("orderid").alias("first"), F.max("orderid").alias("last")).first()
        if span["first"] is not None:
            load_star(stored, production, span["first"], span["last"])

    return (
        _raw_files(staging, max_files_per_trigger)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _known_ids(production: ParquetStore, checkpoint: str) -> DataFrame | None:
    """Ids of the facts that were there before the stream first started; None if there were none.

    They are written down once, beside the checkpoint, so that a stream that is resumed does not
    take its own facts for older ones.
    """
    spark, folder = production.spark, f"{checkpoint.rstrip('/')}-known-ids"
    if "_SUCCESS" not in names_in(spark, folder):
        # Nobody resumes a stream before this is complete: an unfinished attempt is replaced.
        production.read(FACT).select("orderid").write.mode("overwrite").parquet(folder)
    known = spark.read.schema("orderid int").parquet(folder)
    return None if known.isEmpty() else known


def ingest_new_ids(
    staging: ParquetStore,
    production: ParquetStore,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Clean and load the orders whose id has not arrived before, from all new files, then stop.

    The ids that have arrived are keyed state of the stream (RocksDB, saved with the checkpoint), so
    replayed files, late ids and repeated ids are told apart without reading the fact table; rows
    stay in the JVM. The cleaned and the fact table get one row for each id, that of its first
    micro-batch; among differing copies inside one micro-batch any may be it. A repeated micro-batch
    starts from the state before it and rewrites its own parts. Facts that were there before the
    first start keep their ids: they are written down then and left out by a join. All shuffle
    partitions keep a share of the state, so choose `spark.sql.shuffle.partitions` for the final number
    of ids before the first start. Both stores must be folders.
    """
    if not (isinstance(staging, ParquetStore) and isinstance(production, ParquetStore)):
        raise TypeError("a stream with state needs both stores in folders")
    staging.require(STAGING, CLEANED)
    production.require(*STAR)
    rows = _raw_files(staging, max_files_per_trigger).filter(F.col("orderid") > 0)
    known = _known_ids(production, checkpoint)
    if known is not None:
        rows = rows.join(known, "orderid", "left_anti")

    def load(fresh: DataFrame, batch_id: int) -> None:
        part = _part(fresh, batch_id)
        stored = staging.replace_part(clean(fresh), CLEANED, part)
        load_dimensions(stored, production)
        facts = production.replace_part(fact_rows(stored), FACT, part)
        span = facts.agg(F.min("orderid").alias("first"), F.max("orderid").alias("last")).first()
        if production.summaries and span["first"] is not None:
            production.facts_changed(span["first"] - 1, span["last"])

    with _settings(staging.spark, _STATE):
        return (
            rows.dropDuplicates(["orderid"])
            .writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
