"""The loading loop as a stream of id ranges.

Spark's data source interface takes a reader in Python whose offsets are order ids. Its rows are
ranges, one for each batch; what lies in a range is scanned by Spark when the batch is loaded, so no
order passes through Python. The checkpoint remembers the last range that was begun and whether it was
finished: a run that was stopped or failed goes on there, with the same range if it was unfinished.
"""

from __future__ import annotations

import json
import sys
from bisect import bisect_right
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from salesflow.functions.cleaning import clean
from salesflow.operators.incremental import assign_batches, batch_bounds
from salesflow.plans.jobs import BATCH_ROWS, load_star
from salesflow.schemas import CLEANED, STAGING, STAR
from salesflow.sources.stores import ParquetStore

# The reader runs in a process of its own, which need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Offset = dict[str, int]


class _Ranges(SimpleDataSourceStreamReader):
    """Ranges between given ends. An offset is the last id that has been handed out."""

    def __init__(self, start: int, ends: list[int]):
        self._start = start
        self._ends = ends

    def initialOffset(self) -> Offset:
        return {"orderid": self._start}

    def read(self, start: Offset) -> tuple[Iterator[tuple], Offset]:
        """The next range, one at a time, so that each becomes a micro-batch."""
        place = bisect_right(self._ends, start["orderid"])
        if place == len(self._ends):
            return iter([]), start
        end = {"orderid": self._ends[place]}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: Offset, end: Offset) -> Iterator[tuple]:
        return iter([(start["orderid"], end["orderid"])])


class IdRanges(DataSource):
    """The format `id_ranges`: options `start` and `ends`, the latter a JSON list of ascending ids."""

    @classmethod
    def name(cls) -> str:
        return "id_ranges"

    def schema(self) -> str:
        return "after_id int, last_id int"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Ranges(int(self.options["start"]), json.loads(self.options["ends"]))


def planned_ends(staging: ParquetStore, watermark: int, batch_rows: int) -> list[int]:
    """The last ids of the pending batches, one number for each; see `assign_batches`."""
    bounds = batch_bounds(assign_batches(staging.rows_after(STAGING, watermark), watermark, batch_rows))
    return [r["last_orderid"] for r in bounds.orderBy("batch_no").select("last_orderid").toLocalIterator()]


def start_loop(
    staging: ParquetStore, production, checkpoint: str, start: int, ends: list[int]
) -> StreamingQuery:
    """A running stream that cleans and loads the ranges up to each end, one micro-batch for each.

    `start` counts at the first start only; later the checkpoint knows better. A repeated micro-batch
    rewrites its own part of the cleaned table, and the star takes unseen keys only.
    """
    staging.require(STAGING, CLEANED)
    production.require(*STAR)
    spark = staging.spark
    spark.dataSource.register(IdRanges)
    ranges = spark.readStream.format("id_ranges").options(start=start, ends=json.dumps(ends)).load()

    def load(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        for after_id, last_id in batch.collect():  # one row
            rows = clean(staging.rows_between(STAGING, after_id, last_id))
            stored = staging.replace_part(rows, CLEANED, f"loop-{stream}-{batch_id}")
            load_star(stored, production, after_id + 1, last_id)

    return ranges.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).start()


def run_loop(
    staging: ParquetStore,
    production,
    checkpoint: str,
    batch_rows: int = BATCH_ROWS,
    batches: int | None = None,
) -> None:
    """Clean and load batch after batch until no new rows are left, or for so many batches only.

    Batches are those of `run_to_completion`. The next run with the same checkpoint goes on where this
    one has ended, wherever that was. Ids are ends of ranges, so an id that arrives later and is
    smaller than the offset is skipped, as by the other watermark jobs. The staging area must be a
    folder, because a repeated batch rewrites its part.
    """
    if not isinstance(staging, ParquetStore):
        raise TypeError("a loop with a checkpoint needs a staging area in a folder")
    staging.require(STAGING, CLEANED)
    cleaned_to = staging.largest_id(CLEANED)
    ends = planned_ends(staging, cleaned_to, batch_rows)
    query = start_loop(staging, production, checkpoint, cleaned_to, ends[:batches])
    try:
        query.processAllAvailable()
    finally:
        query.stop()
