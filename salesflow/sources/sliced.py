"""Parquet tables cut into slices, so that a range of ids is a few folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.operators.checks import enforced
from salesflow.operators.incremental import ID, IdCounts, after, between, high_watermark
from salesflow.schemas import Table
from salesflow.sources.files import names_in
from salesflow.sources.stores import ParquetStore

# Ids of a slice, as a power of two: about a million, hence at most 4,096 slices of positive ids.
SLICE_BITS = 20


class SlicedTable:
    """A folder per value of the integer column `slice`, below a path that all executors share.

    `columns` is a schema such as "word int, bits long"; the slice is added to it. A reader of some
    slices lists and reads their folders only.
    """

    def __init__(self, spark: SparkSession, path: str, columns: str):
        self.spark = spark
        self.path = path
        self._schema = f"{columns}, slice int"

    def exists(self) -> bool:
        return "_SUCCESS" in names_in(self.spark, self.path)

    def create(self) -> None:
        """Make the table if it is not there; its rows stay if it is."""
        columns = [c.split() for c in self._schema.split(", ")]
        nothing = self.spark.range(0, 0, 1, 1).select(
            *(F.lit(None).cast(kind).alias(name) for name, kind in columns)
        )
        nothing.write.mode("append").partitionBy("slice").parquet(self.path)

    def read(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """All rows, or those of the slices from `first` to `last`."""
        rows = self.spark.read.schema(self._schema).parquet(self.path)
        if first is not None:
            rows = rows.filter(F.col("slice").between(first, last))
        return rows

    def replace(self, rows: DataFrame) -> None:
        """Put rows in place of all rows of the slices that they are in; other slices stay.

        Repeating it after a failure gives the same table. A slice cannot be emptied this way.
        """
        names = [n.split()[0] for n in self._schema.split(", ")]
        dealt = rows.select(*names).hint("rebalance", "slice")  # few files for each slice, not one per task
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("slice").parquet(self.path)


class SlicedStore(ParquetStore):
    """Folders whose tables with an order id are partitioned by slices of ids.

    Rows lie in `slice=N/part=NAME`. Batches, watermarks, repairs and fact lookups name an id range, which
    becomes a filter on the slice: other folders are not even listed for reading. Rows without an id
    are in the slice of NULL. The slice is a column of the files' folders only, never of a table.
    """

    def __init__(self, spark: SparkSession, root: str, slice_bits: int = SLICE_BITS):
        super().__init__(spark, root)
        self._bits = slice_bits

    def _is_sliced(self, table: Table) -> bool:
        return ID in table.names

    def _schema(self, table: Table) -> T.StructType:
        return T.StructType([*table.struct, T.StructField("slice", T.IntegerType()), T.StructField("part", T.StringType())])

    def _all(self, table: Table) -> DataFrame:
        self.require(table)
        return self.spark.read.schema(self._schema(table)).parquet(self.path(table))

    def _slices(self, table: Table) -> list[int]:
        """The numbers of the slices that are there, by the names of their folders."""
        numbers = (n.removeprefix("slice=") for n in names_in(self.spark, self.path(table)))
        return [int(n) for n in numbers if n.lstrip("-").isdigit()]

    def _some(self, table: Table, first: int, last: int | None = None) -> DataFrame:
        """The rows of the slices from `first` on, or up to `last`; no other folder is looked into."""
        self.require(table)
        asked = F.col("slice") >= first if last is None else F.col("slice").between(first, last)
        numbers = (n for n in self._slices(table) if first <= n and (last is None or n <= last))
        folders = [f"{self.path(table)}/slice={n}" for n in numbers]
        reader = self.spark.read.schema(self._schema(table)).option("basePath", self.path(table))
        found = reader.parquet(*folders) if folders else self.spark.createDataFrame([], self._schema(table))
        return found.filter(asked)

    def exists(self, table: Table) -> bool:
        return "_SUCCESS" in names_in(self.spark, self.path(table)) if self._is_sliced(table) else super().exists(table)

    def create(self, tables: Iterable[Table]) -> None:
        for table in tables:
            if not self._is_sliced(table):
                super().create([table])
            elif not self.exists(table):
                nothing = self.spark.range(0, 0, 1, 1)
                empty = nothing.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in table.struct))
                self._write(empty, table, "none", "append")

    def read(self, table: Table) -> DataFrame:
        return self._all(table).select(*table.names) if self._is_sliced(table) else super().read(table)

    def _slice_of(self, order_id: int) -> int:
        return order_id >> self._bits

    def rows_after(self, table: Table, after_id: int) -> DataFrame:
        if not self._is_sliced(table):
            return super().rows_after(table, after_id)
        rows = self._some(table, self._slice_of(after_id + 1))
        return after(rows, after_id).select(*table.names)

    def rows_between(self, table: Table, after_id: int, last_id: int) -> DataFrame:
        if not self._is_sliced(table):
            return super().rows_between(table, after_id, last_id)
        rows = self._some(table, self._slice_of(after_id + 1), self._slice_of(last_id))
        return between(rows, after_id, last_id).select(*table.names)

    def largest_id(self, table: Table, known: int = 0) -> int:
        """Read from the last slice alone, whose number the folders tell."""
        self.require(table)
        last = max(self._slices(table), default=None)
        if last is None or last < self._slice_of(known):
            return known
        rows = self._some(table, last, last)
        return max(known, high_watermark(after(rows, known)).first()["max_orderid"])

    def id_counts(self, table: Table) -> IdCounts:
        return _SlicedIdCounts(self, table)

    def _write(self, df: DataFrame, table: Table, part: str, mode: str) -> None:
        rows = enforced(df, table).withColumns(
            {"slice": F.shiftright(ID, self._bits), "part": F.lit(part)}
        )
        # Rows of a slice come together for few files; what one slice has too many of is split.
        dealt = rows.hint("rebalance", "slice")
        writer = dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("slice", "part").parquet(self.path(table))

    def _add(self, df: DataFrame, table: Table) -> None:
        if self._is_sliced(table):
            self._write(df, table, uuid.uuid4().hex, "append")
        else:
            super()._add(df, table)

    def append_range(self, df: DataFrame, table: Table, after_id: int, last_id: int) -> DataFrame:
        """The rows become a part of their own, which is read back from the slices of the range."""
        if not self._is_sliced(table):
            return super().append_range(df, table, after_id, last_id)
        part = f"ids-{after_id}-{last_id}-{uuid.uuid4().hex[:8]}"
        self._write(df, table, part, "overwrite")
        rows = self._some(table, self._slice_of(after_id + 1), self._slice_of(last_id))
        return rows.filter(F.col("part") == part).select(*table.names)

    def overwrite(self, df: DataFrame, table: Table) -> None:
        if self._is_sliced(table):
            raise TypeError(f"{table.name} is kept in slices and only grows")
        super().overwrite(df, table)

    def replace_part(self, df: DataFrame, table: Table, part: str) -> DataFrame:
        """A part lies in every slice that it has ids of; a repeated attempt has the same ids."""
        if not self._is_sliced(table):
            return super().replace_part(df, table, part)
        self._write(df, table, part, "overwrite")
        return self._all(table).filter(F.col("part") == part).select(*table.names)


class _SlicedIdCounts(IdCounts):
    def __init__(self, store: SlicedStore, table: Table):
        self._store, self._table = store, table

    def by_bucket(self, watermark: int) -> DataFrame:
        return IdCounts(self._store.rows_after(self._table, watermark)).by_bucket(watermark)

    def by_id(self, first: int, last: int) -> DataFrame:
        return IdCounts(self._store.rows_between(self._table, first - 1, last)).by_id(first, last)
