"""Tables at rest: Parquet folders, catalog tables and JDBC databases with the same methods.

A store offers exists, create, read, append and overwrite, and what batches need: the largest id,
counts per id, and rows of an id range written and read back. Only "there is no such table" makes
`exists` false; any other failure is raised.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.operators.checks import duplicate_keys, enforced
from salesflow.operators.incremental import (
    ID,
    IdCounts,
    after,
    between,
    high_watermark,
    missing_ids,
)
from salesflow.schemas import FACT, STAGING_AREA, STAR, Table
from salesflow.sources.publication import current_folder, forget_versions, publish


class MissingTable(LookupError):
    """A table that a job needs has not been created."""


class RepeatedKey(ValueError):
    """Rows to be appended have a key that is there already, or have it more than once."""


class _Store:
    spark: SparkSession
    # Tables derived from the facts, if they are kept; see `plans.summaries`.
    summaries = None

    def exists(self, table: Table) -> bool:
        raise NotImplementedError

    def require(self, *tables: Table) -> None:
        missing = [t.name for t in tables if not self.exists(t)]
        if missing:
            raise MissingTable(f"create these tables first: {', '.join(missing)}")

    def create_staging_area(self) -> None:
        self.create(STAGING_AREA)

    def create_star(self) -> None:
        self.create(STAR)

    def create(self, tables: Iterable[Table]) -> None:
        raise NotImplementedError

    def read(self, table: Table) -> DataFrame:
        raise NotImplementedError

    def _add(self, df: DataFrame, table: Table) -> None:
        raise NotImplementedError

    def append(self, df: DataFrame, table: Table, keys_are_new: bool = False) -> None:
        """Add rows. A table with a key refuses rows that repeat one.

        `keys_are_new` skips that look at the keys for rows that are unique and new by construction,
        such as those of an anti join.
        """
        if table.key and not keys_are_new:
            keys = self.read(table).select(table.key).unionByName(df.select(table.key))
            # A repeated key that is stored already is no fault of these rows.
            repeated = duplicate_keys(keys, table.key).join(
                df.select(table.key), table.key, "left_semi"
            )
            if not repeated.isEmpty():
                raise RepeatedKey(f"{table.name}.{table.key} would not be unique")
        self._add(df, table)

    def append_range(self, df: DataFrame, table: Table, after_id: int, last_id: int) -> DataFrame:
        """Append rows whose ids lie in a range; returns the stored rows of that range."""
        self.append(df, table)
        return self.rows_between(table, after_id, last_id)

    def rows_after(self, table: Table, after_id: int) -> DataFrame:
        """Rows with ids beyond one."""
        return after(self.read(table), after_id)

    def rows_between(self, table: Table, after_id: int, last_id: int) -> DataFrame:
        """Rows with ids beyond one, up to another one."""
        return between(self.read(table), after_id, last_id)

    def largest_id(self, table: Table, known: int = 0) -> int:
        """The largest id beyond one that is known to be there, or that one."""
        found = high_watermark(self.rows_after(table, known)).first()["max_orderid"]
        return max(known, found)

    def id_counts(self, table: Table) -> IdCounts:
        return IdCounts(self.read(table))

    def facts_changed(self, after_id: int, last_id: int) -> None:
        """To be called when facts with ids of a range have been added."""
        if self.summaries:
            self.summaries.refresh(after_id, last_id)

    def missing_facts(self, rows: DataFrame, after_id: int, last_id: int) -> DataFrame:
        """Ids of rows in a range that the fact table lacks."""
        if self.summaries:
            return self.summaries.missing(rows, after_id, last_id)
        fact = self.rows_between(FACT, after_id, last_id)
        return missing_ids(between(rows, after_id, last_id), fact)


def _no_rows(spark: SparkSession, table: Table) -> DataFrame:
    """An empty table of the declared types, made by a plan without any data."""
    nothing = spark.range(0, 0, 1, 1)
    return nothing.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in table.struct))


class ParquetStore(_Store):
    """One folder per table below a root that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def exists(self, table: Table) -> bool:
        try:
            self._load(table)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def create(self, tables: Iterable[Table]) -> None:
        missing = [table for table in tables if not self.exists(table)]
        if not missing:
            return

        @inheritable_thread_target(self.spark)
        def write(table: Table) -> None:
            _no_rows(self.spark, table).write.parquet(self.path(table))

        # Jobs without rows: side by side they take as long as one.
        with ThreadPoolExecutor(len(missing)) as pool:
            list(pool.map(write, missing))

    def _load(self, table: Table) -> DataFrame:
        # Batches of a stream lie in subfolders of their table; see `replace_part`.
        reader = self.spark.read.option("recursiveFileLookup", True)
        if table.columns:
            reader = reader.schema(table.struct)
        return reader.parquet(self._place(table))

    def _place(self, table: Table) -> str:
        return current_folder(self.spark, self.path(table))

    def read(self, table: Table) -> DataFrame:
        self.require(table)
        return self._load(table)

    def _add(self, df: DataFrame, table: Table) -> None:
        enforced(df, table).write.mode("append").parquet(self._place(table))

    def append_range(self, df: DataFrame, table: Table, after_id: int, last_id: int) -> DataFrame:
        """The rows become a part of their own, which is read back without listing the others."""
        return self.replace_part(df, table, f"ids-{after_id}-{last_id}-{uuid.uuid4().hex[:8]}")

    def overwrite(self, df: DataFrame, table: Table) -> None:
        """Publish rows as the next version of a table: readers see all of them or the older ones.

        Fails with `ChangedMeanwhile` if somebody else has overwritten the table since. Older versions
        stay until `forget_versions`, so a reader that has begun can finish.
        """
        publish(df, self.path(table))

    def forget_versions(self, table: Table, keep: int = 1) -> int:
        return forget_versions(self.spark, self.path(table), keep)

    def replace_part(self, df: DataFrame, table: Table, part: str) -> DataFrame:
        """Write one named part of a table, replacing an earlier attempt; returns it as stored."""
        folder = f"{self._place(table)}/{part}"
        enforced(df, table).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(table.struct).parquet(folder)


class CatalogStore(_Store):
    """Managed Parquet tables of a catalog database; the engine itself checks text lengths.

    With `buckets`, the fact table is bucketed by its key. If their number equals
    `spark.sql.shuffle.partitions`, comparing ids with it shuffles new rows only. Its keys are
    unique, hence the buckets are even; the staging tables may repeat an id any number of times
    and are not bucketed.
    """

    def __init__(self, spark: SparkSession, database: str, buckets: int | None = None):
        self.spark = spark
        self.database = database
        self.buckets = buckets

    def name(self, table: Table) -> str:
        return f"{self.database}.{table.name}"

    def exists(self, table: Table) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def _bucketed(self, table: Table) -> bool:
        return self.buckets is not None and table == FACT

    def create(self, tables: Iterable[Table]) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        for table in tables:
            bucketed = (
                f" CLUSTERED BY ({table.key}) INTO {self.buckets} BUCKETS"
                if self._bucketed(table)
                else ""
            )
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({table.ddl})"
                f" USING parquet{bucketed}"
            )

    def read(self, table: Table) -> DataFrame:
        self.require(table)
        return self.spark.table(self.name(table))

    def _add(self, df: DataFrame, table: Table) -> None:
        rows = enforced(df, table)
        if self._bucketed(table):
            rows = rows.repartition(self.buckets, table.key)  # one file per bucket
        rows.write.insertInto(self.name(table))

    def overwrite(self, df: DataFrame, table: Table) -> None:
        df.write.mode("overwrite").format("parquet").saveAsTable(self.name(table))


class JdbcStore(_Store):
    """Tables of a database that Spark reaches over JDBC.

    Tables with an order id are read as `partitions` parallel id ranges, and writes use at most
    as many connections.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict[str, str],
        schema: str = "public",
        partitions: int = 16,
    ):
        self.spark = spark
        self.url = url
        self.properties = properties
        self.schema = schema
        self.partitions = partitions

    def name(self, table: Table) -> str:
        return f"{self.schema}.{table.name}"

    def _query(self, text: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, f"({text}) q", properties=self.properties)

    def exists(self, table: Table) -> bool:
        listed = self._query("SELECT table_schema, table_name FROM information_schema.tables")
        found = (F.col("table_schema") == self.schema) & (F.col("table_name") == table.name)
        return not listed.filter(found).isEmpty()

    def create(self, tables: Iterable[Table]) -> None:
        """Create missing tables with their declared types, NOT NULL columns and primary keys.

        Spark's own writer cannot declare keys, so the definitions go to the database as they are.
        """
        for table in tables:
            if not self.exists(table):
                self._execute(table.definition_as(self.name(table)))

    def _execute(self, statement: str) -> None:
        """Run one statement on the driver, over a connection of the driver class that Spark uses."""
        jvm = self.spark._jvm
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        properties = jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.createStatement().execute(statement)
        finally:
            connection.close()

    def read(self, table: Table) -> DataFrame:
        self.require(table)
        if "orderid" not in table.names:
            return self.spark.read.jdbc(
                self.url, self.name(table), properties=self.properties
            )
        lowest, highest = self._query(
            f"SELECT min(orderid) AS lowest, max(orderid) AS highest FROM {self.name(table)}"
        ).first()
        return self.spark.read.jdbc(
            self.url,
            self.name(table),
            column="orderid",
            lowerBound=0 if lowest is None else lowest,
            upperBound=1 if highest is None else highest + 1,
            numPartitions=self.partitions,
            properties=self.properties,
        )

    def largest_id(self, table: Table, known: int = 0) -> int:
        self.require(table)
        found = self._query(
            f"SELECT max({ID}) AS max_orderid FROM {self.name(table)} WHERE {ID} > {known}"
        ).first()["max_orderid"]
        return known if found is None else found

    def id_counts(self, table: Table) -> IdCounts:
        self.require(table)
        return _SqlIdCounts(self, table)

    def _write(self, df: DataFrame, table: Table, mode: str) -> None:
        df.write.option("numPartitions", self.partitions).jdbc(
            self.url, self.name(table), mode=mode, properties=self.properties
        )

    def _add(self, df: DataFrame, table: Table) -> None:
        self._write(enforced(df, table), table, "append")

    def overwrite(self, df: DataFrame, table: Table) -> None:
        self._write(df, table, "overwrite")


class _SqlIdCounts(IdCounts):
    """Counts made by the database, so that no ids travel."""

    def __init__(self, store: JdbcStore, table: Table):
        self._store, self._name = store, store.name(table)

    def by_bucket(self, watermark: int) -> DataFrame:
        # Ids beyond a watermark are positive, so that a division rounds down.
        return self._store._query(
            f"SELECT {ID} / 65536 AS slot, count(*) AS rows FROM {self._name}"
            f" WHERE {ID} > {watermark} GROUP BY {ID} / 65536"
        )

    def by_id(self, first: int, last: int) -> DataFrame:
        return self._store._query(
            f"SELECT {ID} AS slot, count(*) AS rows FROM {self._name}"
            f" WHERE {ID} BETWEEN {first} AND {last} GROUP BY {ID}"
        )
