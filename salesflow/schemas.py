"""Table definitions: column types, keys, NOT NULL columns and maximum text lengths."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

_SPARK_TYPES = {"int": T.IntegerType(), "date": T.DateType(), "varchar": T.StringType()}


class Column(NamedTuple):
    name: str
    kind: str
    length: int | None = None
    required: bool = False

    @property
    def ddl(self) -> str:
        kind = f"VARCHAR({self.length})" if self.kind == "varchar" else self.kind.upper()
        return f"`{self.name}` {kind}" + (" NOT NULL" if self.required else "")


class Table(NamedTuple):
    name: str
    columns: tuple[Column, ...]
    key: str | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def attributes(self) -> list[str]:
        return [c.name for c in self.columns if c.name != self.key]

    @property
    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, _SPARK_TYPES[c.kind], not c.required) for c in self.columns]
        )

    @property
    def ddl(self) -> str:
        return ", ".join(c.ddl for c in self.columns)

    @property
    def definition(self) -> str:
        """The table as a CREATE TABLE text for a database, with its primary key."""
        return self.definition_as(self.name) + ";"

    def definition_as(self, name: str) -> str:
        lines = [c.ddl.replace("`", "") for c in self.columns]
        if self.key:
            lines.append(f"PRIMARY KEY ({self.key})")
        listed = ",\n  ".join(lines)
        return f"CREATE TABLE {name} (\n  {listed}\n)"


# Table names, column names, types, lengths and keys of the data model.
_CALENDAR = (
    Column("date", "date"),
    Column("year", "int"),
    Column("quarter", "int"),
    Column("quartername", "varchar", 2),
    Column("month", "int"),
    Column("monthname", "varchar", 50),
    Column("day", "int"),
    Column("weekday", "int"),
    Column("weekdayname", "varchar", 50),
)
_CATEGORY = Column("category", "varchar", 50)
_COUNTRY = Column("country", "varchar", 50)
_STAGING_COLUMNS = (
    Column("orderid", "int"),
    Column("amount", "int"),
    Column("dateid", "int"),
    Column("countryid", "int"),
    Column("categoryid", "int"),
    *_CALENDAR,
    _CATEGORY,
    _COUNTRY,
)

STAGING = Table("sales_staging", _STAGING_COLUMNS)
CLEANED = Table("sales_staging_cleaned", _STAGING_COLUMNS)
DIM_DATE = Table("dim_date", (Column("dateid", "int", required=True), *_CALENDAR), "dateid")
DIM_CATEGORY = Table(
    "dim_category", (Column("categoryid", "int", required=True), _CATEGORY), "categoryid"
)
DIM_COUNTRY = Table(
    "dim_country", (Column("countryid", "int", required=True), _COUNTRY), "countryid"
)
FACT = Table(
    "fact_orders",
    (
        Column("orderid", "int", required=True),
        Column("dateid", "int"),
        Column("countryid", "int"),
        Column("categoryid", "int"),
        Column("amount", "int"),
    ),
    "orderid",
)
# No declared columns: this table takes the columns of whatever overwrites it.
RESULT = Table("clustering_result", ())
RESULT_COLUMNS = ["orderid", "countryid", "amount", "cluster"]

DIMENSIONS = (DIM_DATE, DIM_CATEGORY, DIM_COUNTRY)
STAGING_AREA = (STAGING, CLEANED)
STAR = (*DIMENSIONS, FACT)
