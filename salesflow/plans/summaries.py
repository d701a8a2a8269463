"""Tables derived from the facts and kept beside them: ids as bitmaps, and sums per country and day.

Both are cut into slices of order ids. After a load, the slices that its id range touches are made
anew from the fact table and replaced, so a repeated or repaired load cannot count anything twice. The
bitmaps are written last: as long as they lack ids of a load, a repair finds these ids, loads what is
missing and makes the slices again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.operators.incremental import ID, between, id_words, lacking
from salesflow.operators.star import key_totals, sales_of_totals
from salesflow.schemas import DIM_COUNTRY, DIM_DATE, FACT
from salesflow.sources.sliced import SLICE_BITS, SlicedTable
from salesflow.sources.stores import ParquetStore


class FactSummaries:
    """The derived tables of one star schema in a folder."""

    def __init__(self, production: ParquetStore, slice_bits: int = SLICE_BITS):
        self._production = production
        self._bits = slice_bits
        spark, root = production.spark, production.root
        self._ids = SlicedTable(spark, f"{root}/fact_order_ids", "word int, bits long")
        self._totals = SlicedTable(
            spark, f"{root}/fact_totals", "countryid int, dateid int, orders long, amount long"
        )

    def exists(self) -> bool:
        return self._ids.exists() and self._totals.exists()

    def create(self) -> None:
        """Make the tables and fill them from the facts that are there."""
        self._ids.create()
        self._totals.create()
        self._replace(self._production.read(FACT))

    def _slices(self, after_id: int, last_id: int) -> tuple[int, int]:
        return (after_id + 1) >> self._bits, last_id >> self._bits

    def _replace(self, fact: DataFrame) -> None:
        sliced = fact.withColumn("slice", F.shiftright(ID, self._bits))
        self._totals.replace(key_totals(sliced, "slice"))
        words = id_words(fact)  # a word never crosses a slice
        self._ids.replace(words.withColumn("slice", F.shiftright("word", self._bits - 6)))

    def refresh(self, after_id: int, last_id: int) -> None:
        """Bring the slices up to date that hold ids beyond `after_id` up to `last_id`."""
        first, last = self._slices(after_id, last_id)
        ids = (first << self._bits) - 1, ((last + 1) << self._bits) - 1
        self._replace(self._production.rows_between(FACT, *ids))

    def ids(self, after_id: int, last_id: int) -> DataFrame:
        """(word, bits) of the stored facts, for at least the ids of a range."""
        return self._ids.read(*self._slices(after_id, last_id)).select("word", "bits")

    def missing(self, rows: DataFrame, after_id: int, last_id: int) -> DataFrame:
        """Ids of rows in a range that no fact has, without reading the fact table."""
        return lacking(id_words(between(rows, after_id, last_id)), self.ids(after_id, last_id))

    def sales_by_country_quarter(self) -> DataFrame:
        """Orders and amount per country, year and quarter, from the sums of all slices."""
        stored = self._production
        return sales_of_totals(self._totals.read(), stored.read(DIM_DATE), stored.read(DIM_COUNTRY))


def keep_summaries(production: ParquetStore, slice_bits: int = SLICE_BITS) -> FactSummaries:
    """From now on, loads into this star schema keep its derived tables up to date."""
    production.require(FACT)
    summaries = FactSummaries(production, slice_bits)
    summaries.create()
    production.summaries = summaries
    return summaries


def attach_summaries(production: ParquetStore) -> None:
    """Go on keeping the derived tables up to date if an earlier session has made them."""
    summaries = FactSummaries(production)
    if summaries.exists():
        production.summaries = summaries
