"""Bitmaps and sums kept beside the facts: exact after loads, repeats, repairs and lost writes."""

import pytest
from pyspark.sql import functions as F

from salesflow.operators import star
from salesflow.operators.incremental import id_words, ids_of_words, lacking
from salesflow.plans import jobs
from salesflow.plans.summaries import FactSummaries, keep_summaries
from salesflow.schemas import CLEANED, DIM_COUNTRY, DIM_DATE, FACT, STAGING
from salesflow.sources.sliced import SlicedTable
from salesflow.sources.stores import ParquetStore
from tests.rows import FILLED, ids_of, raw_rows, sales

EDGES = [-(2**31), -65, -64, -63, -1, 0, 1, 62, 63, 64, 65, 2**20 - 1, 2**20, 2**31 - 1]


@pytest.fixture
def store(spark, tmp_path):
    made = ParquetStore(spark, str(tmp_path / "tables"))
    made.create_staging_area()
    made.create_star()
    return made


def varied(spark, ids):
    rows = [
        {**FILLED, "orderid": i, "countryid": i % 3, "country": f"C{i % 3}", "dateid": i % 5, "year": 1995 + i % 2, "amount": i}
        for i in ids
    ]
    return raw_rows(spark, rows)


def sums(df):
    return sorted(map(tuple, df.collect()))


def exact(store):
    fact, dates, countries = (store.read(t) for t in (FACT, DIM_DATE, DIM_COUNTRY))
    return sums(star.sales_by_country_quarter(fact, dates, countries))


def test_bitmaps_give_back_their_ids(spark):
    words = id_words(sales(spark, [*EDGES, *EDGES, None]))
    assert ids_of(ids_of_words(words)) == EDGES
    assert words.count() == len({i >> 6 for i in EDGES})


def test_lacking_ids_at_the_edges_of_words(spark):
    for held in (EDGES[::2], EDGES[1::2], [], EDGES):
        found = lacking(id_words(sales(spark, EDGES)), id_words(sales(spark, held)))
        assert ids_of(found) == sorted(set(EDGES) - set(held))


def test_slices_are_replaced_whole(spark, tmp_path):
    table = SlicedTable(spark, str(tmp_path / "sliced"), "n int")
    table.create()
    assert table.read().isEmpty()
    table.replace(spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "n int, slice int"))
    table.replace(spark.createDataFrame([(9, 1)], "n int, slice int"))
    table.create()
    assert sums(table.read()) == [(1, 0), (2, 0), (9, 1)]
    assert sums(table.read(1, 1)) == [(9, 1)]


def test_reading_a_range_lists_its_slices_only(spark, tmp_path, capsys):
    table = SlicedTable(spark, str(tmp_path / "sliced"), "n int")
    table.replace(spark.range(8).select(F.col("id").cast("int").alias("n"), F.col("id").cast("int").alias("slice")))
    table.read(2, 3).explain()
    assert "PartitionFilters: [isnotnull(slice" in capsys.readouterr().out
    assert len(table.read(2, 3).inputFiles()) <= 8 and table.read(2, 3).count() == 2


@pytest.mark.parametrize("slice_bits", [6, 8, 20])
def test_loads_keep_the_sums(spark, store, slice_bits):
    summaries = keep_summaries(store, slice_bits)
    store.append(varied(spark, range(1, 600)), STAGING)
    assert summaries.sales_by_country_quarter().isEmpty()
    for _ in range(4):
        jobs.clean_next_batch(store, 150)
        jobs.transfer_next_batch(store, store, 150)
        assert sums(summaries.sales_by_country_quarter()) == exact(store)
    jobs.load_star(store.read(CLEANED).filter("orderid < 300"), store, 1, 299)  # nothing new
    assert sums(summaries.sales_by_country_quarter()) == exact(store)
    assert sum(r["orders"] for r in summaries.sales_by_country_quarter().collect()) == 599


def test_summaries_of_a_full_star(spark, store):
    store.append(varied(spark, range(1, 40)), STAGING)
    jobs.run_to_completion(store, store, 13)
    summaries = keep_summaries(store)
    assert sums(summaries.sales_by_country_quarter()) == exact(store)
    again = keep_summaries(store)
    assert sums(again.sales_by_country_quarter()) == exact(store)


def test_repair_finds_gaps_by_the_bitmaps(spark, store, monkeypatch):
    summaries = keep_summaries(store, 6)
    store.append(varied(spark, range(1, 500)), CLEANED)
    rows = store.read(CLEANED)
    jobs.load_star(rows.filter("orderid % 7 <> 0 and not orderid between 200 and 300"), store, 1, 499)
    gaps = [i for i in range(1, 500) if i % 7 == 0 or 200 <= i <= 300]
    assert ids_of(summaries.missing(rows, 0, 499)) == gaps
    assert ids_of(summaries.missing(rows, 250, 260)) == list(range(251, 261))
    assert jobs.repair_star(store, store) == len(gaps)
    assert ids_of(store.read(FACT)) == list(range(1, 500))
    assert sums(summaries.sales_by_country_quarter()) == exact(store)
    assert jobs.repair_star(store, store) == 0


def test_missing_does_not_read_the_facts(spark, store):
    summaries = keep_summaries(store)
    store.append(varied(spark, range(1, 50)), CLEANED)
    jobs.load_star(store.read(CLEANED), store, 1, 49)
    folders = {f.split("/tables/")[1].split("/")[0] for f in summaries.missing(store.read(CLEANED), 0, 49).inputFiles()}
    assert folders == {"fact_order_ids", CLEANED.name}


@pytest.mark.parametrize("lost", ["_totals", "_ids"])
def test_a_write_that_failed_is_made_good_by_repair(spark, store, monkeypatch, lost):
    summaries = keep_summaries(store)
    store.append(varied(spark, range(1, 30)), CLEANED)
    replace = SlicedTable.replace

    def failing(self, rows):
        if self is getattr(summaries, lost):
            raise OSError("lost")
        replace(self, rows)

    monkeypatch.setattr(SlicedTable, "replace", failing)
    with pytest.raises(OSError, match="lost"):
        jobs.transfer_next_batch(store, store, 10)
    monkeypatch.undo()
    assert ids_of(store.read(FACT)) == list(range(1, 11))
    jobs.repair_star(store, store)
    assert sums(summaries.sales_by_country_quarter()) == exact(store)
    assert ids_of(store.read(FACT)) == list(range(1, 11))


def test_a_star_must_be_there(spark, tmp_path):
    with pytest.raises(LookupError):
        keep_summaries(ParquetStore(spark, str(tmp_path / "none")))
    assert FactSummaries(ParquetStore(spark, str(tmp_path)))._slices(2**20 - 1, 2**20) == (1, 1)
