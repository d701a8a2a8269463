"""Jobs over stored tables: resuming, repeating, repairing, finishing."""

import pytest
from pyspark.errors import PySparkException

from salesflow.operators.star import dimension_of, dimension_rows, seen_attributes
from salesflow.plans import jobs
from salesflow.plans.jobs import (
    JobResult,
    clean_missing,
    clean_next_batch,
    load_backlog,
    load_star,
    repair_star,
    run_to_completion,
    transfer_next_batch,
)
from salesflow.schemas import CLEANED, DIM_COUNTRY, DIMENSIONS, FACT, STAGING, STAR
from salesflow.sources.sample import raw_sales
from salesflow.sources.stores import CatalogStore, MissingTable, ParquetStore, RepeatedKey
from tests.rows import FILLED, ids_of, raw_rows, sales

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    made = ParquetStore(spark, str(tmp_path / "tables"))
    made.create_staging_area()
    made.create_star()
    return made


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_batches_resume_after_the_last_id(spark, store):
    store.append(sales(spark, range(-1, 8)), STAGING)
    assert clean_next_batch(store, 3) == JobResult(3, 0, False)
    assert ids_of(store.read(CLEANED)) == [1, 2, 3]
    assert clean_next_batch(store, 3) == JobResult(3, 3, False)
    assert transfer_next_batch(store, store, 4) == JobResult(4, 0, False)
    assert ids_of(store.read(FACT)) == [1, 2, 3, 4]
    assert clean_next_batch(store, 3) == JobResult(1, 6, False)
    assert clean_next_batch(store, 3) == JobResult(0, 7, True)
    assert transfer_next_batch(store, store, 4) == JobResult(3, 4, False)
    assert transfer_next_batch(store, store, 4) == JobResult(0, 7, True)
    assert ids_of(store.read(CLEANED)) == ids_of(store.read(FACT)) == [1, 2, 3, 4, 5, 6, 7]


def test_nothing_to_do_ends_the_loop(store):
    assert run_to_completion(store, store) == 0
    assert load_backlog(store, store) == JobResult(0, 0, True)
    assert store.read(FACT).isEmpty()


def test_batches_lose_no_copy(spark, store):
    store.append(sales(spark, [1, 2, 2, 3]), STAGING)
    assert run_to_completion(store, store, 2) == 2
    assert ids_of(store.read(CLEANED)) == [1, 2, 2, 3]
    assert ids_of(store.read(FACT)) == [1, 2, 3]


def test_single_batches_lose_no_copy(spark, store):
    store.append(sales(spark, [1, 2, 2, 2, 3]), STAGING)
    assert clean_next_batch(store, 2) == JobResult(4, 0, False)
    assert clean_next_batch(store, 2) == JobResult(1, 2, False)
    assert ids_of(store.read(CLEANED)) == [1, 2, 2, 2, 3]
    assert transfer_next_batch(store, store, 3) == JobResult(4, 0, False)
    assert ids_of(store.read(FACT)) == [1, 2]


def test_ranges_take_rows_that_were_only_cleaned(spark, store):
    store.append(sales(spark, range(1, 9)), STAGING)
    clean_next_batch(store, 3)
    assert run_to_completion(store, store, 5) == 2
    assert ids_of(store.read(FACT)) == list(range(1, 9))
    store.append(sales(spark, [9]), STAGING)
    clean_next_batch(store, 3)
    assert run_to_completion(store, store, 5) == 1
    assert run_to_completion(store, store, 5) == 0
    assert ids_of(store.read(FACT)) == list(range(1, 10))


def test_late_smaller_id_is_skipped(spark, store):
    store.append(sales(spark, range(10, 21)), STAGING)
    run_to_completion(store, store)
    store.append(sales(spark, [5]), STAGING)
    assert run_to_completion(store, store) == 0
    assert ids_of(store.read(FACT)) == list(range(10, 21))


@pytest.mark.parametrize("batch_rows", [1, 10])
def test_first_attributes_of_a_dimension_key_stay(spark, store, batch_rows):
    store.append(sales(spark, [1], country="Siam"), STAGING)
    store.append(sales(spark, [2], country="Thailand"), STAGING)
    run_to_completion(store, store, batch_rows)
    assert [tuple(r) for r in store.read(DIM_COUNTRY).collect()] == [(1, "Siam")]


def test_null_dimension_key_is_not_loaded(spark, store):
    rows = [{**FILLED, "orderid": 1, "dateid": None}, {**FILLED, "orderid": 2}]
    store.append(raw_rows(spark, rows), STAGING)
    run_to_completion(store, store, 1)
    assert [r["dateid"] for r in store.read(DIMENSIONS[0]).collect()] == [1]
    assert ids_of(store.read(FACT)) == [1, 2]


def test_gaps_below_the_watermark_are_repaired(spark, store):
    store.append(sales(spark, [*range(1, 21), 4]), CLEANED)
    kept = [3, *range(6, 21)]
    store.append(sales(spark, kept).select(*FACT.names), FACT)
    assert transfer_next_batch(store, store).done
    assert repair_star(store, store, above=4) == 1
    assert ids_of(store.read(FACT)) == [3, *range(5, 21)]
    assert repair_star(store, store) == 3
    assert ids_of(store.read(FACT)) == list(range(1, 21))
    assert repair_star(store, store) == 0


def test_skipped_rows_are_cleaned_on_request(spark, store):
    store.append(sales(spark, [-1, 0, None, *range(1, 13), 4, 12]), STAGING)
    store.append(sales(spark, [1, 5, 6, 10]), CLEANED)
    assert clean_missing(store) == 6
    assert ids_of(store.read(CLEANED)) == [1, 2, 3, 4, 4, 5, 6, 7, 8, 9, 10]
    assert clean_missing(store) == 0
    run_to_completion(store, store)
    assert ids_of(store.read(FACT)) == list(range(1, 13))
    store.append(sales(spark, [20]), STAGING)
    run_to_completion(store, store)
    store.append(sales(spark, [15]), STAGING)  # arrives late
    assert clean_missing(store) == 1
    run_to_completion(store, store)
    assert ids_of(store.read(FACT)) == [*range(1, 13), 15, 20]


def test_repeating_a_load_changes_nothing(spark, store):
    rows = sales(spark, [1, 1, 2, 3])
    for _ in range(2):
        load_star(rows, store, 1, 3)
    assert ids_of(store.read(FACT)) == [1, 2, 3]
    assert [store.read(d).count() for d in DIMENSIONS] == [1, 1, 1]


def test_load_interrupted_before_the_fact_is_completed(spark, store, monkeypatch):
    rows = sales(spark, [1, 2])
    add = ParquetStore._add

    def failing(self, df, table):
        if table is FACT:
            raise OSError("disk full")
        add(self, df, table)

    monkeypatch.setattr(ParquetStore, "_add", failing)
    with pytest.raises(OSError):
        load_star(rows, store, 1, 2)
    monkeypatch.undo()
    load_star(rows, store, 1, 2)
    assert ids_of(store.read(FACT)) == [1, 2]
    assert store.read(DIM_COUNTRY).count() == 1


def test_star_tables_refuse_repeated_keys(spark, store):
    facts = sales(spark, [1, 2]).select(*FACT.names)
    store.append(facts, FACT)
    for wrong in ([2, 3], [4, 4]):
        with pytest.raises(RepeatedKey, match="fact_orders.orderid"):
            store.append(sales(spark, wrong).select(*FACT.names), FACT)
    store.append(sales(spark, [3]).select(*FACT.names), FACT)
    assert ids_of(store.read(FACT)) == [1, 2, 3]


def test_dimensions_of_one_pass_are_those_of_three(spark):
    rows = raw_sales(spark, DATA)
    odd = [{**FILLED, "orderid": i, "category": c, "categoryid": k} for i, c, k in
           [(-3, None, 9), (-2, "x", 9), (-1, "x", None), (None, "y", 10)]]
    rows = rows.unionByName(raw_rows(spark, odd))
    seen = seen_attributes(rows)
    for dim in DIMENSIONS:
        assert same(dimension_of(seen, dim), dimension_rows(rows, dim)), dim.name


def test_missing_tables_are_an_error(spark, tmp_path):
    empty = ParquetStore(spark, str(tmp_path / "nothing"))
    with pytest.raises(MissingTable, match="sales_staging"):
        clean_next_batch(empty)
    empty.create([STAGING])
    with pytest.raises(MissingTable, match="sales_staging_cleaned"):
        clean_next_batch(empty)
    with pytest.raises(MissingTable, match="sales_staging_cleaned"):
        transfer_next_batch(empty, empty)
    empty.create([CLEANED])
    with pytest.raises(MissingTable, match="fact_orders"):
        transfer_next_batch(empty, empty)


def test_too_long_text_fails_the_batch(spark, store):
    store.spark.createDataFrame(
        sales(spark, [1], quartername="", quarter=12345).collect(), STAGING.struct
    ).write.mode("append").parquet(store.path(STAGING))
    with pytest.raises(PySparkException, match="quartername is longer than 2"):
        clean_next_batch(store)
    assert store.read(CLEANED).isEmpty()


def one_by_one(store, rows):
    while not clean_next_batch(store, rows).done:
        pass
    while not transfer_next_batch(store, store, rows).done:
        pass


def tables_after(store, load):
    load(store)
    return {t.name: store.read(t) for t in (CLEANED, *STAR)}


def test_all_ways_of_loading_agree(spark, tmp_path):
    raw = raw_sales(spark, DATA)
    loads = {
        "rows": lambda s: one_by_one(s, 400),
        "ranges": lambda s: run_to_completion(s, s, 400),
        "backlog": lambda s: load_backlog(s, s),
    }
    results = {}
    for name, load in loads.items():
        made = ParquetStore(spark, str(tmp_path / name))
        made.create_staging_area()
        made.create_star()
        made.append(raw, STAGING)
        results[name] = tables_after(made, load)
    for name in ("ranges", "backlog"):
        for table, df in results["rows"].items():
            assert same(df, results[name][table]), (name, table)


def test_two_databases_in_the_catalog(spark):
    staging = CatalogStore(spark, "staging_area", buckets=4)
    production = CatalogStore(spark, "production", buckets=4)
    assert not staging.exists(STAGING)
    staging.create_staging_area()
    production.create_star()
    assert staging.exists(STAGING) and not staging.exists(FACT)
    staging.append(sales(spark, range(0, 12)), STAGING)
    assert run_to_completion(staging, production, 5) == 3
    assert ids_of(production.read(FACT)) == list(range(1, 12))
    assert production.read(DIM_COUNTRY).count() == 1
    with pytest.raises(PySparkException):
        staging.append(sales(spark, [99], quartername="Q10"), STAGING)


def test_bucketed_facts_are_compared_without_shuffling_them(spark, capsys):
    store = CatalogStore(spark, "bucketed", buckets=8)  # the session's shuffle partitions
    store.create_staging_area()
    store.create_star()
    store.append(sales(spark, range(1, 50)), CLEANED)
    store.append(sales(spark, range(1, 20)).select(*FACT.names), FACT)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fresh = jobs.new_rows(
            jobs.fact_rows(store.read(CLEANED)), store.read(FACT), FACT.key
        )
        fresh.explain()
        assert ids_of(fresh) == list(range(20, 50))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1  # the new rows, once
    assert "Bucketed: true" in plan
