"""Micro-batch loading: completeness, late ids, restarts and repeated batches."""

import shutil

import pytest

from salesflow.plans import registry
from salesflow.plans.jobs import load_backlog, run_to_completion
from salesflow.plans.summaries import keep_summaries
from salesflow.schemas import CLEANED, DIM_COUNTRY, FACT, STAGING, STAR
from salesflow.sources.files import names_in
from salesflow.sources.sample import raw_sales
from salesflow.sources.stores import CatalogStore, ParquetStore
from salesflow.streaming.ingest import ingest_files, ingest_new_ids
from salesflow.streaming.loop import _Ranges, run_loop
from tests.rows import ids_of, sales

DATA = "/root/testdata/sf0.001"


def made(spark, path):
    store = ParquetStore(spark, str(path))
    store.create_staging_area()
    store.create_star()
    return store


def run(store, state, **options):
    ingest_files(store, store, str(state), **options).awaitTermination()


def test_stream_equals_the_one_pass_load(spark, tmp_path):
    stream, batch = made(spark, tmp_path / "stream"), made(spark, tmp_path / "batch")
    raw = raw_sales(spark, DATA).repartition(6)
    for store in (stream, batch):
        store.append(raw, STAGING)
    run(stream, tmp_path / "state", max_files_per_trigger=2)
    load_backlog(batch, batch)
    for table in (CLEANED, *STAR):
        left, right = stream.read(table), batch.read(table)
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty(), table.name


def test_later_files_continue_and_late_ids_are_taken(spark, tmp_path):
    store, state = made(spark, tmp_path / "tables"), tmp_path / "state"
    store.append(sales(spark, [*range(10, 21), 0, -3, None]), STAGING)
    run(store, state)
    assert ids_of(store.read(FACT)) == list(range(10, 21))
    store.append(sales(spark, [5, 20, 21], country="Elsewhere"), STAGING)
    run(store, state)
    assert ids_of(store.read(FACT)) == [5, *range(10, 22)]
    assert ids_of(store.read(CLEANED)) == sorted([5, *range(10, 21), 20, 21])
    assert [r["country"] for r in store.read(DIM_COUNTRY).collect()] == ["Chile"]


def test_failed_batch_is_repeated_without_copies(spark, tmp_path, monkeypatch):
    store, state = made(spark, tmp_path / "tables"), tmp_path / "state"
    store.append(sales(spark, range(1, 9)), STAGING)
    add = ParquetStore._add

    def failing(self, df, table):
        add(self, df.filter("orderid < 4") if table is FACT else df, table)
        if table is FACT:
            raise OSError("lost after a partial write")

    monkeypatch.setattr(ParquetStore, "_add", failing)
    with pytest.raises(Exception, match="lost after a partial write"):
        run(store, state)
    monkeypatch.undo()
    assert ids_of(store.read(FACT)) == [1, 2, 3]
    run(store, state)
    assert ids_of(store.read(FACT)) == ids_of(store.read(CLEANED)) == list(range(1, 9))
    assert store.read(DIM_COUNTRY).count() == 1


def test_a_new_stream_at_an_old_place_keeps_earlier_parts(spark, tmp_path):
    store = made(spark, tmp_path / "tables")
    store.append(sales(spark, [1, 2]), STAGING)
    run(store, tmp_path / "state")
    shutil.move(tmp_path / "state", tmp_path / "old-state")
    store.append(sales(spark, [3]), STAGING)
    run(store, tmp_path / "state")
    assert ids_of(store.read(CLEANED)) == [1, 1, 2, 2, 3]
    assert ids_of(store.read(FACT)) == [1, 2, 3]


def test_staging_must_be_a_folder(spark, tmp_path):
    with pytest.raises(TypeError, match="in a folder"):
        ingest_files(CatalogStore(spark, "any"), None, str(tmp_path))


def run_new(store, state, **options):
    ingest_new_ids(store, store, str(state), **options).awaitTermination()


def test_state_tells_replayed_late_and_repeated_ids(spark, tmp_path):
    store, state = made(spark, tmp_path / "tables"), tmp_path / "state"
    store.append(sales(spark, [10, 11, 11, 12, 0, -3, None]), STAGING)
    run_new(store, state)
    store.append(sales(spark, [11, 12, 5], country="Elsewhere", amount=99), STAGING)
    store.append(sales(spark, [5, 13]), STAGING)
    run_new(store, state, max_files_per_trigger=1)
    run_new(store, state)
    assert ids_of(store.read(FACT)) == ids_of(store.read(CLEANED)) == [5, 10, 11, 12, 13]
    amounts = {r["orderid"]: r["amount"] for r in store.read(FACT).collect()}
    assert amounts[11] == amounts[12] == 10


def test_state_equals_the_one_pass_load(spark, tmp_path):
    stream, batch = made(spark, tmp_path / "stream"), made(spark, tmp_path / "batch")
    raw = raw_sales(spark, DATA)
    batch.append(raw, STAGING)
    load_backlog(batch, batch)
    for rows in (raw.repartition(4), raw.filter("orderid % 3 = 0"), raw):
        stream.append(rows, STAGING)
        run_new(stream, tmp_path / "state", max_files_per_trigger=2)
    for table in STAR:
        left, right = stream.read(table), batch.read(table)
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty(), table.name


def test_facts_of_before_the_first_start_are_known(spark, tmp_path):
    store, state = made(spark, tmp_path / "tables"), tmp_path / "state"
    store.append(sales(spark, [1, 2, 3]), STAGING)
    load_backlog(store, store)
    store.append(sales(spark, [2, 3, 4]), STAGING)
    run_new(store, state)
    assert ids_of(store.read(FACT)) == [1, 2, 3, 4]
    store.append(sales(spark, [1, 4, 5]), STAGING)
    run_new(store, state)
    assert ids_of(store.read(FACT)) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("lost", [CLEANED, FACT])
def test_a_repeated_batch_of_the_state_stream(spark, tmp_path, monkeypatch, lost):
    store, state = made(spark, tmp_path / "tables"), tmp_path / "state"
    summaries = keep_summaries(store)
    store.append(sales(spark, range(1, 9)), STAGING)
    replace = ParquetStore.replace_part

    def failing(self, df, table, part):
        written = replace(self, df, table, part)
        if table is lost:
            raise OSError("lost after a write")
        return written

    monkeypatch.setattr(ParquetStore, "replace_part", failing)
    with pytest.raises(Exception, match="lost after a write"):
        run_new(store, state)
    monkeypatch.undo()
    run_new(store, state)
    assert ids_of(store.read(FACT)) == ids_of(store.read(CLEANED)) == list(range(1, 9))
    assert [r["orders"] for r in summaries.sales_by_country_quarter().collect()] == [8]


def test_the_state_is_kept_by_rocksdb_and_the_session_unchanged(spark, tmp_path):
    store, state = made(spark, tmp_path / "tables"), tmp_path / "state"
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    store.append(sales(spark, [1, 1, 2]), STAGING)
    query = ingest_new_ids(store, store, str(state))
    query.awaitTermination()
    progress = query.recentProgress[0]["stateOperators"][0]
    assert progress["numRowsTotal"] == 2 and "rocksdbCommitFileSyncLatencyMs" in progress["customMetrics"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_state_needs_folders(spark, tmp_path):
    with pytest.raises(TypeError, match="in folders"):
        ingest_new_ids(made(spark, tmp_path), CatalogStore(spark, "any"), str(tmp_path))


def test_loop_goes_on_where_it_was_stopped(spark, tmp_path):
    store, state = made(spark, tmp_path / "tables"), str(tmp_path / "state")
    store.append(sales(spark, [*range(1, 11), 4, 0, -1, None]), STAGING)
    run_loop(store, store, state, 3, batches=2)
    assert ids_of(store.read(FACT)) == [1, 2, 3, 4, 5]
    assert ids_of(store.read(CLEANED)) == [1, 2, 3, 4, 4, 5]
    run_loop(store, store, state, 3)
    assert ids_of(store.read(FACT)) == list(range(1, 11))
    store.append(sales(spark, [2, 11, 12]), STAGING)
    run_loop(store, store, state, 100)
    run_loop(store, store, state, 100)
    assert ids_of(store.read(FACT)) == list(range(1, 13))
    assert ids_of(store.read(CLEANED)) == [1, 2, 3, 4, 4, *range(5, 13)]


@pytest.mark.parametrize("lost", [CLEANED, FACT])
def test_a_loop_that_failed_repeats_its_batch(spark, tmp_path, monkeypatch, lost):
    store, state = made(spark, tmp_path / "tables"), str(tmp_path / "state")
    store.append(sales(spark, range(1, 11)), STAGING)
    run_loop(store, store, state, 4, batches=1)
    name = "replace_part" if lost is CLEANED else "append"
    write = getattr(ParquetStore, name)

    def failing(self, df, table, *more, **options):
        write(self, df.filter("orderid < 7") if table is lost else df, table, *more, **options)
        if table is lost:
            raise OSError("lost after a partial write")

    monkeypatch.setattr(ParquetStore, name, failing)
    with pytest.raises(Exception, match="lost after a partial write"):
        run_loop(store, store, state, 4)
    monkeypatch.undo()
    assert 7 not in ids_of(store.read(lost))
    run_loop(store, store, state, 4)
    assert ids_of(store.read(FACT)) == ids_of(store.read(CLEANED)) == list(range(1, 11))


def test_loop_equals_the_plain_loop(spark, tmp_path):
    stream, plain = made(spark, tmp_path / "stream"), made(spark, tmp_path / "plain")
    for store in (stream, plain):
        store.append(raw_sales(spark, DATA), STAGING)
    for batches in (1, 1, None):
        run_loop(stream, stream, str(tmp_path / "state"), 500, batches)
    run_to_completion(plain, plain, 500)
    for table in (CLEANED, *STAR):
        left, right = stream.read(table), plain.read(table)
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty(), table.name


def test_ranges_of_the_reader():
    reader = _Ranges(5, [10, 20])
    assert reader.initialOffset() == {"orderid": 5}
    rows, end = reader.read({"orderid": 12})
    assert list(rows) == [(12, 20)] and end == {"orderid": 20}
    rows, end = reader.read(end)
    assert list(rows) == [] and end == {"orderid": 20}


def test_more_files_make_larger_micro_batches_not_more_of_them(spark, monkeypatch):
    raw = sales(spark, range(1, 241))
    batches = []

    def watched(staging, *rest):
        query = ingest_new_ids(staging, *rest)
        query.awaitTermination()
        batches[:] = [n for n in names_in(spark, staging.path(FACT)) if n.startswith("stream-")]
        return query

    monkeypatch.setattr(registry, "raw_sales", lambda *_: raw)
    monkeypatch.setattr(registry, "saved", lambda rows, _: rows.repartition(12))  # and so a dozen files
    monkeypatch.setattr(registry, "ingest_new_ids", watched)
    fact = registry.stream_state_fact(spark, "unused")
    assert ids_of(fact) == list(range(1, 241))
    assert 2 <= len(batches) <= registry.ROUNDS
