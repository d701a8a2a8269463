"""Overwriting by versions: lost writes, late readers, two writers."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesflow.schemas import RESULT
from salesflow.sources import publication
from salesflow.sources.files import TakenError, names_in, read_text, write_new_text
from salesflow.sources.publication import ChangedMeanwhile, publish, version_of
from salesflow.sources.stores import ParquetStore


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    return ParquetStore(spark, str(tmp_path / "tables"))


def test_the_newest_version_is_read(spark, store):
    assert not store.exists(RESULT)
    for n in (3, 5, 2):
        store.overwrite(spark.range(n), RESULT)
        assert ids(store.read(RESULT)) == list(range(n))
    assert version_of(spark, store.path(RESULT)) == 3


def test_a_write_that_dies_while_writing_rows(spark, store):
    store.overwrite(spark.range(3), RESULT)
    broken = spark.range(100, 200, 1, 8).select(
        F.when(F.col("id") == 177, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(PySparkException, match="lost"):
        store.overwrite(broken, RESULT)
    assert ids(store.read(RESULT)) == [0, 1, 2]
    store.overwrite(spark.range(1), RESULT)
    assert ids(store.read(RESULT)) == [0]


def test_a_write_that_dies_before_it_is_published(spark, store, monkeypatch):
    store.overwrite(spark.range(3), RESULT)

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(publication, "write_new_text", lost)
    with pytest.raises(OSError, match="lost"):
        store.overwrite(spark.range(9), RESULT)
    monkeypatch.undo()
    assert ids(store.read(RESULT)) == [0, 1, 2]
    assert store.forget_versions(RESULT) == 1
    assert ids(store.read(RESULT)) == [0, 1, 2]


def test_a_reader_keeps_its_version(spark, store):
    store.overwrite(spark.range(3), RESULT)
    old = store.read(RESULT)
    store.overwrite(spark.range(7), RESULT)
    assert ids(old) == [0, 1, 2]
    assert store.forget_versions(RESULT) == 1 and ids(store.read(RESULT)) == list(range(7))


def test_of_two_writers_the_slower_one_fails(spark, store):
    folder = store.path(RESULT)
    publish(spark.range(1), folder)
    begun = version_of(spark, folder)
    publish(spark.range(2), folder)
    with pytest.raises(ChangedMeanwhile):
        publish(spark.range(3), folder, based_on=begun)
    assert ids(store.read(RESULT)) == [0, 1] and version_of(spark, folder) == 2
    assert len(names_in(spark, f"{folder}/_versions")) == 2


def test_a_plain_table_is_taken_over(spark, store):
    spark.range(4).write.parquet(store.path(RESULT))
    assert ids(store.read(RESULT)) == [0, 1, 2, 3]
    store.overwrite(store.read(RESULT).filter("id > 1"), RESULT)
    assert ids(store.read(RESULT)) == [2, 3]


def test_a_new_text_is_written_once(spark, tmp_path):
    name = f"{tmp_path}/some/where/1"
    write_new_text(spark, name, "é1")
    with pytest.raises(TakenError):
        write_new_text(spark, name, "2")
    assert read_text(spark, name) == "é1" and names_in(spark, f"{tmp_path}/some/where") == ["1"]
    assert names_in(spark, f"{tmp_path}/nowhere") == []
