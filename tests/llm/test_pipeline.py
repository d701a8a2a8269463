"""The stages one after the other, each against a plain account of what it keeps."""

import re

import corpus_pipeline
import pytest

from salesflow.llm import decontam, packing, quality
from salesflow.llm.tables import table
from salesflow.sources.workspace import saved

from .samples import SF, labels, no_documents, odd_documents
from .test_pii import base_spans
from .test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def outputs(spark):
    docs = table(spark, SF, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found.append(saved(stage(spark, found[-1], SF), name))
    return found


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_and_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "pii", "packing",
    ]
    assert all(o.schema == outputs[0].schema for o in outputs)
    sizes = [o.count() for o in outputs]
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] > 0


def test_quality_keeps_what_scores_well(spark, outputs):
    model = quality.learn(outputs[0], table(spark, SF, "labels"))
    good = quality.scored(outputs[0], model).filter("predicted = 1")
    assert rows(outputs[1]).keys() == {r["doc_id"] for r in good.collect()}


def test_the_first_of_each_group_stays(outputs):
    prints = [(i, plain_fingerprint(r["text"])) for i, r in rows(outputs[1]).items()]
    smallest = plain_components(prints)
    assert rows(outputs[2]).keys() == {i for i, f in prints if smallest[f] == i}


def test_no_benchmark_item_is_left(spark, outputs):
    items = table(spark, SF, "benchmark")
    found = decontam.contaminated(outputs[2], items).select("doc_id").distinct()
    gone = {r["doc_id"] for r in found.collect()}
    assert gone and rows(outputs[3]).keys() == rows(outputs[2]).keys() - gone


def test_no_base_span_is_left(outputs):
    before, after = rows(outputs[3]), rows(outputs[4])
    assert before.keys() == after.keys()
    assert any(base_spans(r["text"]) for r in before.values())
    for doc_id, row in after.items():
        assert not base_spans(row["text"])
        if not re.search("[0-9@]", before[doc_id]["text"]):
            assert row == before[doc_id]


def test_run_packs_the_last_documents(spark, outputs):
    packed = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(packed.select(key).collect()) == sorted(packing.pieces_of(outputs[4]).select(key).collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_each_stage_takes_odd_and_no_documents(spark, tmp_path, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    odd = odd_documents(spark)
    result = stage(spark, odd, str(tmp_path))
    if name == "packing":
        assert result.select("doc_id").distinct().count() == odd.select("doc_id").distinct().count()
    else:
        assert result.columns == odd.columns
        assert result.count() == (9 if name == "near_duplicates" else odd.count())
    empty = stage(spark, no_documents(spark), str(tmp_path))
    assert empty.isEmpty()
