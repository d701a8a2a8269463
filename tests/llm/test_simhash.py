"""Fingerprints against a plain reading of their definition, and groups against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from salesflow.llm import simhash
from salesflow.llm.graph import connected_components
from salesflow.llm.tables import table

from .samples import SF, documents, no_documents, odd_documents, words


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """The smallest id that each fingerprint reaches, over all pairs."""
    nodes = sorted({f for _, f in prints})
    root = {f: f for f in nodes}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    values = np.array(nodes, np.uint64)
    for i, f in enumerate(nodes):
        for g in values[np.bitwise_count(values ^ values[i]) <= 4].tolist():
            root[find(f)] = find(g)
    ids = {}
    for doc_id, f in prints:
        if doc_id is not None:
            ids[find(f)] = min(ids.get(find(f), doc_id), doc_id)
    return {f: ids.get(find(f)) for f in nodes}


def check(rows, texts):
    prints = [(i, plain_fingerprint(t)) for i, t in texts]
    smallest = plain_components(prints)
    expected = sorted(((i, f"{f:016x}", smallest[f]) for i, f in prints), key=str)
    assert sorted(((r[0], r[1], r[2]) for r in rows), key=str) == expected


@pytest.mark.parametrize(
    "text", ["", " ", "one", "A B c", "a b c d", "x\x0by z\x85w ü Ü İ", words(1, 500)]
)
def test_fingerprint_of_definition(text):
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def test_chunks_change_nothing(monkeypatch):
    text = words(2, 300)
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


@pytest.mark.parametrize("hot_key", [simhash.HOT_KEY, 1])
def test_groups_of_given_documents(spark, hot_key):
    docs = table(spark, SF, "documents")
    found = simhash.near_duplicates(docs, hot_key).collect()
    check(found, [(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("hot_key", [simhash.HOT_KEY, 1])
def test_links_at_every_distance(spark, hot_key):
    rng = np.random.default_rng(5)
    nodes = {int(v) for v in rng.integers(-(1 << 63), 1 << 63, 40, np.int64)}
    for value in list(nodes)[:20]:
        for flips in range(1, 8):
            mask = sum(1 << int(b) for b in rng.choice(64, flips, replace=False))
            changed = (value ^ mask) & ((1 << 64) - 1)
            nodes.add(changed - (1 << 64) if changed >> 63 else changed)
    prints = spark.createDataFrame([(i, f) for i, f in enumerate(sorted(nodes))], "doc_id long, fingerprint long")
    found = {r["fingerprint"]: r["component_id"] for r in simhash.components(prints, hot_key).collect()}
    unsigned = [(i, f & ((1 << 64) - 1)) for i, f in enumerate(sorted(nodes))]
    expected = plain_components(unsigned)
    assert {f & ((1 << 64) - 1): c for f, c in found.items()} == expected
    assert len(set(found.values())) < len(found)


def test_chain_of_links_is_one_group(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r["root"] for r in connected_components(links).collect()} == {0}
    assert connected_components(links).count() == 201


def test_hub_and_no_links(spark):
    hub = spark.createDataFrame([(i, 1000) for i in range(500)] + [(None, 3), (7, 7)], "a long, b long")
    found = connected_components(hub)
    assert found.count() == 501
    assert {r["root"] for r in found.collect()} == {0}
    assert connected_components(hub.limit(0)).isEmpty()


def test_odd_documents(spark):
    docs = odd_documents(spark)
    check(simhash.near_duplicates(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_one_row_of_each_group_stays(spark):
    docs = odd_documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    prints = sorted(plain_fingerprint(t) for t in texts)
    assert prints == sorted({plain_fingerprint(r["text"]) for r in docs.collect()})
    # the NULL, empty and blank texts are one group, and the smallest id stays
    assert [r["doc_id"] for r in kept.filter("text is null or trim(text) = ''").collect()] == [3]
    assert kept.filter(F.col("text") == words(1, 40)).select("doc_id").collect() == [(1,)]
    assert kept.filter("doc_id is null").count() == 1


def test_same_id_in_two_groups(spark):
    docs = documents(spark, [words(1, 30), words(2, 30), words(2, 30)], [5, 5, 3])
    kept = simhash.one_of_each(docs).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == sorted([(5, words(1, 30)), (3, words(2, 30))])


def test_no_documents(spark):
    assert simhash.near_duplicates(no_documents(spark)).isEmpty()
    assert simhash.one_of_each(no_documents(spark)).isEmpty()
