"""One named query per text operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import (
    chat,
    decontam,
    langid,
    licenses,
    minhash,
    neighbours,
    packing,
    pii,
    quality,
    repair,
    simhash,
    spelling,
    toxicity,
)
from salesflow.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


@_query
def op1_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@_query
def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@_query
def op4_licenses(spark, sf_dir):
    return licenses.scanned(table(spark, sf_dir, "documents"))


_ORACLES["op4_licenses"] = licenses.oracle_sql()


@_query
def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identified(docs, langid.learn(docs))


@_query
def op6_decontamination(spark, sf_dir):
    return decontam.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@_query
def op7_chat(spark, sf_dir):
    rows = chat.with_probe(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.conversations(chat.linear(rows)))


_ORACLES["op7_chat"] = chat.ORACLE_SQL


@_query
def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


@_query
def op9_neighbours(spark, sf_dir):
    asked = F.col("vec_id") % neighbours.QUERY_SHARE == 0
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), asked)


@_query
def op10_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"))


@_query
def op11_spelling(spark, sf_dir):
    return spelling.variant_groups(table(spark, sf_dir, "documents"), spelling.DAMAGED_SHARE)


_ORACLES["op11_spelling"] = spelling.ORACLE_SQL


@_query
def op12_repair(spark, sf_dir):
    return repair.audited(repair.damaged(table(spark, sf_dir, "conversations")))


_ORACLES["op12_repair"] = repair.ORACLE_SQL


@_query
def op13_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


_ORACLES["op13_minhash"] = minhash.ORACLE_SQL
