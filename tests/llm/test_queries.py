"""The registered queries: SQL texts, columns and whole results."""

from collections import Counter

import __spark_entry__ as spark_entry
import duckdb
import pytest

from salesflow.llm import registry
from salesflow.llm.tables import table

from .samples import SF

COLUMNS = {
    "op1_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op2_simhash": "doc_id fingerprint component_id",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_licenses": "doc_id canonical_sha256 license notices",
    "op5_language": "doc_id held_out lang_pred score",
    "op6_decontamination": "doc_id item_id windows item_windows other_values",
    "op7_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op8_quality": "doc_id held_out score predicted",
    "op9_neighbours": "query_id rank vec_id score",
    "op10_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op11_spelling": "word form root n n_near form_n",
    "op12_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13_minhash": "doc_id n_shingles component_id kept",
}


def test_all_are_registered():
    assert list(registry.queries()) == list(COLUMNS)
    assert registry.queries().items() <= spark_entry.queries().items()
    assert "pipeline" in spark_entry.queries()


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    found = registry.queries()[name](spark, SF)
    assert found.columns == COLUMNS[name].split()
    if found.columns[0] == "doc_id" and name != "op6_decontamination":
        assert {r["doc_id"] for r in found.select("doc_id").collect()} == {
            r["doc_id"] for r in table(spark, SF, "documents").select("doc_id").collect()
        }
    else:
        assert not found.isEmpty()


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    for source in ("documents", "conversations"):
        connection.sql(f"create view {source} as select * from '{SF}/{source}.parquet'")
    found = registry.queries()[name](spark, SF)
    expected = connection.sql(registry.oracle_sql()[name])
    order = sorted(expected.columns)
    assert sorted(found.columns) == order
    places = [expected.columns.index(c) for c in order]
    wanted = Counter(tuple(row[i] for i in places) for row in expected.fetchall())
    assert Counter(map(tuple, found.select(order).collect())) == wanted
