"""The command line drives the whole way from CSV to clusters."""

import pytest

from salesflow import cli
from salesflow.plans.jobs import JobResult
from salesflow.schemas import CLEANED, FACT, RESULT
from salesflow.sources.stores import CatalogStore, JdbcStore, ParquetStore
from tests.rows import ids_of
from tests.test_sources import HEADER, LINE


def test_places(spark, tmp_path):
    assert isinstance(cli.open_store(spark, str(tmp_path), None), ParquetStore)
    assert cli.open_store(spark, "catalog:sales", None).database == "sales"
    assert isinstance(cli.open_store(spark, "catalog:sales", None), CatalogStore)
    (tmp_path / "login.json").write_text('{"user": "u"}')
    jdbc = cli.open_store(spark, "jdbc:x:y", str(tmp_path / "login.json"))
    assert isinstance(jdbc, JdbcStore) and jdbc.properties == {"user": "u"}


def test_from_csv_to_clusters(spark, tmp_path, capsys):
    lines = [LINE.replace("7,120,3,4", f"{i},{i * 10},3,{i % 5}", 1) for i in range(1, 31)]
    (tmp_path / "sales.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    root = str(tmp_path / "tables")
    staging, production = ["--staging", root], ["--production", root]
    both = staging + production
    store = ParquetStore(spark, root)

    cli.run(spark, ["create", *both])
    cli.run(spark, ["load-csv", *staging, str(tmp_path / "sales.csv")])
    cleaned = cli.run(spark, ["clean", *staging, "--batch-rows", "10", "--preview", "5"])
    assert cleaned == JobResult(10, 0, False)
    assert "only showing top 5 rows" in capsys.readouterr().out
    moved = cli.run(spark, ["transfer", *both, "--batch-rows", "4", "--preview", "2"])
    assert moved == JobResult(4, 0, False)
    assert cli.run(spark, ["run", *both, "--batch-rows", "15"]) == 3
    assert cli.run(spark, ["repair", *both]) == 0
    assert cli.run(spark, ["backlog", *both]).done
    assert ids_of(store.read(FACT)) == list(range(1, 31))
    assert {r["country"] for r in store.read(CLEANED).collect()} == {"ASIA_A"}
    cli.run(spark, ["cluster", *production])
    assert store.read(RESULT).count() == 30


def test_stream_command(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(f"{HEADER}\n{LINE}\n")
    root = str(tmp_path / "tables")
    both = ["--staging", root, "--production", root]
    cli.run(spark, ["create", *both])
    cli.run(spark, ["load-csv", "--staging", root, str(tmp_path / "sales.csv")])
    cli.run(spark, ["stream", *both, "--checkpoint", str(tmp_path / "state")])
    assert ids_of(ParquetStore(spark, root).read(FACT)) == [7]


def test_rejects_loop_and_summaries(spark, tmp_path):
    lines = [LINE.replace("7,120", f"{i},{i * 10}", 1) for i in range(1, 21)]
    (tmp_path / "sales.csv").write_text("\n".join([HEADER, *lines, "broken"]) + "\n")
    root, rejects = str(tmp_path / "tables"), str(tmp_path / "rejects")
    both = ["--staging", f"sliced:{root}", "--production", f"sliced:{root}"]
    cli.run(spark, ["create", *both])
    cli.run(spark, ["keep-summaries", "--production", f"sliced:{root}"])
    cli.run(spark, ["load-csv", "--staging", f"sliced:{root}", str(tmp_path / "sales.csv"), "--rejects", rejects])
    assert [r["line"] for r in spark.read.parquet(rejects).collect()] == ["broken"]
    cli.run(spark, ["loop", *both, "--checkpoint", str(tmp_path / "state"), "--batch-rows", "8"])
    store = cli.open_store(spark, f"sliced:{root}", None)
    assert ids_of(store.read(FACT)) == list(range(1, 21))
    assert [r["orders"] for r in store.summaries.sales_by_country_quarter().collect()] == [20]


def test_stream_of_new_ids(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(f"{HEADER}\n{LINE}\n{LINE}\n")
    root = str(tmp_path / "tables")
    both = ["--staging", root, "--production", root]
    cli.run(spark, ["create", *both])
    for _ in range(2):
        cli.run(spark, ["load-csv", "--staging", root, str(tmp_path / "sales.csv")])
        cli.run(spark, ["stream", *both, "--checkpoint", str(tmp_path / "state"), "--new-ids"])
    assert ids_of(ParquetStore(spark, root).read(CLEANED)) == [7]


def test_unknown_command_is_refused(spark):
    with pytest.raises(SystemExit):
        cli.run(spark, ["vacuum"])


def test_definitions_have_primary_keys(spark):
    text = cli.run(spark, ["ddl"])
    assert text.count("CREATE TABLE") == 6
    assert text.count("PRIMARY KEY") == 4
    assert "  orderid INT NOT NULL," in text and "PRIMARY KEY (orderid)" in text
    assert "quartername VARCHAR(2)" in text
