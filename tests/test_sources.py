"""Stores, CSV files, the shared folder, and how JDBC tables are addressed."""

import datetime

import pytest

from salesflow.schemas import DIM_CATEGORY, FACT, RESULT, STAGING, Table
from salesflow.sources.csv import read_csv, read_csv_with_rejects
from salesflow.sources.stores import JdbcStore, MissingTable, ParquetStore
from salesflow.sources.workspace import new_folder, saved, shared_folder
from tests.rows import ids_of, sales

HEADER = ",".join(STAGING.names)
LINE = "7,120,3,4,5,1995-01-03,1995,1,,1,January,3,3,,TOYS,12ASIA_A7"


def written(tmp_path, *lines):
    (tmp_path / "sales.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "sales.csv")


def test_csv_rows_have_declared_types(spark, tmp_path):
    row = read_csv(spark, written(tmp_path, HEADER, LINE)).first()
    assert row["orderid"] == 7 and row["date"] == datetime.date(1995, 1, 3)
    assert row["quartername"] is None and row["country"] == "12ASIA_A7"


def test_csv_that_does_not_fit_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, written(tmp_path, HEADER, LINE.replace("120", "many"))).collect()
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, written(tmp_path, HEADER.replace("amount", "price"), LINE)).collect()


def test_parquet_store_append_and_overwrite(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path))
    assert not store.exists(FACT)
    store.create([FACT])
    store.create([FACT])
    assert store.exists(FACT) and store.read(FACT).isEmpty()
    for i in (1, 2):
        store.append(sales(spark, [i]), FACT)
    assert ids_of(store.read(FACT)) == [1, 2]
    store.append(sales(spark, []), FACT)
    assert ids_of(store.read(FACT)) == [1, 2]
    store.overwrite(sales(spark, [3]), RESULT)
    store.overwrite(sales(spark, [4]).select("orderid"), RESULT)
    assert store.read(RESULT).columns == ["orderid"]
    with pytest.raises(MissingTable, match="dim_category"):
        store.read(DIM_CATEGORY)


def test_only_a_missing_path_means_no_table(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="CANNOT_READ_FILE_FOOTER"):
        ParquetStore(spark, str(tmp_path)).exists(Table("broken", ()))
    with pytest.raises(Exception, match="nosuchscheme"):
        ParquetStore(spark, "nosuchscheme://host/root").exists(FACT)


def test_saved_rows_are_read_from_files(spark):
    stored = saved(sales(spark, [1, 2]), "trial")
    assert ids_of(stored) == [1, 2]
    assert stored.inputFiles()[0].removeprefix("file:").removeprefix("//").startswith(
        shared_folder(spark)
    )
    assert new_folder(spark, "a") != new_folder(spark, "a")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class Recorder:
    """Stands in for a session: records JDBC reads, answers with fixed rows."""

    def __init__(self, spark, answers):
        self.spark, self.answers, self.calls = spark, answers, []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        for part, frame in self.answers.items():
            if part in table:
                return frame
        return sales(self.spark, [1])


def jdbc_store(spark, lowest, highest):
    listed = spark.createDataFrame(
        [("public", "fact_orders"), ("public", "dim_category"), ("other", "sales_staging")],
        "table_schema string, table_name string",
    )
    bounds = spark.createDataFrame([(lowest, highest)], "lowest int, highest int")
    session = Recorder(spark, {"information_schema": listed, "min(orderid)": bounds})
    return JdbcStore(session, "jdbc:x", {"user": "u"}, partitions=6), session


@pytest.mark.parametrize("lowest,highest,bounds", [(3, 90, (3, 91)), (None, None, (0, 1))])
def test_jdbc_tables_with_ids_are_read_in_ranges(spark, lowest, highest, bounds):
    store, session = jdbc_store(spark, lowest, highest)
    store.read(FACT)
    url, table, options = session.calls[-1]
    assert (url, table) == ("jdbc:x", "public.fact_orders")
    assert options["column"] == "orderid" and options["numPartitions"] == 6
    assert (options["lowerBound"], options["upperBound"]) == bounds
    assert options["properties"] == {"user": "u"}


def test_jdbc_tables_without_ids_and_missing_ones(spark):
    store, session = jdbc_store(spark, 1, 2)
    assert store.exists(FACT) and not store.exists(STAGING)
    store.read(DIM_CATEGORY)
    assert "column" not in session.calls[-1][2]
    with pytest.raises(MissingTable):
        store.read(STAGING)


def test_jdbc_tables_are_created_with_their_keys(spark, monkeypatch):
    store, _ = jdbc_store(spark, 1, 2)
    sent = []
    monkeypatch.setattr(JdbcStore, "_execute", lambda self, statement: sent.append(" ".join(statement.split())))
    store.create_star()
    assert [s.split("(")[0] for s in sent] == ["CREATE TABLE public.dim_date ", "CREATE TABLE public.dim_country "]
    assert sent[1] == (
        "CREATE TABLE public.dim_country ( countryid INT NOT NULL, country VARCHAR(50), PRIMARY KEY (countryid) )"
    )
    store.create_staging_area()
    assert len(sent) == 4 and "PRIMARY KEY" not in sent[2]


def test_jdbc_watermark_and_counts_are_sent_as_sql(spark):
    store, session = jdbc_store(spark, 1, 2)
    session.answers["max(orderid) AS max_orderid"] = spark.createDataFrame([(12,)], "max_orderid int")
    assert store.largest_id(FACT, 5) == 12
    asked = [table for _, table, _ in session.calls]
    assert asked[-1] == "(SELECT max(orderid) AS max_orderid FROM public.fact_orders WHERE orderid > 5) q"
    counts = store.id_counts(FACT)
    counts.by_bucket(12)
    counts.by_id(13, 99)
    asked = [table for _, table, _ in session.calls]
    assert asked[-2:] == [
        "(SELECT orderid / 65536 AS slot, count(*) AS rows FROM public.fact_orders"
        " WHERE orderid > 12 GROUP BY orderid / 65536) q",
        "(SELECT orderid AS slot, count(*) AS rows FROM public.fact_orders"
        " WHERE orderid BETWEEN 13 AND 99 GROUP BY orderid) q",
    ]
    assert "public.fact_orders" not in asked  # the table itself was never read


def test_lines_that_do_not_fit_are_rejected_with_their_reason(spark, tmp_path):
    bad = {
        LINE.replace("120", "many"): "amount",
        LINE.replace("120", "many").replace("1995-01-03", "3 January"): "amount, date",
        LINE + ",more": "number of fields",
        "7,8": "number of fields",
        LINE.replace("120", "99999999999"): "amount",
    }
    rows = read_csv_with_rejects(spark, written(tmp_path, HEADER, LINE, *bad, "", LINE))
    assert ids_of(rows.accepted) == [7, 7] and rows.accepted.columns == STAGING.names
    assert rows.accepted.first()["date"] == datetime.date(1995, 1, 3)
    assert {r["line"]: r["reason"] for r in rows.rejected.collect()} == bad
    assert all(r["file"].endswith("sales.csv") for r in rows.rejected.collect())
    # What is counted does not depend on the columns that are read.
    assert rows.accepted.count() + rows.rejected.count() == len(bad) + 2
    assert rows.accepted.select("orderid").count() == 2


def test_quoted_values_are_accepted(spark, tmp_path):
    line = LINE.replace("12ASIA_A7", '"A, B"')
    rows = read_csv_with_rejects(spark, written(tmp_path, HEADER, line))
    assert rows.accepted.first()["country"] == "A, B" and rows.rejected.isEmpty()
    other = HEADER.replace("amount", "price")
    rows = read_csv_with_rejects(spark, written(tmp_path, other, LINE))
    assert ids_of(rows.accepted) == [7] and [r["line"] for r in rows.rejected.collect()] == [other]
