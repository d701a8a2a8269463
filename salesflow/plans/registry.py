"""Named queries over a folder of source tables: one per operator or job."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions import cleaning
from salesflow.operators import checks, clustering, history, incremental, sketches, star
from salesflow.plans import jobs
from salesflow.plans.summaries import keep_summaries
from salesflow.schemas import (
    CLEANED,
    DIM_CATEGORY,
    DIM_COUNTRY,
    DIM_DATE,
    DIMENSIONS,
    FACT,
    RESULT,
    RESULT_COLUMNS,
    STAGING,
    STAR,
    Table,
)
from salesflow.sources.csv import read_csv, read_csv_with_rejects, write_csv
from salesflow.sources.sample import raw_sales
from salesflow.sources.sliced import SlicedStore
from salesflow.sources.stores import ParquetStore
from salesflow.sources.workspace import new_folder, saved
from salesflow.streaming.ingest import ingest_files, ingest_new_ids
from salesflow.streaming.loop import run_loop

Query = Callable[[SparkSession, str], DataFrame]

# Rows that an earlier transfer has moved.
EARLIER_ROWS = 1_000
# Batch size of the batch numbering: small, so that several batches exist at every scale.
NUMBERED_ROWS = 1_000
# Ids of a slice, as a power of two, at least: small, so that several slices exist at every scale.
SLICE_BITS = 10
# Slices that the whole id range has, about: more ids make wider slices, not more folders and files.
SLICES = 64
# Rounds in which the loading jobs take the whole input.
ROUNDS = 4

# What a fact table with gaps holds: not every tenth order, and none of some stretches.
_HELD = "orderid % 10 <> 3 and orderid % 1000 >= 70"

# A column has moved if the ranks of its values differ by more than this share.
DRIFT = 0.25

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Inputs


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row beyond the initial watermark, cleaned."""
    return cleaning.clean(incremental.after(raw_sales(spark, sf_dir), 0))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_rows(_cleaned(spark, sf_dir))


def _stored_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact rows as a written table, for queries that pass over them several times."""
    return saved(_fact(spark, sf_dir), "fact")


def _stored_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saved(_cleaned(spark, sf_dir), "cleaned")


def _even_keys(dimension: DataFrame, dim: Table) -> DataFrame:
    """A dimension as an earlier load may have left it: half of its keys are known."""
    return dimension.filter(F.col(dim.key) % 2 == 0)


def _batch(df: DataFrame, watermark: int, rows: int = jobs.BATCH_ROWS) -> DataFrame:
    batch = incremental.next_batch(df, watermark, rows)
    return df.filter(F.lit(False)) if batch is None else batch.frame


def _store(spark: SparkSession, label: str, *tables: Table) -> ParquetStore:
    store = ParquetStore(spark, new_folder(spark, label))
    store.create(tables)
    return store


# Scans


@_query
def scan_fact(spark, sf_dir):
    store = _store(spark, "scan_fact", FACT)
    store.append(_fact(spark, sf_dir), FACT, keys_are_new=True)
    return store.read(FACT)


@_query
def batch_first(spark, sf_dir):
    return _batch(raw_sales(spark, sf_dir), 0)


@_query
def batch_second(spark, sf_dir):
    return _batch(raw_sales(spark, sf_dir), jobs.BATCH_ROWS)


@_query
def dim_key_scan(spark, sf_dir):
    """The keys of the stored dimensions; a scan of each table's key column."""
    store = _store(spark, "dim_key_scan", *DIMENSIONS)
    keys = [c for dim in DIMENSIONS for c in dim.names]
    seen = saved(star.seen_attributes(_cleaned(spark, sf_dir).select("orderid", *keys)), "seen")

    def scan(dim: Table) -> DataFrame:
        store.append(star.dimension_of(seen, dim), dim, keys_are_new=True)
        return store.read(dim).select(F.lit(dim.name).alias("dimension"), F.col(dim.key).alias("id"))

    return reduce(DataFrame.unionByName, map(scan, DIMENSIONS))


@_query
def high_watermark(spark, sf_dir):
    return incremental.high_watermark(_cleaned(spark, sf_dir))


@_query
def table_exists(spark, sf_dir):
    """Which tables a store has, with the row counts of those that exist."""
    store = ParquetStore(spark, sf_dir)

    def line(name: str) -> DataFrame:
        table = Table(f"{name}.parquet", ())
        found = store.exists(table)
        return (store.read(table) if found else spark.range(0)).agg(
            F.lit(name).alias("table_name"),
            F.lit(found).alias("found"),
            F.count(F.lit(1)).alias("row_count"),
        )

    names = ("orders", "customer", "nation", "region", "no_such_table")
    return reduce(DataFrame.unionByName, map(line, names))


@_query
def csv_load(spark, sf_dir):
    """All raw rows by way of CSV files; a quoted empty text comes back as NULL."""
    folder = new_folder(spark, "csv_load")
    write_csv(raw_sales(spark, sf_dir), folder)
    return read_csv(spark, folder)


@_query
def csv_rejects(spark, sf_dir):
    """The lines of damaged CSV files that are no rows, each with the reason."""
    folder = new_folder(spark, "csv_rejects")
    _damaged_lines(raw_sales(spark, sf_dir)).write.text(folder)
    return read_csv_with_rejects(spark, folder, header=False).rejected.select("line", "reason")


def _damaged_lines(raw: DataFrame) -> DataFrame:
    """Raw rows as text, some of which do not fit, by rules on the order id."""
    kind = F.col("orderid") % 100
    value = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in STAGING.names}
    value["amount"] = F.when(kind.isin(7, 9), F.concat(F.lit("about "), value["amount"])).otherwise(value["amount"])
    value["date"] = F.when(kind.isin(8, 9), F.lit("1995-13-01")).otherwise(value["date"])
    line = F.concat_ws(",", *value.values())
    return raw.select(F.when(kind == 10, F.concat(line, F.lit(",more"))).otherwise(line).alias("value"))


# Sinks


@_query
def append_cleaned(spark, sf_dir):
    """The cleaned table after cleaning everything in appended batches."""
    store = _store(spark, "append_cleaned", CLEANED)
    rows = _write_raw(store, spark, sf_dir)
    while not jobs.clean_next_batch(store, math.ceil(rows / 2) or 1).done:
        pass
    return store.read(CLEANED)


@_query
def overwrite_result(spark, sf_dir):
    """The result table after a second write replaced rows and columns of the first."""
    store = _store(spark, "overwrite_result")
    fact = _stored_fact(spark, sf_dir)
    store.overwrite(fact, RESULT)
    store.overwrite(clustering.lloyd(fact), RESULT)
    return store.read(RESULT)


# Projections and filters


@_query
def project_fact(spark, sf_dir):
    return _cleaned(spark, sf_dir).select(*FACT.names)


@_query
def project_date(spark, sf_dir):
    return _cleaned(spark, sf_dir).select(*DIM_DATE.names)


@_query
def filter_after_watermark(spark, sf_dir):
    return incremental.after(raw_sales(spark, sf_dir), 0)


@_query
def find_missing_names(spark, sf_dir):
    missing = cleaning.is_missing("weekdayname") | cleaning.is_missing("quartername")
    return (
        raw_sales(spark, sf_dir)
        .filter(missing)
        .select("orderid", "weekday", "weekdayname", "quarter", "quartername")
    )


# Keys not yet in a dimension


def _new_keys(spark, sf_dir, dim):
    rows = saved(_cleaned(spark, sf_dir).select("orderid", *dim.names), dim.name)
    found = star.dimension_rows(rows, dim)
    return star.new_rows(found, _even_keys(found, dim), dim.key)


@_query
def new_date_keys(spark, sf_dir):
    return _new_keys(spark, sf_dir, DIM_DATE)


@_query
def new_category_keys(spark, sf_dir):
    return _new_keys(spark, sf_dir, DIM_CATEGORY)


@_query
def new_country_keys(spark, sf_dir):
    return _new_keys(spark, sf_dir, DIM_COUNTRY)


# Aggregations


@_query
def batch_min_orderid(spark, sf_dir):
    """The first id of the next batch is the smallest pending id."""
    pending = incremental.after(raw_sales(spark, sf_dir), 0)
    return pending.agg(F.min("orderid").alias("min_orderid"))


@_query
def row_count(spark, sf_dir):
    return raw_sales(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))


@_query
def dedup_date(spark, sf_dir):
    return star.dimension_rows(_cleaned(spark, sf_dir), DIM_DATE)


@_query
def dedup_category(spark, sf_dir):
    return star.dimension_rows(_cleaned(spark, sf_dir), DIM_CATEGORY)


@_query
def dedup_country(spark, sf_dir):
    return star.dimension_rows(_cleaned(spark, sf_dir), DIM_COUNTRY)


@_query
def dedup_fact(spark, sf_dir):
    return _fact(spark, sf_dir)


@_query
def feature_stddev(spark, sf_dir):
    spread = clustering.feature_stddev(_fact(spark, sf_dir))
    return spread.select(*(F.round(name, 6).alias(name) for name in spread.columns))


# Scalar functions


@_query
def clean_country(spark, sf_dir):
    return raw_sales(spark, sf_dir).select(
        "orderid", cleaning.without_digits("country").alias("country")
    )


@_query
def fill_weekdayname(spark, sf_dir):
    return raw_sales(spark, sf_dir).select(
        "orderid", cleaning.filled("weekdayname", "weekday").alias("weekdayname")
    )


@_query
def clean_weekdayname(spark, sf_dir):
    return cleaning.clean(raw_sales(spark, sf_dir)).select("orderid", "weekdayname")


@_query
def fill_quartername(spark, sf_dir):
    return raw_sales(spark, sf_dir).select(
        "orderid", cleaning.filled("quartername", "quarter").alias("quartername")
    )


@_query
def clean_quartername(spark, sf_dir):
    return cleaning.clean(raw_sales(spark, sf_dir)).select("orderid", "quartername")


# Clustering


@_query
def features(spark, sf_dir):
    assembled = clustering.assembler().transform(_fact(spark, sf_dir))
    return clustering.feature_columns(assembled, "features")


@_query
def scaled_features(spark, sf_dir):
    assembled = clustering.assembler().transform(_stored_fact(spark, sf_dir))
    scaled = clustering.scaler().fit(assembled).transform(assembled)
    parts = clustering.feature_columns(scaled, "scaledFeatures")
    return parts.select(
        "orderid", *(F.round(name, 6).alias(name) for name in clustering.FEATURES)
    )


def _clustered(spark, sf_dir, label):
    store = _store(spark, label, FACT)
    store.append(_fact(spark, sf_dir), FACT, keys_are_new=True)
    return store, jobs.cluster_fact(store)


@_query
def kmeans_result(spark, sf_dir):
    """Every order after the clustering job, checked against the centres of the repeated training."""
    store, result = _clustered(spark, sf_dir, "kmeans_result")
    return clustering.assignment_check(result, clustering.fit(store.read(FACT)))


@_query
def kmeans_summary(spark, sf_dir):
    """Orders, clusters, and whether the cost is at most 5 % above that of plain Lloyd iterations."""
    store, result = _clustered(spark, sf_dir, "kmeans_summary")
    plain = clustering.cost(clustering.lloyd(store.read(FACT))).first()["cost"]
    found = clustering.cost(result)
    return found.select("rows", "clusters", (F.col("cost") <= 1.05 * plain).alias("good"))


@_query
def lloyd_assignment(spark, sf_dir):
    return clustering.lloyd(_stored_fact(spark, sf_dir)).select(*RESULT_COLUMNS)


@_query
def kmeans_seeded_summary(spark, sf_dir):
    """Orders, clusters, and whether the cost of spread starts is at most that of the clustering job."""
    store, result = _clustered(spark, sf_dir, "kmeans_seeded")
    job = clustering.cost(result).first()["cost"]
    found = clustering.cost(clustering.seeded_lloyd(store.read(FACT)))
    return found.select("rows", "clusters", (F.col("cost") <= job * (1 + 1e-9)).alias("good"))


# Jobs


def _staging_store(spark, sf_dir, label):
    store = _store(spark, label, CLEANED, *STAR)
    _write_raw(store, spark, sf_dir)
    return store


@_query
def clean_batch(spark, sf_dir):
    """The cleaned table after one cleaning job."""
    store = _staging_store(spark, sf_dir, "clean_batch")
    jobs.clean_next_batch(store)
    return store.read(CLEANED)


@_query
def clean_batch_2(spark, sf_dir):
    """What a second cleaning job adds to the cleaned table."""
    store = _staging_store(spark, sf_dir, "clean_batch_2")
    jobs.clean_next_batch(store)
    second = jobs.clean_next_batch(store)
    return incremental.after(store.read(CLEANED), second.watermark)


def _transferred(spark, sf_dir, table):
    """A star table after two transfers into a star that knows half of the dimension keys."""
    store = _store(spark, "transferred", CLEANED, *STAR)
    store.append(_cleaned(spark, sf_dir), CLEANED)
    seen = saved(star.seen_attributes(store.read(CLEANED)), "seen")
    for dim in DIMENSIONS:
        store.append(_even_keys(star.dimension_of(seen, dim), dim), dim, keys_are_new=True)
    jobs.transfer_next_batch(store, store, EARLIER_ROWS)
    jobs.transfer_next_batch(store, store)
    return store.read(table)


@_query
def transfer_dim_date(spark, sf_dir):
    return _transferred(spark, sf_dir, DIM_DATE)


@_query
def transfer_dim_category(spark, sf_dir):
    return _transferred(spark, sf_dir, DIM_CATEGORY)


@_query
def transfer_dim_country(spark, sf_dir):
    return _transferred(spark, sf_dir, DIM_COUNTRY)


@_query
def transfer_fact(spark, sf_dir):
    return _transferred(spark, sf_dir, FACT)


def _write_raw(store: ParquetStore, spark: SparkSession, sf_dir: str, **options) -> int:
    raw_sales(spark, sf_dir).write.mode("append").options(**options).parquet(store.path(STAGING))
    return store.read(STAGING).count()


def _final(spark, sf_dir, table):
    """A star table after the loading loop has run to its end, in four batches at every scale."""
    store = _store(spark, "loaded", CLEANED, *STAR)
    rows = _write_raw(store, spark, sf_dir)
    jobs.run_to_completion(store, store, math.ceil(rows / ROUNDS) or 1)
    return store.read(table)


@_query
def pipeline_final_fact(spark, sf_dir):
    return _final(spark, sf_dir, FACT)


@_query
def pipeline_final_dim_date(spark, sf_dir):
    return _final(spark, sf_dir, DIM_DATE)


@_query
def pipeline_final_dim_category(spark, sf_dir):
    return _final(spark, sf_dir, DIM_CATEGORY)


@_query
def pipeline_final_dim_country(spark, sf_dir):
    return _final(spark, sf_dir, DIM_COUNTRY)


@_query
def batch_assignment(spark, sf_dir):
    return incremental.assign_batches(raw_sales(spark, sf_dir), 0, NUMBERED_ROWS)


@_query
def batch_ranges(spark, sf_dir):
    return incremental.batch_bounds(batch_assignment(spark, sf_dir))


@_query
def backlog_fact(spark, sf_dir):
    """The fact table after the one-pass load of everything pending."""
    store = _store(spark, "backlog_fact", CLEANED, *STAR)
    _write_raw(store, spark, sf_dir)
    jobs.load_backlog(store, store)
    return store.read(FACT)


@_query
def stream_final_fact(spark, sf_dir):
    store = _store(spark, "stream_final_fact", CLEANED, *STAR)
    total = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    # Small inputs are split into several files, so that several micro-batches exist.
    _write_raw(store, spark, sf_dir, maxRecordsPerFile=math.ceil(total / (2 * ROUNDS)) or 1)
    files = len(store.read(STAGING).inputFiles())
    ingest_files(
        store, store, new_folder(spark, "stream_state"), math.ceil(files / ROUNDS)
    ).awaitTermination()
    return store.read(FACT)


@_query
def stream_state_fact(spark, sf_dir):
    """The fact table of a stream that knows its ids, after replayed, late and repeated orders.

    A first run takes the orders beyond the median id, a third of them twice; a second one the
    earlier orders, late now, and all of the first run's again.
    """
    store = _store(spark, "stream_state_fact", CLEANED, *STAR)
    raw = saved(raw_sales(spark, sf_dir), "raw")
    middle = raw.agg(F.percentile_approx("orderid", 0.5)).first()[0] or 0
    late, early = raw.filter(F.col("orderid") > middle), raw.filter(F.col("orderid") <= middle)
    checkpoint = new_folder(spark, "stream_state")
    seen = 0
    for arrivals in ([late, late.filter("orderid % 3 = 0")], [early, late]):
        for rows in arrivals:
            rows.write.mode("append").parquet(store.path(STAGING))
        files = len(store.read(STAGING).inputFiles())
        # More rows make larger micro-batches, not more of them: half of the rounds for each run.
        a_batch = max(2, math.ceil((files - seen) / (ROUNDS // 2)))
        ingest_new_ids(store, store, checkpoint, a_batch).awaitTermination()
        seen = files
    return store.read(FACT)


@_query
def loop_resumed_fact(spark, sf_dir):
    """The fact table after a loop that was stopped midway and resumed from its checkpoint."""
    store = _store(spark, "loop_resumed_fact", CLEANED, *STAR)
    rows = _write_raw(store, spark, sf_dir)
    checkpoint = new_folder(spark, "loop_state")
    for batches in (ROUNDS // 2, None):
        run_loop(store, store, checkpoint, math.ceil(rows / ROUNDS) or 1, batches)
    return store.read(FACT)


def _slice_bits(rows: DataFrame) -> int:
    """The width of slices that cuts the ids from 0 to the last into about so many at every scale."""
    last = incremental.high_watermark(rows).first()["max_orderid"]
    return max(SLICE_BITS, (max(last, 0) // SLICES).bit_length())


@_query
def sliced_final_fact(spark, sf_dir):
    """The fact table of the loading loop over tables that are cut into slices of ids."""
    raw = raw_sales(spark, sf_dir)
    store = SlicedStore(spark, new_folder(spark, "sliced"), _slice_bits(raw))
    store.create_staging_area()
    store.create_star()
    store.append(raw, STAGING)
    last = store.largest_id(STAGING)
    jobs.run_to_completion(store, store, math.ceil(last / ROUNDS) or 1)
    return store.read(FACT)


@_query
def missing_order_ids(spark, sf_dir):
    """Cleaned order ids that a fact table with gaps lacks, by the bitmaps kept beside it."""
    store = _store(spark, "missing_order_ids", FACT)
    summaries = keep_summaries(store)
    rows = saved(_cleaned(spark, sf_dir).select(*FACT.names), "cleaned")
    last = incremental.high_watermark(rows).first()["max_orderid"]
    held = star.fact_rows(rows.filter(_HELD))
    for after_id, last_id in ((0, last // 2), (last // 2, last)):
        store.append(incremental.between(held, after_id, last_id), FACT, keys_are_new=True)
        store.facts_changed(after_id, last_id)
    return summaries.missing(rows, 0, last)


@_query
def star_sales_maintained(spark, sf_dir):
    """The star query from sums that loads and a repair have kept up to date.

    The star starts with gaps in the first half of the orders; the rest comes in batches.
    """
    store = _store(spark, "star_sales_maintained", CLEANED, *STAR)
    summaries = keep_summaries(store)
    store.append(_cleaned(spark, sf_dir), CLEANED)
    rows = store.read(CLEANED)
    last = incremental.high_watermark(rows).first()["max_orderid"]
    jobs.load_star(incremental.between(rows, 0, last // 2).filter(_HELD), store, 1, last // 2)
    while not jobs.transfer_next_batch(store, store, math.ceil(last / ROUNDS) or 1).done:
        pass
    jobs.repair_star(store, store)
    return summaries.sales_by_country_quarter()


# Dimensions over time

_VERSIONED = ("countryid", ["country"])


def _country_history(spark, sf_dir):
    """Versions of the raw country names, from two halves of the orders, the later ones first."""
    raw = saved(raw_sales(spark, sf_dir).select("orderid", "dateid", "countryid", "country"), "raw")
    even, odd = (history.observed(raw.filter(f"orderid % 2 = {k}"), *_VERSIONED) for k in (0, 1))
    seen = saved(history.merged(saved(odd, "observations"), even, *_VERSIONED), "observations")
    return saved(history.versions(seen, *_VERSIONED), "versions")


@_query
def dim_history(spark, sf_dir):
    return _country_history(spark, sf_dir)


@_query
def fact_as_of(spark, sf_dir):
    """Every fact with the name that its country had on its day."""
    fact = _fact(spark, sf_dir)
    return history.as_of(fact, _country_history(spark, sf_dir), *_VERSIONED)


# Checks and reports


def _damaged(spark, sf_dir):
    """Cleaned rows with missing keys and too long texts, by rules on the order id."""
    rows = _cleaned(spark, sf_dir)
    holes = {"dateid": 11, "categoryid": 13, "countryid": 17}
    longer = {"quartername": 7, "monthname": 9, "weekdayname": 10, "category": 14, "country": 15}
    place = F.col("orderid")
    return rows.withColumns(
        {n: F.when(place % m != 0, F.col(n)) for n, m in holes.items()}
        | {n: F.when(place % m == 0, F.repeat(n, 20)).otherwise(F.col(n)) for n, m in longer.items()}
    )


@_query
def pk_violations(spark, sf_dir):
    """Keys that the cleaned rows, taken as rows of the star tables, hold more than once."""
    rows = saved(_cleaned(spark, sf_dir).select(*(t.key for t in STAR)), "keys")
    return reduce(DataFrame.unionByName, (checks.key_violations(rows, t) for t in STAR))


@_query
def null_key_violations(spark, sf_dir):
    """Damaged rows that a star table would refuse for a column declared NOT NULL."""
    rows = saved(_damaged(spark, sf_dir).select(*(t.key for t in STAR)), "damaged")
    return reduce(DataFrame.unionByName, (checks.null_violations(rows, t) for t in STAR))


@_query
def length_violations(spark, sf_dir):
    """Damaged rows that a table would refuse for the declared length of a text."""
    texts = [c.name for c in CLEANED.columns if c.length]
    rows = saved(_damaged(spark, sf_dir).select("orderid", *texts), "damaged")
    tables = (CLEANED, *DIMENSIONS)
    return reduce(DataFrame.unionByName, (checks.length_violations(rows, t) for t in tables))


@_query
def dim_conflicts(spark, sf_dir):
    return star.attribute_conflicts(raw_sales(spark, sf_dir), "countryid", "country")


@_query
def star_sales_by_country_quarter(spark, sf_dir):
    needed = dict.fromkeys([*FACT.names, *DIM_DATE.names, *DIM_COUNTRY.names])
    rows = saved(_cleaned(spark, sf_dir).select(*needed), "cleaned")
    return star.sales_by_country_quarter(
        star.fact_rows(rows),
        star.dimension_rows(rows, DIM_DATE),
        star.dimension_rows(rows, DIM_COUNTRY),
    )


@_query
def orphan_facts(spark, sf_dir):
    """Facts of all orders against dimensions that know half of the keys."""
    rows = _stored_cleaned(spark, sf_dir)
    seen = saved(star.seen_attributes(rows), "seen")
    known = (_even_keys(star.dimension_of(seen, dim), dim) for dim in DIMENSIONS)
    return star.orphan_facts(star.fact_rows(rows), *known)


@_query
def quality_report(spark, sf_dir):
    return checks.quality_report(raw_sales(spark, sf_dir))


_SKETCHED = ["amount", "dateid", "countryid", "categoryid", "orderid"]


@_query
def sketch_report(spark, sf_dir):
    """Merged sketches of all batches against exact counts: whether each is within its error."""
    raw = saved(raw_sales(spark, sf_dir).select(*_SKETCHED), "sketched")
    found = sketches.summaries(raw, F.expr(f"orderid % {ROUNDS}"), _SKETCHED)
    told = sketches.report(sketches.merged(saved(found, "sketches")), [0.25, 0.5, 0.75])
    counts = [F.count_distinct(n).alias(n) for n in _SKETCHED]
    exact = raw.agg(*counts).select(F.expr(f"stack({len(_SKETCHED)}, {_stacked(_SKETCHED)}) as (column_name, n)"))
    # A quantile is as good as its ranks: the shares of values below and up to it enclose the rank.
    asked = told.select("column_name", F.posexplode("quantiles").alias("place", "value"))
    values = raw.select(F.expr(f"stack({len(_SKETCHED)}, {_stacked(_SKETCHED)}) as (column_name, v)"))
    shares = (
        values.join(F.broadcast(asked), "column_name")  # three values for each column
        .groupBy("column_name", "place")
        .agg(F.avg((F.col("v") < F.col("value")).cast("int")).alias("below"),
             F.avg((F.col("v") <= F.col("value")).cast("int")).alias("upto"))
    )
    rank, error = (F.col("place") + 1) / 4, 2 * sketches.RANK_ERROR
    good = shares.groupBy("column_name").agg(
        F.bool_and((F.col("below") - error <= rank) & (rank <= F.col("upto") + error)).alias("quantiles_good")
    )
    near = F.abs(F.col("distinct_values") - F.col("n")) <= 4 * sketches.DISTINCT_ERROR * F.col("n") + 1
    return told.join(exact, "column_name").join(good, "column_name").select(
        "column_name", "rows", "missing", F.col("n").alias("distinct_values"), near.alias("distinct_good"), "quantiles_good"
    )


def _stacked(names: list[str]) -> str:
    return ", ".join(f"'{n}', cast({n} as long)" for n in names)


@_query
def batch_drift(spark, sf_dir):
    """Columns of each batch against the first one: whether the distribution has moved.

    Batches are quarters of the id range, so ids move and the other columns do not.
    """
    raw = saved(raw_sales(spark, sf_dir).select(*_SKETCHED), "sketched")
    last = incremental.high_watermark(raw).first()["max_orderid"]
    batch = F.expr(f"least(orderid * {ROUNDS} div {last + 1}, {ROUNDS - 1})").cast("int")
    found = saved(sketches.summaries(raw, batch, _SKETCHED), "sketches")
    first = found.filter("batch = 0")
    moved = [
        sketches.drift(found.filter(f"batch = {n}"), first).select(
            F.lit(n).alias("batch"), "column_name", (F.col("drift") > DRIFT).alias("moved")
        )
        for n in range(1, ROUNDS)
    ]
    return reduce(DataFrame.unionByName, moved)
