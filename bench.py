"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from salesflow.plans import jobs, registry
from salesflow.schemas import STAGING
from salesflow.sources.sample import raw_sales
from salesflow.sources.stores import ParquetStore
from salesflow.sources.workspace import new_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "batch_first",
    "clean_batch",
    "transfer_dim_date",
    "transfer_fact",
    "dedup_date",
    "dedup_fact",
    "new_country_keys",
    "batch_assignment",
    "quality_report",
    "star_sales_by_country_quarter",
    "orphan_facts",
    "scaled_features",
    "lloyd_assignment",
    "kmeans_result",
    "csv_load",
    "append_cleaned",
    "backlog_fact",
    "pipeline_final_fact",
    "stream_final_fact",
    "stream_state_fact",
    "loop_resumed_fact",
    "missing_order_ids",
    "star_sales_maintained",
    "fact_as_of",
]
# The single jobs, timed on tables that are there already.
JOBS = {
    "clean one batch": lambda store: jobs.clean_next_batch(store),
    "transfer one batch": lambda store: jobs.transfer_next_batch(store, store),
    "run to completion, batches of 50,000": lambda store: jobs.run_to_completion(store, store, 50_000),
    "cluster the fact table": lambda store: jobs.cluster_fact(store),
}


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    registry.queries()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def timed_jobs(spark: SparkSession) -> dict[str, float]:
    """Each job once on fresh raw rows, in the order in which they depend on each other."""
    store = ParquetStore(spark, new_folder(spark, "bench"))
    store.create_staging_area()
    store.create_star()
    store.append(raw_sales(spark, SF_DIR), STAGING)
    times = {}
    for name, job in JOBS.items():
        start = time.perf_counter()
        job(store)
        times[name] = round(time.perf_counter() - start, 3)
    return times


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name)  # the first run compiles code and is not timed
        times[name] = run(spark, name)
    timed_jobs(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "jobs": timed_jobs(spark),
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
