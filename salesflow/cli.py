"""Command line for the jobs, to be run with spark-submit (see submit.py)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from salesflow.plans import jobs
from salesflow.plans.summaries import attach_summaries, keep_summaries
from salesflow.schemas import STAGING, STAGING_AREA, STAR
from salesflow.sources.csv import read_csv, read_csv_with_rejects
from salesflow.sources.sliced import SlicedStore
from salesflow.sources.stores import CatalogStore, JdbcStore, ParquetStore
from salesflow.streaming.ingest import ingest_files, ingest_new_ids
from salesflow.streaming.loop import run_loop


def open_store(spark: SparkSession, place: str, properties: str | None):
    """A store from its place: a JDBC address, catalog:DATABASE, sliced:FOLDER, or a folder."""
    if place.startswith("jdbc:"):
        if properties is None:
            return JdbcStore(spark, place, {})
        with open(properties) as file:
            return JdbcStore(spark, place, json.load(file))
    if place.startswith("catalog:"):
        return CatalogStore(spark, place.removeprefix("catalog:"))
    sliced = place.startswith("sliced:")
    store = SlicedStore(spark, place.removeprefix("sliced:")) if sliced else ParquetStore(spark, place)
    attach_summaries(store)
    return store


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(prog="salesflow")
    commands = made.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *stores: str, batches: bool = False):
        sub = commands.add_parser(name, help=text)
        for store in stores:
            sub.add_argument(f"--{store}", required=True, metavar="PLACE")
            sub.add_argument(f"--{store}-properties", metavar="JSON_FILE")
        if batches:
            sub.add_argument("--batch-rows", type=int, default=jobs.BATCH_ROWS)
        return sub

    both = ("staging", "production")
    command("create", "create all tables", *both)
    load = command("load-csv", "append CSV files to the raw table", "staging")
    load.add_argument("csv")
    load.add_argument("--rejects", metavar="FOLDER", help="where lines go that do not fit, instead of failing")
    command("clean", "clean the next batch", "staging", batches=True).add_argument(
        "--preview", type=int, default=0, metavar="ROWS"
    )
    command("clean-missing", "clean rows that the watermark skipped", "staging")
    command("transfer", "transfer the next batch", *both, batches=True).add_argument(
        "--preview", type=int, default=0, metavar="ROWS"
    )
    command("repair", "transfer cleaned rows that the fact table lacks", *both).add_argument(
        "--above", type=int, default=0, metavar="ID", help="ids up to this one are complete"
    )
    command("keep-summaries", "keep id bitmaps and sums beside the fact table", "production")
    loop = command("loop", "clean and transfer until nothing is left, resuming by a checkpoint", *both, batches=True)
    loop.add_argument("--checkpoint", required=True)
    commands.add_parser("ddl", help="print the table definitions")
    command("run", "clean and transfer until nothing is left", *both, batches=True)
    command("backlog", "clean and transfer everything in one pass", *both)
    command("cluster", "cluster all orders", "production")
    stream = command("stream", "load raw files not seen before", *both)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--max-files-per-trigger", type=int)
    stream.add_argument("--new-ids", action="store_true", help="tell known ids by the state of the stream")
    return made


def run(spark: SparkSession, arguments: list[str] | None = None):
    """Carry out one command and return its result."""
    options = parser().parse_args(arguments)

    def store(name: str):
        return open_store(spark, getattr(options, name), getattr(options, f"{name}_properties"))

    staging = store("staging") if "staging" in options else None
    production = store("production") if "production" in options else None
    match options.command:
        case "create":
            staging.create_staging_area()
            production.create_star()
        case "load-csv":
            if options.rejects is None:
                staging.append(read_csv(spark, options.csv), STAGING)
            else:
                rows = read_csv_with_rejects(spark, options.csv)
                staging.append(rows.accepted, STAGING)
                rows.rejected.write.mode("append").parquet(options.rejects)
        case "clean":
            return jobs.clean_next_batch(staging, options.batch_rows, options.preview)
        case "clean-missing":
            return jobs.clean_missing(staging)
        case "transfer":
            return jobs.transfer_next_batch(
                staging, production, options.batch_rows, options.preview
            )
        case "repair":
            return jobs.repair_star(staging, production, options.above)
        case "ddl":
            return "\n\n".join(table.definition for table in (*STAGING_AREA, *STAR))
        case "run":
            return jobs.run_to_completion(staging, production, options.batch_rows)
        case "backlog":
            return jobs.load_backlog(staging, production)
        case "keep-summaries":
            keep_summaries(production)
        case "loop":
            run_loop(staging, production, options.checkpoint, options.batch_rows)
        case "cluster":
            jobs.cluster_fact(production)
        case "stream":
            ingest = ingest_new_ids if options.new_ids else ingest_files
            ingest(
                staging, production, options.checkpoint, options.max_files_per_trigger
            ).awaitTermination()
    return None


def main() -> None:
    spark = SparkSession.builder.appName("salesflow").getOrCreate()
    try:
        result = run(spark)
        print("done" if result is None else result)
    finally:
        spark.stop()
