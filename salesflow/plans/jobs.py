"""Jobs over stored tables: clean a batch, transfer a batch, run until done, cluster.

Every job takes the store of the staging area, the store of the star schema, or both. Errors
are raised; "no new rows" is a normal result.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.cleaning import clean
from salesflow.operators import clustering
from salesflow.operators.incremental import (
    assign_batches,
    batch_bounds,
    missing_ids,
    next_batch,
)
from salesflow.operators.star import dimension_of, fact_rows, new_rows, seen_attributes
from salesflow.schemas import CLEANED, DIMENSIONS, FACT, RESULT, STAGING, STAR, Table

# Fixed value: rows per batch.
BATCH_ROWS = 10_000


class JobResult(NamedTuple):
    """Rows taken on, the watermark they start after, and whether there was nothing to do."""

    rows: int
    watermark: int
    done: bool


def clean_next_batch(
    staging, batch_rows: int = BATCH_ROWS, preview: int = 0, known: int = 0
) -> JobResult:
    """Clean the next raw rows and append them to the cleaned table.

    A batch is an id range with all copies of its ids. `preview` prints that many raw rows.
    `known` is a watermark already reached, if the caller has one.
    """
    staging.require(STAGING, CLEANED)
    watermark = staging.largest_id(CLEANED, known)
    batch = next_batch(staging.read(STAGING), watermark, batch_rows, staging.id_counts(STAGING))
    if batch is None:
        return JobResult(0, watermark, True)
    rows = staging.rows_between(STAGING, watermark, batch.last_id)
    if preview:
        rows.show(preview)
    staging.append(clean(rows), CLEANED)
    return JobResult(batch.rows, watermark, False)


def clean_missing(staging) -> int:
    """Clean raw rows up to the watermark whose id was never cleaned; returns how many ids.

    The watermark skips what a partly failed append left out, and rows that arrived late. This
    job takes both on request; `repair_star` then moves them to the star.
    """
    staging.require(STAGING, CLEANED)
    raw = staging.rows_between(STAGING, 0, staging.largest_id(CLEANED))
    missing = missing_ids(raw, staging.read(CLEANED)).persist()
    try:
        ids = missing.count()
        if ids:
            staging.append(clean(raw.join(missing, "orderid", "left_semi")), CLEANED)
        return ids
    finally:
        missing.unpersist()


def load_dimensions(rows: DataFrame, production) -> None:
    """Add the dimension keys of cleaned rows that are not there yet.

    One pass finds the attributes of all dimensions, and one job tells which of them have new keys.
    """
    # About as many rows as the dimensions have keys: kept so that they are computed once.
    seen = seen_attributes(rows).persist()
    fresh = {
        dim: new_rows(dimension_of(seen, dim), production.read(dim), dim.key).persist() for dim in DIMENSIONS
    }

    @inheritable_thread_target(rows.sparkSession)
    def append(dim: Table) -> None:
        production.append(fresh[dim], dim, keys_are_new=True)

    try:
        counted = [rows.agg(F.lit(dim.name).alias("dim"), F.count(F.lit(1)).alias("rows")) for dim, rows in fresh.items()]
        new = {r["dim"] for r in reduce(DataFrame.unionByName, counted).filter("rows > 0").collect()}
        pending = [dim for dim in DIMENSIONS if dim.name in new]
        if pending:
            # The dimensions do not depend on each other, so their jobs may share the cluster.
            with ThreadPoolExecutor(len(pending)) as pool:
                list(pool.map(append, pending))
    finally:
        for frame in (*fresh.values(), seen):
            frame.unpersist()


def load_star(rows: DataFrame, production, first_id: int, last_id: int) -> None:
    """Add cleaned rows to the star: unseen dimension keys first, then unseen facts.

    All ids of the rows lie between `first_id` and `last_id`. One pass finds the attributes of all
    dimensions, another one the facts. Each append skips the keys its table already has, so
    running it again after a failure completes the load instead of repeating or losing rows.
    """
    load_dimensions(rows, production)
    # Only the id range of these rows can hold their ids; the range reaches the scan.
    stored = production.rows_between(FACT, first_id - 1, last_id)
    production.append(new_rows(fact_rows(rows), stored, FACT.key), FACT, keys_are_new=True)
    production.facts_changed(first_id - 1, last_id)


def repair_star(staging, production, above: int = 0) -> int:
    """Transfer cleaned rows up to the watermark that the fact table lacks; returns their ids.

    A write that failed halfway can leave such gaps, and the watermark alone would skip them. Ids
    up to `above` are known to be complete and are not looked at.
    """
    staging.require(CLEANED)
    production.require(*STAR)
    watermark = production.largest_id(FACT)
    if watermark <= above:
        return 0
    done = staging.rows_between(CLEANED, above, watermark)
    missing = production.missing_facts(done, above, watermark).persist()
    try:
        ids = missing.count()
        if ids:
            rows = done.join(missing, "orderid", "left_semi")
            load_star(rows, production, above + 1, watermark)
        return ids
    finally:
        missing.unpersist()


def transfer_next_batch(
    staging, production, batch_rows: int = BATCH_ROWS, preview: int = 0, known: int = 0
) -> JobResult:
    """Move the next cleaned rows to the star schema. Earlier gaps are `repair_star`'s work."""
    staging.require(CLEANED)
    production.require(*STAR)
    watermark = production.largest_id(FACT, known)
    batch = next_batch(staging.read(CLEANED), watermark, batch_rows, staging.id_counts(CLEANED))
    if batch is None:
        return JobResult(0, watermark, True)
    rows = staging.rows_between(CLEANED, watermark, batch.last_id)
    if preview:
        rows.show(preview)
    load_star(rows, production, watermark + 1, batch.last_id)
    return JobResult(batch.rows, watermark, False)


def run_to_completion(staging, production, batch_rows: int = BATCH_ROWS) -> int:
    """Clean and transfer batch after batch until no new rows are left; returns the rounds.

    Gaps of earlier runs are closed first. All batch ends are planned by one pass over the ids; a
    round reads back only the rows that it has cleaned itself.
    """
    staging.require(STAGING, CLEANED)
    production.require(*STAR)
    repair_star(staging, production)
    cleaned_to, moved_to = staging.largest_id(CLEANED), production.largest_id(FACT)
    rounds = 0
    if cleaned_to > moved_to:  # what an earlier run has cleaned only
        load_star(
            staging.rows_between(CLEANED, moved_to, cleaned_to), production, moved_to + 1, cleaned_to
        )
        rounds += 1
    pending = staging.rows_after(STAGING, cleaned_to)
    bounds = batch_bounds(assign_batches(pending, cleaned_to, batch_rows)).orderBy("batch_no")
    for batch in bounds.toLocalIterator():
        last = batch["last_orderid"]
        rows = clean(staging.rows_between(STAGING, cleaned_to, last))
        stored = staging.append_range(rows, CLEANED, cleaned_to, last)
        load_star(stored, production, cleaned_to + 1, last)
        cleaned_to = last
        rounds += 1
    return rounds


def load_backlog(staging, production) -> JobResult:
    """Clean and transfer everything beyond the watermarks in one pass, without batches."""
    staging.require(STAGING, CLEANED)
    production.require(*STAR)
    repaired = repair_star(staging, production)
    cleaned_to, moved_to = staging.largest_id(CLEANED), production.largest_id(FACT)
    last = staging.largest_id(STAGING, cleaned_to)
    if last <= moved_to:
        return JobResult(repaired, moved_to, repaired == 0)
    pending = None
    if last > cleaned_to:
        rows = clean(staging.rows_after(STAGING, cleaned_to))
        pending = staging.append_range(rows, CLEANED, cleaned_to, last)
    if pending is None or cleaned_to > moved_to:  # an earlier run has cleaned rows without moving them
        pending = staging.rows_between(CLEANED, moved_to, last)
    load_star(pending, production, moved_to + 1, last)
    return JobResult(repaired + pending.count(), moved_to, False)


def cluster_fact(
    production, k: int = clustering.CLUSTERS, seed: int = clustering.SEED
) -> DataFrame:
    """Train on the fact table, score it and replace the result table; returns the result."""
    production.require(FACT)
    fact = production.read(FACT)
    model = clustering.fit(fact, k, seed)
    production.overwrite(clustering.score(model, fact), RESULT)
    return production.read(RESULT)
