"""Column summaries of batches that merge: distinct values, quantiles and frequent values.

Each batch is read once and leaves one small row for each column. Rows of several batches merge
into that of all of them without reading anything again, and two rows tell how far apart the
distributions of two batches lie. All sketches are Spark's own and built in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Registers of a distinct count, as a power of two: a standard error of 1.04 / 2^(bits / 2), 0.8 %.
DISTINCT_BITS = 14
DISTINCT_ERROR = 1.04 / math.sqrt(1 << DISTINCT_BITS)
# Size of a quantile sketch: its ranks are off by at most about 2.3 / size^0.9 of all rows, 0.6 %.
QUANTILE_SIZE = 800
RANK_ERROR = 2.296 / QUANTILE_SIZE**0.9021
# Values that the sketch of frequent values keeps.
TRACKED = 1_000
# Values of a distribution that another one is compared with.
PROBES = 200


def summaries(rows: DataFrame, batch: Column, columns: list[str]) -> DataFrame:
    """batch, column_name, rows, missing and the sketches, for each batch and integer column.

    NULLs are counted as missing and are in no sketch; a column without any value has no quantiles.
    """
    found = rows.groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("rows"),
        *(_sketches(name).alias(name) for name in columns),
    )
    lines = F.array(*(F.struct(F.lit(n).alias("column_name"), F.col("rows"), f"{n}.*") for n in columns))
    return found.select("batch", F.inline(lines))


def _sketches(name: str) -> Column:
    value = F.col(name).cast("long")
    return F.struct(
        F.count_if(value.isNull()).alias("missing"),
        F.hll_sketch_agg(value, F.lit(DISTINCT_BITS)).alias("distinct"),
        F.kll_sketch_agg_bigint(value, F.lit(QUANTILE_SIZE)).alias("quantiles"),
        F.expr(f"approx_top_k_accumulate(cast(`{name}` as long), {TRACKED})").alias("frequent"),
    )


def merged(found: DataFrame) -> DataFrame:
    """One row for each column, of all batches together."""
    return found.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_bigint("quantiles").alias("quantiles"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"),
    )


def report(found: DataFrame, ranks: list[float], top: int = 5) -> DataFrame:
    """column_name, rows, missing, estimated distinct values, quantiles at ranks and frequent values."""
    return found.select(
        *(c for c in ("batch", "column_name", "rows", "missing") if c in found.columns),
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        _quantiles(ranks).alias("quantiles"),
        F.expr(f"approx_top_k_estimate(frequent, {top})").alias("frequent"),
    )


def _quantiles(ranks: list[float]) -> Column:
    """Values at ranks; NULL for a column without any value, whose sketch has none to give."""
    asked = F.array(*(F.lit(float(r)) for r in ranks))
    return F.when(F.col("rows") > F.col("missing"), F.kll_sketch_get_quantile_bigint("quantiles", asked))


def drift(found: DataFrame, other: DataFrame) -> DataFrame:
    """column_name and drift between the same columns of two summaries: the largest rank difference.

    It estimates the Kolmogorov-Smirnov distance, 0 for equal and 1 for disjoint distributions, from the
    quantiles of both sides; it is off by at most twice the error of ranks and two steps between them.
    NULL where a side has no value.
    """
    ranks = [(i + 0.5) / PROBES for i in range(PROBES)]
    sides = [
        summary.select("column_name", _quantiles(ranks).alias(name)) for summary, name in ((found, "a"), (other, "b"))
    ]

    def below(values: str, x: Column) -> Column:
        return F.size(F.filter(values, lambda v: v <= x)) / PROBES

    gaps = F.transform(F.concat("a", "b"), lambda x: F.abs(below("a", x) - below("b", x)))
    return sides[0].join(sides[1], "column_name").select("column_name", F.array_max(gaps).alias("drift"))
