"""Folders for intermediate tables, inside the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


@cache
def _temporary_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="salesflow-")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a new temporary one only in local mode without it."""
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    return _temporary_folder(context.applicationId)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path not used before, below the shared folder."""
    return f"{shared_folder(spark)}/salesflow/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table: later passes reread files instead of recomputing."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
