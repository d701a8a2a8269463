"""Published versions of a folder: readers see the old rows or the new ones, never a mixture.

A version is written to a folder of its own and then named by a numbered file. That file appears in one
step, so a write that dies before it leaves the older version as it was. A number can be taken only
once: of two writers that began at the same version the slower one fails and changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salesflow.sources.files import TakenError, delete_folder, names_in, read_text, write_new_text

# Names that begin so are no data to Spark.
_NUMBERS = "_published"
_VERSIONS = "_versions"


class ChangedMeanwhile(RuntimeError):
    """Another writer has published a version since this one began."""


def _numbers(spark: SparkSession, folder: str) -> list[str]:
    return [name for name in names_in(spark, f"{folder}/{_NUMBERS}") if name.isdigit()]


def version_of(spark: SparkSession, folder: str) -> int:
    """The number of the current version, 0 if none has been published."""
    return int((_numbers(spark, folder) or ["0"])[-1])


def current_folder(spark: SparkSession, folder: str) -> str:
    """Where the current rows lie: the folder itself as long as nothing has been published."""
    numbers = _numbers(spark, folder)
    if not numbers:
        return folder
    return f"{folder}/{_VERSIONS}/{read_text(spark, f'{folder}/{_NUMBERS}/{numbers[-1]}')}"


def publish(df: DataFrame, folder: str, based_on: int | None = None) -> int:
    """Make rows the next version of a folder; returns its number.

    `based_on` is the version that the rows were made from, by default the one current now. If
    another version has been published since, `ChangedMeanwhile` is raised.
    """
    spark = df.sparkSession
    base = version_of(spark, folder) if based_on is None else based_on
    name = uuid.uuid4().hex
    place = f"{folder}/{_VERSIONS}/{name}"
    df.write.parquet(place)
    try:
        write_new_text(spark, f"{folder}/{_NUMBERS}/{base + 1:012d}", name)
    except TakenError as error:
        delete_folder(spark, place)
        raise ChangedMeanwhile(f"{folder} is beyond version {base}") from error
    return base + 1


def forget_versions(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete the rows of all but the newest versions, and of writes that were never published.

    Not to be called while somebody writes or reads an old version. Returns how many were deleted.
    """
    numbers = _numbers(spark, folder)
    kept = {read_text(spark, f"{folder}/{_NUMBERS}/{n}") for n in numbers[-keep:]}
    old = [name for name in names_in(spark, f"{folder}/{_VERSIONS}") if name not in kept]
    for name in old:
        delete_folder(spark, f"{folder}/{_VERSIONS}/{name}")
    return len(old)
