"""Small files in whatever file system a path names, through the one that Spark itself uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class TakenError(FileExistsError):
    """A file of this name has been written by somebody else."""


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    path = _path(spark, folder)
    system = _system(spark, path)
    if not system.exists(path):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(path))


def read_text(spark: SparkSession, name: str) -> str:
    path = _path(spark, name)
    stream = _system(spark, path).open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, name: str, text: str) -> None:
    """Write a small file that must not be there yet; it appears with all its text or not at all.

    A file is written under another name and renamed without replacing, which the file system does
    as one step: of several writers one succeeds, the others get a `TakenError`.
    """
    target = _path(spark, name)
    draft = _path(spark, f"{target.getParent().toString()}/_draft-{uuid.uuid4().hex}")
    system = _system(spark, target)
    system.mkdirs(target.getParent())
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    try:
        context.rename(
            system.makeQualified(draft), system.makeQualified(target), options
        )
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise TakenError(name) from error
        raise


def delete_folder(spark: SparkSession, name: str) -> None:
    path = _path(spark, name)
    _system(spark, path).delete(path, True)
