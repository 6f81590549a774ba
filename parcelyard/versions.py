"""Numbered versions of a folder, published by one rename that fails when another writer was first.

A version is written in full beside the others, under a hidden name, and becomes ``v000001``, ``v000002`` ... by a
rename to a name that must not exist. A writer says which version it has read: if that is no longer the latest, it has
lost the race and nothing changes. Readers take the highest number and never see half a version. The rename is atomic on
HDFS and POSIX file systems; object stores without one need a committer that has it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from parcelyard.session import drop_path, hadoop_path


class LostRace(RuntimeError):
    """Another writer has published the version that this one wanted to be."""


def _context(spark: SparkSession, path: str):
    target = hadoop_path(spark, path)
    conf = spark._jsc.hadoopConfiguration()
    system = target.getFileSystem(conf)
    return spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.makeQualified(target).toUri(), conf)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def rename(spark: SparkSession, source: str, target: str, system=None) -> None:
    """Rename a file or folder to a name that must be free.

    Who knows that it is, as with a name drawn at random, gives the ``file_system``: that is one call, where a rename that
    fails on a taken name looks up a file context and both names for every file.
    """
    if system is not None:
        if not system.rename(hadoop_path(spark, source), hadoop_path(spark, target)):
            raise OSError(f"{source} was not renamed to {target}")
        return
    gateway = spark.sparkContext._gateway
    options = gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        _context(spark, target).rename(hadoop_path(spark, source), hadoop_path(spark, target), options)
    except Exception as error:
        if "FileAlreadyExists" in str(error) or "not empty" in str(error).lower():
            raise FileExistsError(target) from error
        raise


def make_folder(spark: SparkSession, path: str) -> None:
    target = hadoop_path(spark, path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What is directly in a folder; nothing if there is no folder."""
    target = hadoop_path(spark, folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def latest(spark: SparkSession, folder: str) -> int:
    """Number of the latest version; 0 if there is none."""
    return max((int(n[1:]) for n in names(spark, folder) if n[:1] == "v" and n[1:].isdigit()), default=0)


def version_path(folder: str, version: int) -> str:
    return f"{folder}/v{version:06d}"


def publish(df: DataFrame, folder: str, read: int, fmt: str = "parquet", files: int | None = None) -> int:
    """Write ``df`` as the version after ``read``; ``LostRace`` if that one exists by then."""
    spark = df.sparkSession
    prepared = f"{folder}/.prepared-{uuid.uuid4().hex}"
    (df.coalesce(files) if files else df).write.format(fmt).save(prepared)
    return publish_prepared(spark, prepared, folder, read)


def publish_prepared(spark: SparkSession, prepared: str, folder: str, read: int) -> int:
    """The same with a folder that is already written, on the same file system."""
    try:
        if latest(spark, folder) != read:
            raise FileExistsError(version_path(folder, read + 1))
        rename(spark, prepared, version_path(folder, read + 1))
    except FileExistsError as error:
        drop_path(spark, prepared)
        raise LostRace(f"version {read} of {folder} was read, but {latest(spark, folder)} is the latest by now") from error
    return read + 1
