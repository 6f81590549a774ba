"""Where jobs keep intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="parcelyard-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table.

    The folder is the shared one named in ``spark.checkpoint.dir``, so that every executor (and
    a replacement of a lost one) sees it. A machine-local folder is used in local mode only.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@functools.lru_cache(maxsize=2)
def _path_class(jvm):
    return jvm.org.apache.hadoop.fs.Path  # each dot is a call to the JVM


def hadoop_path(spark: SparkSession, path: str):
    return _path_class(spark._jvm)(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a stored table or folder if it is there."""
    target = hadoop_path(spark, path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
