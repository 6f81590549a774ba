"""Small helpers that the operators share."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import functools
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.session import drop_path, scratch_path

NO_ID = -(2**63)
# Paths that ``keep`` has written on the way to the frame of ``keep_alone``.
_passing: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("passing", default=None)


@functools.cache
def _ship(application: str) -> None:
    """Give the workers this package, wherever the driver has it from. Spark serves the file to executors."""
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    SparkSession.active().sparkContext.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ship(spark.sparkContext.applicationId)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextlib.contextmanager
def _set_to(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session holds in what is run inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read again: cuts the lineage, survives lost executors.

    What the write has shuffled goes when it ends; else Spark leaves it on disk until the driver collects garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    passing = _passing.get()
    if passing is not None:
        passing.append(path)
    with _set_to(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``keep`` the frame that ``make`` returns, and delete all tables that ``make`` has kept on the way to it.

    Nothing outside ``make`` may read those tables: so large steps after one another need the disk of the largest, not of all.
    """
    passing: list[str] = []
    token = _passing.set(passing)
    try:
        try:
            found = make()
        finally:
            _passing.reset(token)
        return keep(found, label)
    finally:
        for path in passing:
            drop_path(SparkSession.active(), path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame that ``keep`` returned and nobody needs any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def give_back() -> None:
    """At the end of a Python task: return what it has freed to the system, as its worker lives on beside later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python gets at most so many rows at once in what is run inside; both the JVM and its worker hold a whole batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with _set_to(spark, name, before if 0 < int(before) <= rows else str(rows)):
        yield


def row_key(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """Two longs that identify a row by its id and text; rows equal in both get equal results."""
    return (
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("row_id"),
        F.xxhash64(F.col(text)).alias("row_hash"),
    )


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns of the input can't clash."""
    return df.select(*[F.col(f"`{name}`") for name in names])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for further columns that ``df`` does not have, whatever it has."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names
