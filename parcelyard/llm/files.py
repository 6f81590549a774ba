"""Binary files on the shared storage, written and read by tasks.

Tasks write under a fresh random name and report it; a file of a task that was lost or run twice is never
reported and so never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (``file:``, ``hdfs:``, ``s3:``, ``gs:``) or an absolute path."""
    if uri.startswith("file:"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    """Called on the driver before tasks write; object stores need no folders, others make them here."""
    store, path = locate(uri)
    store.create_dir(path, recursive=True)


def fresh_name(folder: str, part: int, suffix: str) -> str:
    return f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}{suffix}"


class RangeReader:
    """Reads byte ranges of one file."""

    def __init__(self, uri: str):
        store, path = locate(uri)
        self._file = store.open_input_file(path)
        self.size = self._file.size()

    def read(self, offset: int, length: int) -> bytes:
        data = self._file.read_at(length, offset)
        if len(data) != length:
            raise EOFError(f"{length} bytes at {offset} wanted, {len(data)} there")
        return data

    def close(self) -> None:
        self._file.close()


def map_files(
    spark: SparkSession, rows: list[tuple], schema: str, function: Callable[[Iterator], Iterator], out: str
) -> DataFrame:
    """Run ``function`` (as for ``mapInPandas``) with one row of ``rows``, which describes a file, per task."""
    if not rows:
        return spark.createDataFrame([], out)
    listed = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], f"slot long, {schema}")
    slots = spark.range(0, len(rows), 1, len(rows)).withColumnRenamed("id", "slot")
    return slots.join(F.broadcast(listed), "slot").mapInPandas(function, out)
