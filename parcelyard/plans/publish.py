"""Ordered, atomic delivery: data files first, then one commit that says which files make up the outputs, in which order.

``publish_splits`` writes the rows of a run under a hidden attempt folder, gives each file its final place and name, and
publishes a *commit manifest* (run, output, ordinal, file, rows, bytes) as the next version of the folder's commits by
one rename. Readers list files through the latest manifest only: a run that dies at any point before the rename
leaves the outputs as they were, and two runs at once cannot both win.

Order without a shuffle. A task reads pieces of staging files, and the rows of one piece are in order and without gaps.
Rows therefore carry the piece they were read from (``SEGMENT``: rows before its file, then the piece's place in it), which
is a folder of the attempt: all files of an output and piece are written by one task, and files sorted by piece hold the
output's rows in order. Wide rows are not moved for it; the folder is gone once files have their names. File names
begin with their ordinal over all outputs, so a plain listing by name is in order, too.

Facts come from the write itself: rows written are observed while they are written, once, in the stage that writes;
sizes are those of the listing that orders the files; parquet and orc files tell their rows in their footers.

The driver handles one short row per file, as Spark's own commit of a job does. ``output=<name>/`` folders hold the
files of the latest commit and, until ``vacuum``, those of runs that died while they named their files.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelyard.operators.split import SPLIT, SPLIT_ROW
from parcelyard.operators.staging import LOOKUP_ROW_BYTES, SEGMENT, broadcast_if_small
from parcelyard import versions
from parcelyard.plans.deliver import ROWS_PER_FILE
from parcelyard.session import drop_path

COMMITS, ATTEMPTS = "_commits", "_attempts"
MANIFEST = "run_id string, output string, ordinal int, file string, rows long, bytes long"
COUNTED = ("parquet", "orc")  # formats whose footers tell the rows of a file
_AT_ONCE = 16  # renames


@dataclass(frozen=True)
class Published:
    """A commit: its version, the rows it wrote and its manifest."""

    version: int
    rows: int
    manifest: DataFrame


def publish_splits(
    rows: DataFrame, path: str, run_id: str, fmt: str = "parquet", target: str = SPLIT,
    rows_per_file: int = ROWS_PER_FILE, one_file: bool = False, options: dict[str, str] | None = None,
) -> Published:
    """Replace the outputs at ``path`` by those of ``rows``, in the order of ``SPLIT_ROW`` in each.

    ``rows`` need the columns ``target``, ``SPLIT``, ``SPLIT_ROW`` and, as ``StagedRows.with_segments`` adds it, ``SEGMENT``.
    ``one_file`` shuffles so that an output is one file per ``rows_per_file`` rows.
    """
    spark = rows.sparkSession
    read = versions.latest(spark, f"{path}/{COMMITS}")
    before = manifest(spark, path, read)
    attempt = f"{path}/{ATTEMPTS}/{uuid.uuid4().hex}"
    if one_file:
        file_no = F.floor((F.col(SPLIT_ROW) - 1) / rows_per_file)
        rows = rows.withColumn(SEGMENT, F.lpad(file_no.cast("string"), 19, "0")).repartition(target, SEGMENT)
    # Observed after any shuffle, in the stage that writes: a stage that runs again counts once.
    written = Observation()
    (
        rows.observe(written, F.count(F.lit(1)).alias("rows"))
        .sortWithinPartitions(target, SEGMENT, SPLIT_ROW)
        .drop(*{SPLIT, SPLIT_ROW} - {target})
        .write.format(fmt).options(**(options or {}))
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(target, SEGMENT)
        .save(attempt)
    )
    files = _place(spark, attempt, path, target, fmt)
    found = spark.createDataFrame([(run_id, *f) for f in files], MANIFEST)
    version = versions.publish(found, f"{path}/{COMMITS}", read, files=1)
    drop_path(spark, attempt)
    old = [r["file"] for r in before.select("file").collect()] if before is not None else []
    _delete(spark, path, old, {f[2].split("/", 1)[0] for f in files})
    return Published(version, written.get["rows"], manifest(spark, path, version))


def _place(spark: SparkSession, attempt: str, path: str, target: str, fmt: str) -> list[tuple[str, int, str, int | None, int]]:
    """Give the files of an attempt their places: output, ordinal in it, file relative to ``path``, rows, bytes."""
    parts = []
    for source, rows, size in _listed(spark, attempt, fmt):
        folder, segment, name = source.rsplit("/", 3)[1:]
        number = re.search(r"-c(\d+)", name)  # of several files that one task has written for a piece
        parts.append((folder, segment, int(number[1]) if number else 0, name, source, rows, size))
    mark, ordinals, moves, out = uuid.uuid4().hex[:12], {}, [], []
    for at, (folder, _, _, name, source, rows, size) in enumerate(sorted(parts, key=lambda p: p[:5]), 1):
        ordinals[folder] = ordinals.get(folder, 0) + 1
        file = f"{folder}/part-{at:06d}-{mark}.{name.split('.', 1)[-1]}"
        moves.append((source, f"{path}/{file}"))
        out.append((_unescaped(folder.split("=", 1)[1]), ordinals[folder], file, rows, size))
    system = versions.file_system(spark, path)  # ``mark`` makes the names free
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        list(pool.map(lambda folder: versions.make_folder(spark, f"{path}/{folder}"), ordinals))
        list(pool.map(lambda move: versions.rename(spark, *move, system), moves))
    return out


def _listed(spark: SparkSession, attempt: str, fmt: str) -> list[tuple[str, int | None, int]]:
    """Path, rows and bytes of the files of an attempt, in one pass. Rows come from the footers where these tell them (a
    written file has some); no column is read."""
    files = spark.read.option("recursiveFileLookup", "true")
    if fmt not in COUNTED:
        return [(r["path"], None, r["length"]) for r in files.format("binaryFile").load(attempt).select("path", "length").collect()]
    counted = files.format(fmt).schema("_none int").load(attempt).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    )
    # The scan reports file names URL-encoded.
    return [(unquote(r["file"]), r["count"], r["size"]) for r in counted.groupBy("file", "size").count().collect()]


def _unescaped(name: str) -> str:
    """Spark writes characters that paths can't hold as %XX."""
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


def _delete(spark: SparkSession, path: str, files: list[str], used: set[str]) -> None:
    """Delete files, and their folders where nothing is left; those in ``used`` hold committed files."""
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        list(pool.map(lambda file: drop_path(spark, f"{path}/{file}"), files))
        list(pool.map(lambda folder: _drop_empty(spark, f"{path}/{folder}"), {f.split("/", 1)[0] for f in files} - used))


def _drop_empty(spark: SparkSession, folder: str) -> None:
    if not [n for n in versions.names(spark, folder) if not n.startswith((".", "_"))]:
        drop_path(spark, folder)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The latest or a given commit of the outputs at ``path``; None if there is none."""
    version = versions.latest(spark, f"{path}/{COMMITS}") if version is None else version
    if not version:
        return None
    return spark.read.schema(MANIFEST).parquet(versions.version_path(f"{path}/{COMMITS}", version))


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete what no commit names: attempts and files of runs that died. For when no run is writing here."""
    committed = manifest(spark, path)
    kept = {r["file"] for r in committed.select("file").collect()} if committed is not None else set()
    drop_path(spark, f"{path}/{ATTEMPTS}")
    there = [
        f"{folder}/{name}" for folder in versions.names(spark, path) if not folder.startswith(("_", "."))
        for name in versions.names(spark, f"{path}/{folder}") if not name.startswith((".", "_"))
    ]
    lost = [f for f in there if f not in kept]
    _delete(spark, path, lost, {f.split("/", 1)[0] for f in kept})
    return len(lost)


def read_committed(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None, **options
) -> DataFrame:
    """Rows of the latest commit with the output they are in; files that it does not name are not opened."""
    committed = manifest(spark, path)
    files = [] if committed is None else [r["file"] for r in committed.select("file").collect()]
    reader = spark.read.format(fmt).options(**options).option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    if not files:
        if schema is None:
            raise FileNotFoundError(f"nothing has been published at {path}")
        return spark.createDataFrame([], schema)
    return reader.load([f"{path}/{f}" for f in files])


def read_ordered(spark: SparkSession, path: str, target: str = SPLIT, number: str = "row_number", **options) -> DataFrame:
    """Rows of a committed parquet delivery with their 1-based place in their output, without a sort or shuffle.

    The place follows from the manifest (rows of the files before) and the row's place in its file.
    """
    committed = manifest(spark, path).collect()
    before, starts = {}, []
    for row in sorted(committed, key=lambda r: (r["output"], r["ordinal"])):
        starts.append((row["file"].rsplit("/", 1)[1], before.get(row["output"], 0)))
        before[row["output"]] = before.get(row["output"], 0) + row["rows"]
    lookup = broadcast_if_small(spark.createDataFrame(starts, "_file string, _before long"), len(starts) * LOOKUP_ROW_BYTES)
    rows = read_committed(spark, path, **options)
    place = F.col("_before") + F.col("_row") + 1
    return (
        rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        .join(lookup, "_file").withColumn(number, place).drop("_file", "_before", "_row")
    )
