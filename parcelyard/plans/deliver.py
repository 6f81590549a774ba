"""Delivery: output names, one target per split, and what was written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelyard.operators.split import SPLIT, SPLIT_ROW
from parcelyard.operators.staging import stage

ROWS_PER_FILE = 2_000_000  # fixed value: the documented row cap of one output
BYTES_PER_FILE = 2 * 1024**3  # fixed value: size limit of one output


def plan_delivery(splits: DataFrame, prefix: str, started: dt.datetime, extension: str) -> DataFrame:
    """Number the surviving splits 1..n in split order and name their outputs.

    One output: ``{prefix}_{ddMMyyyy}{ext}`` holding table ``{prefix}``. Several:
    ``{prefix}_{n}_{ddMMyyyy}{ext}`` holding ``{prefix}_{n}``.
    """
    numbered = stage(splits, [SPLIT])
    many = F.lit(numbered.total_rows > 1)
    index = F.col("file_index").cast("int")
    inner_table = F.when(many, F.concat_ws("_", F.lit(prefix), index)).otherwise(prefix)
    return numbered.indexed("file_index").withColumns({
        "file_index": index,
        "file_name": F.concat(inner_table, F.lit(f"_{started:%d%m%Y}{extension}")),
        "inner_table": inner_table,
    })


def write_splits(
    rows: DataFrame,
    path: str,
    fmt: str = "parquet",
    target: str = SPLIT,
    rows_per_file: int = ROWS_PER_FILE,
    one_file: bool = False,
    options: dict[str, str] | None = None,
) -> None:
    """Write one target folder per split, ``split_id=1``, ``split_id=2`` ..., replacing ``path``.

    All splits are written at once and rows keep their order. Rows that come from a staging table
    lie in split order already, so each task writes the one or two splits it reads and nothing is
    shuffled; a split then has as many files as tasks that read it. With ``one_file`` the rows are
    shuffled so that a split is a single file, or one per ``rows_per_file`` rows: a split that
    holds much of the data is still written by many tasks. ``target`` names the column whose
    values name the folders. If the job fails, the output committer leaves no partial target.
    """
    if one_file:
        file_no = F.floor((F.col(SPLIT_ROW) - 1) / rows_per_file)
        rows = rows.withColumn("_file", file_no).repartition(target, "_file").drop("_file")
    (
        rows.sortWithinPartitions(target, SPLIT_ROW)
        .drop(*{SPLIT, SPLIT_ROW} - {target})
        .write.mode("overwrite").format(fmt).options(**(options or {}))
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(target)
        .save(path)
    )


def read_splits(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None, **options
) -> DataFrame:
    """Delivered rows with the split they are in."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def delivered(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None, target: str = SPLIT, **options
) -> DataFrame:
    """Rows, files and stored bytes per target folder, as found by reading it again.

    Only file metadata is selected, so a parquet target is answered from its footers.
    """
    rows = read_splits(spark, path, fmt, schema, **options)
    files = rows.groupBy(target, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("size")
    )
    return files.groupBy(target).agg(
        F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("size").alias("file_size_bytes")
    )
