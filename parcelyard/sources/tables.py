"""Staging tables: scan, count, size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.operators.staging import row_bytes


def read_table(spark: SparkSession, location: str, fmt: str = "parquet", **options) -> DataFrame:
    """A staging table from files in any of Spark's formats."""
    return spark.read.format(fmt).options(**options).load(location)


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: object, upper: object, partitions: int, **options
) -> DataFrame:
    """A staging table in an external database, read by ``partitions`` ranges of ``column`` at once."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=partitions, **{"queryTimeout": 3600, "fetchsize": 50_000, **options},
        )
        .load()
    )


def count_rows(df: DataFrame) -> DataFrame:
    """64-bit row count as a one-row table."""
    return df.agg(F.count("*").alias("row_count"))


def storage_size(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Files and bytes stored under ``path``; lists files and opens none."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(path)
    )
    return files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes")
    )


def logical_size(df: DataFrame) -> DataFrame:
    """Rows and estimated bytes of the values themselves, independent of the file format."""
    return df.agg(
        F.count("*").alias("row_count"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("size_bytes")
    )
