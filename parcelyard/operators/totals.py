"""Totals of delivery runs over their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.functions.text import base_name

_BLOCK = 1000  # file names joined per group in the first step


def _joined(entries: Column) -> Column:
    """Texts of (order, text) structs in their order, ``"; "`` between them."""
    return F.array_join(F.transform(F.sort_array(entries), lambda e: e["text"]), "; ")


def run_totals(files: DataFrame) -> DataFrame:
    """Files, rows, both sizes and all file names in file order per run, in one pass over the files.

    Files are folded in blocks of file numbers first and the blocks afterwards, so a run with very
    many files is not gathered name by name into one task.
    """
    name = base_name(F.col("path")).alias("text")
    blocks = files.groupBy("process_id", F.floor(F.col("file_index") / _BLOCK).alias("block")).agg(
        F.count("*").alias("files"),
        F.sum("rows").alias("rows_written"),
        F.sum("table_size_bytes").alias("table_bytes"),
        F.sum("file_size_bytes").alias("file_bytes"),
        _joined(F.collect_list(F.struct("file_index", name))).alias("text"),
    )
    sums = [F.sum(c).alias(c) for c in ("files", "rows_written", "table_bytes", "file_bytes")]
    return blocks.groupBy("process_id").agg(
        *sums, _joined(F.collect_list(F.struct("block", "text"))).alias("file_names")
    )


def rows_per_second(rows: Column, seconds: Column) -> Column:
    """Throughput; 0 when nothing was timed."""
    return F.when(seconds > 0, rows / seconds).otherwise(F.lit(0.0))
