"""Audit trail: one row per run, appended once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelyard.functions.text import format_bytes, format_duration, parameter_summary
from parcelyard import versions
from parcelyard.session import drop_path

# Columns of the audit table.
AUDIT_SCHEMA = T.StructType([
    T.StructField("StoreProcedureName", T.StringType(), False),
    T.StructField("Parameter", T.StringType()),
    T.StructField("ProcessId", T.StringType(), False),
    T.StructField("Date", T.TimestampNTZType(), False),
    T.StructField("FileNames", T.StringType()),
    T.StructField("RowsCount", T.LongType()),
    T.StructField("Message", T.StringType()),
    T.StructField("Comment", T.StringType()),
])


def audit_rows(outcomes: DataFrame, totals: DataFrame, output_dir: str) -> DataFrame:
    """Audit rows of runs: what ran, with what result, and a comment on time and size."""
    both = outcomes.join(totals, "process_id", "left")
    comment = F.concat_ws(
        " | ",
        F.concat(F.lit("Duration: "), format_duration(F.col("duration_s"))),
        F.concat(F.lit("Files: "), F.col("planned_files").cast("string")),
        F.concat(F.lit("Total Table Size: "), format_bytes(F.coalesce("table_bytes", F.lit(0)))),
        F.concat(F.lit("Total File Size: "), format_bytes(F.coalesce("file_bytes", F.lit(0)))),
        F.lit(f"OutputDir: {output_dir}"),
    )
    return both.select(
        F.col("job").alias("StoreProcedureName"),
        parameter_summary(F.col("parameters")).alias("Parameter"),
        F.col("process_id").alias("ProcessId"),
        F.col("start_time").alias("Date"),
        F.coalesce("file_names", F.lit("")).alias("FileNames"),
        F.coalesce("rows_written", F.lit(0)).alias("RowsCount"),
        F.when(F.col("success"), "Success").otherwise(F.col("error_message")).alias("Message"),
        comment.alias("Comment"),
    )


def append_audit(rows: DataFrame, path: str, enabled: bool = True, run: str | None = None) -> str | None:
    """Append to the audit table, which the first append creates; a run has one row however often it is appended.

    ``run`` says that the rows are those of one run: they become a file with the run's name, by a rename that only the
    first of any number of tries wins. Without it, runs that the table has are left out by an anti join, which is for a
    single writer. A failing append does not fail the run: its text is returned as a warning.
    """
    if not enabled:
        return None
    try:
        rows = rows.select(AUDIT_SCHEMA.names)
        if run is not None:
            _append_run(rows, path, run)
        else:
            if versions.names(rows.sparkSession, path):
                rows = rows.join(read_audit(rows.sparkSession, path).select("ProcessId"), "ProcessId", "left_anti").select(rows.columns)
            rows.dropDuplicates(["ProcessId"]).write.mode("append").parquet(path)
    except Exception as error:  # the delivery itself is done and must not be undone
        return f"Audit record was not written: {error}"
    return None


def _append_run(rows: DataFrame, path: str, run: str) -> None:
    spark = rows.sparkSession
    name = f"{path}/run-{run}.parquet"
    if name.rsplit("/", 1)[1] in versions.names(spark, path):
        return
    prepared = f"{path}/.prepared-{uuid.uuid4().hex}"
    rows.coalesce(1).write.parquet(prepared)
    try:
        (file,) = [n for n in versions.names(spark, prepared) if n.endswith(".parquet") and not n.startswith(".")]
        versions.rename(spark, f"{prepared}/{file}", name)
    except FileExistsError:
        pass  # another try of the same run was first
    finally:
        drop_path(spark, prepared)


def read_audit(spark, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)
