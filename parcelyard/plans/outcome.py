"""Outcome of delivery runs, and the run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.functions.errors import error_message
from parcelyard.functions.text import format_bytes, format_count, format_duration, parameter_summary
from parcelyard.operators.totals import rows_per_second
from parcelyard.operators.validate import oversize_warning

# Texts of outcomes and warnings.
CANCELLED = "Operation cancelled by user due to threshold violations."
ALL_EXCEED = "All split tables exceed the threshold — no tables to process."
EMPTY_STAGING = "Staging table returned 0 rows."
DELIVERED_ANYWAY = "All tables were delivered, also those above the threshold, as the policy asks."
NOT_MEASURED = "—"


def run_outcome(runs: DataFrame) -> DataFrame:
    """Success, error text, warnings and planned files per run, from its facts.

    Reads process_id, job, staging_table, total_rows, splits, violations, policy, threshold,
    error_code, error_detail and rejects, and ``skipped`` (names of skipped tables) where runs have it, which names them
    in the warning. Rules apply in order: a database error fails the run; no
    rows succeed with a warning; a violation fails under ``cancel`` and, when every split
    violates, under ``valid_only``.
    """
    rows, threshold, splits, violations = (F.col(c) for c in ("total_rows", "threshold", "splits", "violations"))
    failed = F.col("error_code").isNotNull()
    empty = ~failed & (rows == 0)
    ran = ~failed & ~empty
    violated = ran & (F.coalesce(threshold, F.lit(0)) > 0) & (violations > 0)
    cancelled = violated & (F.col("policy") == "cancel")
    valid_only = violated & (F.col("policy") == "valid_only")
    nothing_left = valid_only & (violations == splits)
    partly = valid_only & (violations < splits)
    error = (
        F.when(failed, error_message(F.col("error_code"), F.col("error_detail")))
        .when(cancelled, CANCELLED)
        .when(nothing_left, ALL_EXCEED)
    )
    skipped = F.format_string("Skipped %d table(s) exceeding threshold", violations.cast("int"))
    if "skipped" in runs.columns:
        named = F.concat(skipped, F.lit(": "), F.array_join("skipped", ", "))
        skipped = F.when(F.size("skipped") > 0, named).otherwise(skipped)
    warnings = F.array_compact(F.array(
        F.when(empty, EMPTY_STAGING),
        F.when(ran & (splits == 1), oversize_warning(rows, threshold, F.col("staging_table"))),
        F.when(partly, skipped),
        F.when(violated & (F.col("policy") == "all"), DELIVERED_ANYWAY),
        F.when(ran & (F.col("rejects") > 0), F.format_string("%d row(s) rejected", F.col("rejects"))),
    ))
    planned = (
        F.when(failed | empty | cancelled | nothing_left, 0).when(partly, splits - violations).otherwise(splits)
    )
    return runs.withColumns({
        "success": error.isNull(),
        "outcome": F.when(failed, "failed").when(empty, "empty").when(cancelled, "cancelled")
        .when(nothing_left, "nothing_valid").when(partly, "partly_delivered").otherwise("delivered"),
        "error_message": error,
        "warnings": warnings,
        "planned_files": planned.cast("int"),
        "error_files": failed.cast("int"),
    })


def _phase(seconds: Column, measured: Column) -> Column:
    return F.when(measured, format_duration(seconds)).otherwise(NOT_MEASURED)


def run_summary(outcomes: DataFrame, totals: DataFrame) -> DataFrame:
    """One printable row per run: phases, throughput, sizes, files, status."""
    both = outcomes.join(totals, "process_id", "left")
    sp, write, duration = F.col("sp_s"), F.col("write_s"), F.col("duration_s")
    rows = F.coalesce("rows_written", F.lit(0))
    delivered = F.coalesce("files", F.lit(0))
    return both.select(
        "process_id",
        "job",
        parameter_summary(F.col("parameters")).alias("parameters"),
        F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        format_duration(duration).alias("total_duration"),
        _phase(sp, sp > 0).alias("extract_time"),
        _phase(write, write > 0).alias("write_time"),
        _phase(duration - sp - write, (sp > 0) & (write > 0)).alias("overhead"),
        format_count(F.col("total_rows")).alias("rows_read"),
        format_count(rows).alias("rows_written"),
        rows_per_second(rows, write).alias("rows_per_second"),
        format_bytes(F.coalesce("table_bytes", F.lit(0))).alias("total_table_size"),
        format_bytes(F.coalesce("file_bytes", F.lit(0))).alias("total_file_size"),
        "planned_files",
        delivered.alias("success_files"),
        "error_files",
        F.when(F.col("success"), "SUCCESS").otherwise("FAILED").alias("status"),
        "error_message",
        F.array_join("warnings", "; ").alias("warnings"),
    )
