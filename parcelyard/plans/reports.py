"""Printable reports as tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.functions.text import base_name, format_bytes, format_count
from parcelyard.operators.split import SPLIT


def threshold_report(status: DataFrame) -> DataFrame:
    """Splits with their status, and a footer with the total and how many exceed.

    ``status`` has one row per split, numbered 1..n; the footer comes from a rollup.
    """
    lines = status.withColumn("split", F.struct(SPLIT, "table_name")).rollup("split").agg(
        F.grouping("split").alias("is_footer"),
        F.sum("row_count").alias("rows"),
        F.sum(F.col("exceeds").cast("int")).alias("violations"),
        F.count("*").alias("tables"),
    )
    footer = F.col("is_footer") == 1
    return lines.select(
        F.when(footer, "").otherwise(F.col(f"split.{SPLIT}").cast("string")).alias("index"),
        F.when(footer, "Total").otherwise(F.col("split.table_name")).alias("table_name"),
        format_count(F.col("rows")).alias("row_count"),
        F.when(footer, F.format_string("%d of %d exceed", "violations", "tables"))
        .when(F.col("violations") > 0, "EXCEEDS").otherwise("OK").alias("status"),
    )


def delivered_files(files: DataFrame) -> DataFrame:
    """One line per delivered file: name, source table, rows and both sizes."""
    return files.select(
        "process_id",
        "file_index",
        base_name(F.col("path")).alias("file_name"),
        "table_name",
        format_count(F.col("rows")).alias("rows"),
        format_bytes(F.col("table_size_bytes")).alias("table_size"),
        format_bytes(F.col("file_size_bytes")).alias("file_size"),
    )


def reconcile_report(compared: DataFrame) -> DataFrame:
    """One row per registry entry with what was compared and every detail text."""
    lowered = F.transform(F.coalesce("parameters", F.array().cast("array<string>")), lambda p: F.lower(p))
    db_lowered = F.transform("db_params", lambda p: F.lower(p))

    def yes(flag: str) -> Column:
        return F.when(F.col(flag), "Yes").otherwise("No")

    found = F.col("in_database")
    return compared.select(
        "status",
        "name",
        "display_name",
        yes("in_database").alias("exists"),
        F.when(found, F.array_join(lowered, ", ")).alias("json_params"),
        F.when(found, F.array_join(db_lowered, ", ")).alias("db_params"),
        F.when(found, yes("params_match")).alias("params_match"),
        F.when(found & (F.col("threshold") > 0), format_count(F.col("threshold"))).alias("json_threshold"),
        F.when(found, format_count(F.col("db_threshold"))).alias("db_threshold"),
        F.when(found, yes("threshold_match")).alias("threshold_ok"),
        F.array_join("details", "\n").alias("details"),
    )


def report_text(report: DataFrame) -> DataFrame:
    """The reconcile report as printable text, one block of lines per entry."""

    def line(label: str, column: str) -> Column:
        return F.concat(F.lit(f"  {label:<14}: "), F.col(column))  # NULL, and so left out, where not compared

    note = F.when(F.col("details") != "", F.concat(F.lit("  ! "), F.replace("details", F.lit("\n"), F.lit("\n  ! "))))
    return report.select("name", F.concat_ws(
        "\n",
        F.concat(F.rpad(F.concat(F.lit("["), F.col("status"), F.lit("]")), 11, " "), F.col("name")),
        line("Display Name", "display_name"),
        line("SP Exists", "exists"),
        line("JSON Params", "json_params"),
        line("DB Params", "db_params"),
        line("Params Match", "params_match"),
        line("JSON Threshold", "json_threshold"),
        line("DB Threshold", "db_threshold"),
        line("Threshold OK", "threshold_ok"),
        note,
    ).alias("text"))


def write_report(report: DataFrame, base: str, when: dt.datetime, fmt: str = "json") -> str:
    """Write a report sorted by name into a new folder named after the time, as ``json`` or ``text``."""
    path = f"{base.rstrip('/')}/validation_report_{when:%Y%m%d_%H%M%S}"
    if fmt == "text":
        report_text(report).orderBy("name").select("text").write.mode("errorifexists").text(path)
    else:
        report.orderBy("name").write.mode("errorifexists").format(fmt).save(path)
    return path
