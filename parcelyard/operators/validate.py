"""Row thresholds of splits and what to do when a split exceeds its threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.operators.split import SPLIT, table_name

POLICIES = ("all", "valid_only", "cancel")


class NothingToDeliver(ValueError):
    """Every split exceeds the threshold and the policy wants only valid ones."""


def threshold_status(
    counts: DataFrame, threshold: int | None, base: str, splits: int, strict_parity: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Counts per split judged against the threshold (strictly more rows exceed it).

    No threshold (None or 0) means no check. An undivided table is judged as well unless
    ``strict_parity``, which leaves single splits unchecked. ``keep`` names further columns of ``counts`` to keep.
    """
    active = bool(threshold) and (splits > 1 or not strict_parity)
    return counts.select(
        SPLIT,
        table_name(base, F.col(SPLIT), splits).alias("table_name"),
        "row_count",
        F.lit(threshold or 0).cast("long").alias("threshold"),
        (F.col("row_count") > threshold if active else F.lit(False)).alias("exceeds"),
        *keep,
    )


def threshold_summary(status: DataFrame) -> DataFrame:
    """Violations over all splits."""
    return status.agg(
        F.count("*").alias("splits"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("exceeds").cast("int")), F.lit(0)).alias("violations"),
        F.coalesce(F.bool_or("exceeds"), F.lit(False)).alias("has_violations"),
    )


def deliverable_splits(status: DataFrame, policy: str) -> DataFrame:
    """The splits a policy lets through: all, those within the threshold, or none on a violation."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if policy == "all":
        return status
    totals = threshold_summary(status).first()
    if policy == "cancel":
        return status.filter(F.lit(not totals["has_violations"]))
    if totals["splits"] and totals["violations"] == totals["splits"]:
        raise NothingToDeliver("All split tables exceed the threshold — no tables to process.")
    return status.filter(~F.col("exceeds"))


def deliverable_rows(rows: DataFrame, status: DataFrame, policy: str) -> DataFrame:
    """Rows of the deliverable splits."""
    if policy == "all":
        return rows
    return rows.join(deliverable_splits(status, policy).select(SPLIT), SPLIT, "left_semi")


def deliverable_keys(status: DataFrame, policy: str, key: str) -> DataFrame:
    """Number and key of the splits that a policy lets through, from a status that has the key: one row per split."""
    return deliverable_splits(status, policy).select(F.col(SPLIT), F.col(key).alias("_key"))


def rows_of_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys`` (``_key``; NULL is a key), before anything is sorted or written.

    A policy that skips splits so skips their rows in the scan of the source.
    """
    return rows.join(keys, rows[key].eqNullSafe(keys["_key"]), "left_semi")


def skipped_tables(status: DataFrame, policy: str) -> list[str]:
    """Names of the split tables that a policy leaves out, in split order; one row per skipped split reaches the driver."""
    if policy != "valid_only":
        return []
    skipped = status.filter("exceeds").select(SPLIT, "table_name").collect()
    return [r["table_name"] for r in sorted(skipped)]


def oversize_warning(total_rows: Column, threshold: Column, table: Column) -> Column:
    """Text for an undivided table above its threshold, else NULL."""
    return F.when(
        (threshold > 0) & (total_rows > threshold),
        F.concat(
            F.lit("Staging table ["), table, F.lit("] has "), F.format_number(total_rows, 0),
            F.lit(" rows (threshold: "), F.format_number(threshold, 0), F.lit(")."),
        ),
    )
