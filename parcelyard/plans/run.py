"""One delivery run from request to audit row."""

from __future__ import annotations

import contextlib
import datetime as dt
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelyard.functions.errors import NOT_A_DATABASE_ERROR, collapse_messages
from parcelyard.functions.text import run_id
from parcelyard.operators.extract import Job, check_arguments, run_job
from parcelyard.operators.profile import apply_profile, profile_rules, quarantine
from parcelyard.operators.split import (
    SPLIT, SPLIT_ROW, capped_counts, capped_split, split_by_key, split_by_number, split_total,
)
from parcelyard.operators.staging import (
    BYTES, PART, POSITION, SEGMENT, SOURCE_FILE, SOURCE_ROW, StagedRows, broadcast_if_small, stage, store,
)
from parcelyard.operators.totals import run_totals
from parcelyard.operators.validate import (
    NothingToDeliver, deliverable_splits, skipped_tables, threshold_status, threshold_summary,
)
from parcelyard.plans.audit import append_audit, audit_rows
from parcelyard.plans.deliver import ROWS_PER_FILE, plan_delivery
from parcelyard.plans.outcome import run_outcome
from parcelyard.plans.publish import Published, publish_splits
from parcelyard.session import drop_path
from parcelyard.sources.catalog import family_tables, read_family

OUTPUT = "output"
_TABLE_NUMBER = "_table"
_PLAN_ROW_BYTES = 512  # generous size of a delivery plan row in memory
_FACTS = (
    "process_id string, job string, staging_table string, parameters array<struct<name: string, value: int>>, "
    "start_time timestamp_ntz, duration_s double, sp_s double, write_s double, total_rows long, splits int, "
    "violations int, policy string, threshold long, error_code int, error_detail string, rejects long, skipped array<string>"
)
_FILES = (
    "process_id string, file_index int, path string, table_name string, rows long, "
    "table_size_bytes long, file_size_bytes long, rejects long"
)


@dataclass(frozen=True)
class Delivery:
    """What a run left behind; ``warning`` tells when the audit row could not be written."""

    process_id: str
    outcome: DataFrame
    files: DataFrame
    rejects: DataFrame | None
    warning: str | None


def deliver(
    spark: SparkSession,
    job: Job,
    arguments: dict[str, int],
    output: str,
    policy: str = "all",
    prefix: str = "",
    started: dt.datetime | None = None,
    fmt: str = "parquet",
    one_file: bool = False,
    audit: bool = True,
    **sources: DataFrame,
) -> Delivery:
    """Run a job and deliver its rows, one folder per split, named like the planned outputs.

    Under ``output``: ``staging`` holds the extract in delivery order (replaced by each run),
    ``data/<prefix>_<ddMMyyyy>`` the delivered splits (replaced by a run on the same day, all at once, with the
    run's commit: see ``publish``), ``rejects/...`` the delivered splits' rows outside the target profile with
    split and position, ``audit`` one row per run, also when it is run again. An error ends the run, not the caller: it becomes the run's outcome and is audited
    like any other. Arguments that are no dates are refused before the run begins.
    """
    check_arguments(spark, job, arguments)
    started = started or dt.datetime.now()
    prefix = prefix.strip() or job.file_prefix
    batch = f"{prefix}_{started:%d%m%Y}"
    table = job.family or job.staging_table or job.name
    process_id = spark.range(1).select(
        run_id(F.lit(f"{job.name} {started} {sorted(arguments.items())}"), F.lit(str(started)).cast("timestamp_ntz"))
    ).first()[0]
    facts = {
        "process_id": process_id, "job": job.name, "staging_table": table,
        "parameters": list(arguments.items()), "start_time": started, "policy": policy, "threshold": job.threshold,
        "duration_s": 0.0, "sp_s": 0.0, "write_s": 0.0, "total_rows": 0, "splits": 0, "violations": 0, "rejects": 0,
        "error_code": None, "error_detail": None, "skipped": [],
    }
    files, rejects = spark.createDataFrame([], _FILES), None
    clock = time.monotonic()
    drop_path(spark, f"{output}/rejects/{batch}")  # those of an earlier run of the day
    try:
        with _timed(facts, "sp_s"):
            staged = _stage(spark, job, arguments, f"{output}/staging/{table}", sources)
        facts["total_rows"] = staged.total_rows
        if staged.total_rows:
            rows, status, splits = _divide(spark, job, staged.with_segments(), table)
            facts["splits"], facts["violations"] = splits, threshold_summary(status).first()["violations"]
            kept, facts["skipped"] = deliverable_splits(status, policy), skipped_tables(status, policy)
            if policy != "cancel" or not facts["violations"]:
                plan = plan_delivery(kept, prefix, started, f".{fmt}").withColumnRenamed("file_name", OUTPUT)
                target = f"{output}/data/{batch}"
                good, bad = quarantine(rows, profile_rules(rows.drop(SPLIT, SPLIT_ROW, SEGMENT)))
                names = broadcast_if_small(plan.select(SPLIT, OUTPUT), splits * _PLAN_ROW_BYTES)
                good = apply_profile(good, keep=(SPLIT, SPLIT_ROW, SEGMENT)).join(names, SPLIT)
                with _timed(facts, "write_s"):
                    done = publish_splits(
                        good, target, process_id, fmt, OUTPUT, one_file=one_file, rows_per_file=job.threshold or ROWS_PER_FILE
                    )
                # What was planned and not written did not fit: nothing is counted again.
                facts["rejects"] = (plan.agg(F.sum("row_count")).first()[0] or 0) - done.rows
                if facts["rejects"]:
                    # A second pass over the wide rows, made only when there is something to set aside.
                    bad = bad.join(names.select(SPLIT), SPLIT, "left_semi").drop(SEGMENT)
                    rejects = _set_aside(spark, bad, f"{output}/rejects/{batch}", facts["rejects"])
                files = _delivered(spark, plan, done, rejects, target, staged, process_id)
    except NothingToDeliver:
        pass  # the facts say so: every split violates
    except Exception as error:  # any failure is the run's outcome
        facts["error_code"], facts["error_detail"] = NOT_A_DATABASE_ERROR, _told(spark, error)
    facts["duration_s"] = time.monotonic() - clock
    outcome = run_outcome(spark.createDataFrame([facts], _FACTS))
    audit_row = audit_rows(outcome, run_totals(files), output).coalesce(1)
    warning = append_audit(audit_row, f"{output}/audit", audit, process_id)
    return Delivery(process_id, outcome, files, rejects, warning)


def _told(spark: SparkSession, error: BaseException | None) -> str:
    """The messages of an error and of those that caused it as one line."""
    messages = []
    while error is not None:
        messages.append(f"{type(error).__name__}: {error}")
        error = error.__cause__ or error.__context__
    line = spark.createDataFrame([(messages,)], "messages array<string>").select(collapse_messages(F.col("messages")))
    return line.first()[0]


@contextlib.contextmanager
def _timed(facts: dict, name: str) -> Iterator[None]:
    """Seconds of a phase, also of one that fails."""
    clock = time.monotonic()
    try:
        yield
    finally:
        facts[name] = time.monotonic() - clock


def _stage(
    spark: SparkSession, job: Job, arguments: dict[str, int], path: str, sources: dict[str, DataFrame]
) -> StagedRows:
    """Land the extract; put it in order only where the job asks for an order or splits by key."""
    if job.family:
        return store(read_family(spark, job.family, _TABLE_NUMBER, job.family_root), path, measure_bytes=True)
    extract = run_job(spark, job, arguments, **sources)
    order = list(dict.fromkeys([*([job.split_key] if job.split_key else []), *job.order_by]))
    if not order:
        return store(extract, path, measure_bytes=True, partitions=job.partitions)
    if job.order_by and job.unique_order:
        return stage(extract, order, path, measure_bytes=True, partitions=job.partitions)
    # Landed once, a row's task and place make the order total: a hot key is cut, and ties lie alike in every run
    # that reads the same files. File names hold a random id, so the numbers in them are taken.
    landing, name = store(extract), F.col("_metadata.file_name")
    task = F.regexp_extract(name, r"^part-(\d+)", 1).cast("long") * 1_000_000
    file = task + F.coalesce(F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("long"), F.lit(0))
    try:
        rows = landing.read().drop(PART, POSITION, BYTES)
        landed = rows.select("*", file.alias(SOURCE_FILE), F.col("_metadata.row_index").alias(SOURCE_ROW))
        return stage(landed, [*order, SOURCE_FILE, SOURCE_ROW], path, measure_bytes=True, partitions=job.partitions)
    finally:
        landing.drop()


def _divide(spark: SparkSession, job: Job, staged: StagedRows, table: str) -> tuple[DataFrame, DataFrame, int]:
    """Rows with split and place in it, the status of the splits, and their number."""
    if job.family:
        tables = family_tables(spark, job.family, job.family_root)
        divided = tables != [job.family]
        parts = split_by_number(staged, _TABLE_NUMBER, len(tables))
        # A table that was never divided is delivered whatever its size; the outcome warns.
        status = threshold_status(parts.splits, job.threshold, job.family, len(tables), strict_parity=not divided)
        if divided:
            status = status.withColumn("table_name", F.concat_ws("_", F.lit(job.family), SPLIT))
        return parts.rows, status, parts.count
    if job.split_key:
        parts = split_by_key(staged, job.split_key)
        rows = parts.rows.drop(SOURCE_FILE, SOURCE_ROW)
        return rows, threshold_status(parts.splits, job.threshold, table, parts.count), parts.count
    splits = split_total(staged.total_rows, job.threshold)
    counts = capped_counts(spark, staged.total_rows, job.threshold)
    rows = capped_split(staged, job.threshold).drop("row_index", SOURCE_FILE, SOURCE_ROW)
    return rows, threshold_status(counts, job.threshold, table, splits), splits


def _set_aside(spark: SparkSession, bad: DataFrame, path: str, expected: int) -> DataFrame:
    """Write the rows that do not fit; they and the rows written must be all rows."""
    found = Observation()
    bad.observe(found, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    if found.get["rows"] != expected:
        raise RuntimeError(f"{found.get['rows']} rows were set aside, but {expected} were not written")
    return spark.read.schema(bad.schema).parquet(path)


def _delivered(
    spark: SparkSession, plan: DataFrame, done: Published, rejects: DataFrame | None, target: str, staged: StagedRows, process_id: str
) -> DataFrame:
    """The run's files, one row per output: rows by plan and rejects, stored bytes by the commit."""
    stored = done.manifest.groupBy(F.col("output").alias(OUTPUT)).agg(F.sum("bytes").alias("stored"))
    found = plan.join(stored, OUTPUT, "left")
    if rejects is None:
        found = found.withColumn("rejects", F.lit(0).cast("long"))
    else:
        found = found.join(rejects.groupBy(SPLIT).agg(F.count("*").alias("rejects")), SPLIT, "left")
    row_size = staged.total_bytes / staged.total_rows
    set_aside = F.coalesce("rejects", F.lit(0))
    rows = found.select(
        F.lit(process_id).alias("process_id"),
        "file_index",
        F.concat(F.lit(f"{target}/{OUTPUT}="), OUTPUT).alias("path"),
        "table_name",
        (F.col("row_count") - set_aside).alias("rows"),
        F.round(F.col("row_count") * row_size).cast("long").alias("table_size_bytes"),
        F.coalesce("stored", F.lit(0)).alias("file_size_bytes"),
        set_aside.alias("rejects"),
    )
    return spark.createDataFrame(rows.collect(), _FILES)
