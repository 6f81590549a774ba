"""Parameterised extracts: date-range and month filters, request checks, named jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.functions.text import prefix_or_default


def _day(yyyymmdd: int) -> Column:
    return F.to_timestamp_ntz(F.lit(str(yyyymmdd)), F.lit("yyyyMMdd"))


def between_days(column: str, mon: int, mon1: int) -> Column:
    """``YYYYMMDD`` range, both days included. The bare column is compared, so it reaches the scan."""
    return (F.col(column) >= _day(mon)) & (F.col(column) < _day(mon1) + F.expr("interval 1 day"))


def in_month(column: str, mon: int) -> Column:
    """``YYYYMM`` month as a half-open range on the bare column."""
    first = _day(mon * 100 + 1)
    return (F.col(column) >= first) & (F.col(column) < first + F.expr("interval 1 month"))


def check_requests(requests: DataFrame) -> DataFrame:
    """Judge each run request: digits of ``mon``/``mon1``, their order, and whether they are dates.

    Reads request_id, has_mon1, mon, mon1, prefix, default_prefix; adds status, is_calendar_date
    and output_prefix.
    """
    mon, mon1 = F.col("mon"), F.col("mon1")
    digits = F.length(mon.cast("string"))
    digits1 = F.length(mon1.cast("string"))
    status = (
        F.when(F.col("has_mon1") & (F.coalesce(digits, F.lit(0)) != 8), "mon_not_8_digits")
        .when(~F.col("has_mon1") & (F.coalesce(digits, F.lit(0)) != 6), "mon_not_6_digits")
        .when(F.col("has_mon1") & (F.coalesce(digits1, F.lit(0)) != 8), "mon1_not_8_digits")
        .when(F.col("has_mon1") & (mon1 < mon), "mon1_before_mon")
        .otherwise("ok")
    )
    return requests.withColumns({
        "status": status,
        "is_calendar_date": F.when(F.col("has_mon1"), _is_day(mon) & _is_day(mon1)).otherwise(
            _is_day(mon.cast("long") * 100 + 1)
        ),
        "output_prefix": prefix_or_default(F.col("prefix"), F.col("default_prefix")),
    })


def _is_day(number: Column) -> Column:
    text = number.cast("string")
    iso = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.coalesce(text.rlike(r"^\d{8}$") & iso.try_cast("date").isNotNull(), F.lit(False))


@dataclass(frozen=True)
class Job:
    """A named extract: Spark SQL over ``{source}`` with integer parameters ``:mon``, ``:mon1``.

    Rows are delivered in ``order_by`` order, cut at ``threshold`` rows. Ties keep the order in which the extract was
    landed; ``unique_order`` tells that there are none and saves the landing. With ``split_key`` the
    job has divided them itself, one split per key value, and the threshold only judges them.
    With ``family`` the tables ``family_1``, ``family_2`` ... that something else has left
    behind are the splits, or ``family`` alone is the only one; no SQL is run. They are tables of the catalog or, with
    ``family_root``, parquet folders under it, which are read in one scan.
    ``partitions`` sizes the staging shuffle of a very large job.
    """

    name: str
    sql: str = ""
    parameters: tuple[str, ...] = ()
    file_prefix: str = ""
    threshold: int = 0
    order_by: tuple[str, ...] = ()
    unique_order: bool = False
    split_key: str | None = None
    family: str | None = None
    family_root: str | None = None
    staging_table: str = ""
    partitions: int | None = None


def job_from_manifest(manifest: DataFrame, name: str, sql: str, **options) -> Job:
    """The manifest's entry of that name (any case) as a job that runs ``sql``.

    ``options`` are the fields a manifest does not have: order_by, unique_order, split_key, family, family_root, partitions.
    """
    row = manifest.filter(F.lower("name") == name.lower()).orderBy("name", "staging_table").first()
    if row is None:
        raise LookupError(f"no job {name} in the manifest")
    return Job(
        name=row["name"], sql=sql, parameters=tuple(row["parameters"] or ()), file_prefix=row["file_prefix"] or "",
        threshold=row["threshold"] or 0, staging_table=row["staging_table"] or row["name"], **options,
    )


def check_arguments(spark: SparkSession, job: Job, arguments: dict[str, int]) -> None:
    """Refuse arguments of a date job that are not ``YYYYMMDD`` days in order, or a ``YYYYMM`` month."""
    if "mon" not in job.parameters:
        return
    request = (0, "mon1" in job.parameters, arguments.get("mon"), arguments.get("mon1"), "", "")
    columns = "request_id int, has_mon1 boolean, mon int, mon1 int, prefix string, default_prefix string"
    checked = check_requests(spark.createDataFrame([request], columns)).first()
    if checked["status"] != "ok":
        raise ValueError(f"job {job.name} refuses {arguments}: {checked['status']}")
    if not checked["is_calendar_date"]:
        raise ValueError(f"job {job.name} refuses {arguments}: not a date")


def run_job(spark: SparkSession, job: Job, arguments: dict[str, int], **sources: DataFrame) -> DataFrame:
    """The job's result for the given arguments; missing or extra arguments are an error."""
    if set(arguments) != set(job.parameters):
        raise ValueError(f"job {job.name} takes {job.parameters}, got {tuple(arguments)}")
    return spark.sql(job.sql, args=dict(arguments), **sources)
