"""Formatting and parsing of names, sizes, durations and summaries, as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units by power of 1024, run-id alphabet (no I and no O), the pattern that
# carries a row threshold in job source text, and the markers of export and import jobs.
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB", "EB"]
RUN_ID_ALPHABET = "ABCDEFGHJKLMNPQRSTUVWXYZ0123456789"
THRESHOLD_PATTERN = r"(?i)if\s+@cnt\s*>\s*(\d+)"
EXPORT_MARK = "_EXP_"
IMPORT_MARK = "_IMP_"


def format_bytes(size: Column) -> Column:
    """``1536`` -> ``1.5 KB``: base 1024, two decimals rounded half to even, no trailing zeros."""
    magnitude = F.abs(size.cast("double"))
    power = F.floor(F.log(magnitude) / F.log(F.lit(1024.0)))
    scaled = F.rint(magnitude / F.pow(F.lit(1024.0), power) * 100) / 100
    digits = F.regexp_replace((F.signum(size.cast("double")) * scaled).cast("string"), r"\.0$", "")
    unit = F.element_at(F.array(*map(F.lit, SIZE_UNITS)), (power + 1).cast("int"))
    return F.when(size == 0, F.lit("0 B")).when(size.isNotNull(), F.concat(digits, F.lit(" "), unit))


def format_duration(seconds: Column) -> Column:
    """``65`` -> ``1m 05s``; below a minute ``12.3s``."""
    whole = F.floor(seconds).cast("long")
    return F.when(
        seconds >= 60,
        F.format_string("%dm %02ds", F.floor(whole / 60).cast("long"), (whole % 60).cast("long")),
    ).when(seconds.isNotNull(), F.format_string("%.1fs", seconds))


def format_count(n: Column) -> Column:
    """Integer with thousands separators."""
    return F.format_number(n, 0)


def base_name(path: Column) -> Column:
    """File name after the last slash or backslash."""
    return F.regexp_extract(path, r"[^/\\]*$", 0)


def parameter_summary(parameters: Column) -> Column:
    """``[(mon, 1), (mon1, 2)]`` -> ``@mon=1, @mon1=2`` for an array of (name, value) structs."""
    return F.concat_ws(
        ", ",
        F.transform(parameters, lambda p: F.concat(F.lit("@"), p["name"], F.lit("="), p["value"].cast("string"))),
    )


def run_id(seed: Column, started: Column, prefix: str = "RUN") -> Column:
    """Prefix, hour and minute of the start, then six characters drawn from a digest of the seed."""
    digest = F.md5(seed)
    picks = [
        F.substr(
            F.lit(RUN_ID_ALPHABET),
            (F.conv(F.substr(digest, F.lit(1 + 4 * i), F.lit(4)), 16, 10).cast("int") % len(RUN_ID_ALPHABET)) + 1,
            F.lit(1),
        )
        for i in range(6)
    ]
    return F.concat(F.lit(prefix), F.date_format(started, "HHmm"), *picks)


def threshold_from_source(source: Column) -> Column:
    """Row threshold written in a job's source text, NULL when there is none."""
    return F.nullif(F.regexp_extract(source, THRESHOLD_PATTERN, 1), F.lit("")).try_cast("bigint")


def strip_at(name: Column) -> Column:
    """Parameter name without its leading ``@``."""
    return F.regexp_replace(name, "^@+", "")


def _marked(name: Column, mark: str) -> Column:
    return F.contains(F.upper(name), F.lit(mark))


def infer_data_type(name: Column) -> Column:
    return F.when(_marked(name, EXPORT_MARK), "Export").when(_marked(name, IMPORT_MARK), "Import").otherwise("Unknown")


def infer_display_name(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(" "))


def infer_file_prefix(name: Column) -> Column:
    return (
        F.when(_marked(name, EXPORT_MARK), F.regexp_replace(name, f"(?i).*{EXPORT_MARK}", "Export_"))
        .when(_marked(name, IMPORT_MARK), F.regexp_replace(name, f"(?i).*{IMPORT_MARK}", "Import_"))
        .otherwise(name)
    )


def prefix_or_default(prefix: Column, default: Column) -> Column:
    """Trimmed prefix, or the job's own when blank."""
    return F.coalesce(F.nullif(F.regexp_replace(prefix, r"^\s+|\s+$", ""), F.lit("")), default)
