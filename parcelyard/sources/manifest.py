"""Job manifests: read, check, write back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.operators.staging import stage

# The manifest's shape, the allowed data types, and the placeholder that an added
# job carries until somebody names its staging table.
MANIFEST_SCHEMA = (
    "StoredProcedures array<struct<Name: string, DisplayName: string, DataType: string, "
    "StagingTable: string, Parameters: array<string>, FilePrefix: string, Threshold: bigint>>"
)
DATA_TYPES = ["Import", "Export"]
STAGING_PLACEHOLDER = "TODO_FILL_THIS_IN"

_COLUMNS = {
    "name": "Name",
    "display_name": "DisplayName",
    "data_type": "DataType",
    "staging_table": "StagingTable",
    "parameters": "Parameters",
    "file_prefix": "FilePrefix",
    "threshold": "Threshold",
}


def read_manifest(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """One row per job of the manifest files under ``path``.

    Each file holds one document, which may begin with a byte-order mark. With
    ``one_per_file=False`` each line is a document, and large files are read in pieces.
    """
    documents = spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=one_per_file)
    jobs = documents.select(F.explode("StoredProcedures").alias("job"))
    return jobs.select(*[F.col("job")[source].alias(name) for name, source in _COLUMNS.items()])


def check_manifest(jobs: DataFrame) -> DataFrame:
    """Jobs with the rules they break; a manifest without jobs is judged by ``has_jobs``."""

    def blank(name: str) -> Column:
        return F.coalesce(F.trim(F.col(name)) == "", F.lit(True))

    rules = {
        "name_missing": blank("name"),
        "display_name_missing": blank("display_name"),
        "data_type_invalid": F.coalesce(~F.col("data_type").isin(DATA_TYPES), F.lit(True)),
        "staging_table_missing": blank("staging_table"),
        "staging_table_placeholder": F.col("staging_table") == STAGING_PLACEHOLDER,
        "parameters_missing": F.col("parameters").isNull() | (F.size("parameters") == 0),
        "file_prefix_missing": blank("file_prefix"),
        "threshold_negative": F.col("threshold") < 0,
    }
    failed = F.array_compact(F.array(*[F.when(broken, F.lit(rule)) for rule, broken in rules.items()]))
    return jobs.withColumn("failed_rules", failed)


def has_jobs(jobs: DataFrame) -> bool:
    return not jobs.isEmpty()


def write_manifest(jobs: DataFrame, path: str, jobs_per_document: int = 500) -> None:
    """Write jobs as manifest documents, one per line and sorted by name, at a new ``path``.

    The manifest that was read is never overwritten in place: callers switch to the new path once
    the write is complete. Documents are cut by row number, so none grows with the registry.
    """
    entry = F.struct(*[F.col(name).alias(source) for name, source in _COLUMNS.items()])
    (
        stage(jobs.select(*_COLUMNS), ["name", "staging_table"]).indexed()
        .groupBy(F.expr(f"(row_index - 1) div {jobs_per_document}").alias("document"))
        .agg(F.sort_array(F.collect_list(F.struct("row_index", entry.alias("job")))).alias("jobs"))
        .select(F.col("jobs.job").alias("StoredProcedures"))
        .write.mode("errorifexists").json(path)
    )
