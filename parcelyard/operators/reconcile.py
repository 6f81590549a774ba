"""Job registry against database catalog: compare, repair, and merge with a master list.

A registry has name, display_name, data_type, staging_table, parameters (array), file_prefix and
threshold; a catalog is the result of ``catalog_snapshot``. All joins are equi joins on the
lower-case name with one catalog row per name, so they scale with the registry and cannot fan out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.functions.text import format_count, infer_data_type, infer_display_name, infer_file_prefix
from parcelyard.sources.catalog import name_key
from parcelyard.sources.manifest import STAGING_PLACEHOLDER

# Detail texts of a comparison; "{}" is filled in.
NOT_IN_DATABASE = "Stored procedure does not exist in database."
MISSING_PARAMS = "Parameters in JSON but NOT in DB: @{}"
EXTRA_PARAMS = "Parameters in DB but NOT in JSON: @{}"
NO_SOURCE_THRESHOLD = "Threshold defined in JSON ({}) but no threshold logic found in SP source."
THRESHOLD_DIFFERS = "Threshold MISMATCH: JSON={}  DB={}"
NOT_IN_REGISTRY = "Threshold found in SP source ({}) but not defined in JSON."

_EMPTY = "array<string>"


def _fill(text: str, *values: Column) -> Column:
    pieces = text.split("{}")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        parts += [value, F.lit(piece)]
    return F.concat(*parts)


def _lowered(names: Column) -> Column:
    return F.transform(F.coalesce(names, F.array().cast(_EMPTY)), lambda n: F.lower(n))


def compare(registry: DataFrame, catalog: DataFrame) -> DataFrame:
    """Each registry entry with its catalog counterpart, status, differences and detail texts.

    MISSING when the catalog has no such name; MISMATCH when the parameter names differ as sets or
    the thresholds differ; else VALID. Thresholds are compared only where the catalog holds the
    routine's source, and a threshold of 0 counts as none.
    """
    known = catalog.select(
        "key", F.col("name").alias("db_name"), F.col("params").alias("db_params"), "has_source", "db_threshold"
    )
    joined = registry.withColumn("key", name_key(F.col("name"))).join(known, "key", "left")
    exists = F.col("db_name").isNotNull()
    wanted, found = _lowered(F.col("parameters")), _lowered(F.col("db_params"))
    joined = joined.withColumns({
        "missing_params": F.when(exists, F.array_except(wanted, found)),
        "extra_params": F.when(exists, F.array_except(found, wanted)),
    })
    ours = F.coalesce("threshold", F.lit(0))
    theirs = F.col("db_threshold")
    checked = exists & F.col("has_source")
    params_match = exists & (F.size("missing_params") == 0) & (F.size("extra_params") == 0)
    threshold_match = F.when((ours > 0), ours.eqNullSafe(theirs)).otherwise(theirs.isNull())
    details = F.array_compact(F.array(
        F.when(~exists, F.lit(NOT_IN_DATABASE)),
        F.when(F.size("missing_params") > 0, _fill(MISSING_PARAMS, F.array_join("missing_params", ", @"))),
        F.when(F.size("extra_params") > 0, _fill(EXTRA_PARAMS, F.array_join("extra_params", ", @"))),
        F.when(checked & (ours > 0) & theirs.isNull(), _fill(NO_SOURCE_THRESHOLD, ours.cast("string"))),
        F.when(
            checked & (ours > 0) & theirs.isNotNull() & (ours != theirs),
            _fill(THRESHOLD_DIFFERS, format_count(ours), format_count(theirs)),
        ),
        F.when(checked & (ours <= 0) & theirs.isNotNull(), _fill(NOT_IN_REGISTRY, format_count(theirs))),
    ))
    return joined.select(
        *registry.columns,
        F.when(~exists, "MISSING")
        .when(~params_match | (checked & ~threshold_match), "MISMATCH")
        .otherwise("VALID").alias("status"),
        exists.alias("in_database"),
        params_match.alias("params_match"),
        F.coalesce(checked & threshold_match, F.lit(False)).alias("threshold_match"),
        F.coalesce("has_source", F.lit(False)).alias("has_source"),
        "db_params",
        "db_threshold",
        "missing_params",
        "extra_params",
        details.alias("details"),
    )


def param_differences(compared: DataFrame) -> DataFrame:
    """One row per parameter that only one side has."""
    sides = F.array_union(
        F.transform("missing_params", lambda p: F.struct(F.lit("registry_only").alias("side"), p.alias("param"))),
        F.transform("extra_params", lambda p: F.struct(F.lit("catalog_only").alias("side"), p.alias("param"))),
    )
    return compared.select("name", F.inline(sides))


def status_summary(compared: DataFrame) -> DataFrame:
    """Counts by status, zero where none, and the overall verdict."""

    def having(status: str) -> Column:
        return F.count(F.when(F.col("status") == status, 1))

    return compared.agg(
        F.count("*").alias("total"),
        having("VALID").alias("valid"),
        having("MISSING").alias("missing"),
        having("MISMATCH").alias("mismatch"),
        F.coalesce(F.bool_or(F.col("status") != "VALID"), F.lit(False)).alias("failed"),
    )


def autofix(compared: DataFrame) -> DataFrame:
    """The registry after repair: mismatched entries take the catalog's parameters and threshold.

    MISSING entries stay as they are, and so does the threshold of an entry whose source the
    catalog does not hold. A defined threshold without counterpart becomes 0.
    """
    broken = F.col("status") == "MISMATCH"
    new_threshold = F.when(F.col("db_threshold").isNotNull(), F.col("db_threshold")).when(
        F.col("threshold").isNotNull(), F.lit(0).cast("long")
    )
    kept = [c for c in ("name", "display_name", "data_type", "staging_table", "file_prefix") if c in compared.columns]
    return compared.select(
        *kept,
        F.when(broken & ~F.col("params_match"), F.col("db_params")).otherwise(F.col("parameters")).alias("parameters"),
        F.when(broken & F.col("has_source") & ~F.col("threshold_match"), new_threshold)
        .otherwise(F.col("threshold")).alias("threshold"),
        broken.alias("fixed"),
    )


def sync(registry: DataFrame, catalog: DataFrame, master: DataFrame) -> DataFrame:
    """Merge a master list of names into the registry, one row per resulting entry with ``status``.

    A listed name unknown to the catalog is MISSING_IN_DB; a registered one keeps its entry. A listed name new
    to the registry is ADDED with inferred fields; a registered one is UPDATED when parameters
    (in order) or threshold differ from the catalog, else UNMODIFIED. Registry entries that are
    not listed are RETAINED. ``registered`` tells whether the registry had the name. Master names come from ``master_list``: one per name in any case.
    """
    keyed = registry.withColumn("key", name_key(F.col("name")))
    # Of several entries of one name the first in column order counts; min() combines them map-side.
    entry_struct = F.struct("name", *[c for c in registry.columns if c != "name"])
    old = (
        keyed.groupBy("key").agg(F.min(entry_struct).alias("old"))
        .select("key", *[F.col(f"old.{c}").alias(f"old_{c}") for c in registry.columns])
    )
    listed = (
        master.select("key", F.col("name").alias("listed_name"))
        .join(catalog.select("key", F.col("name").alias("db_name"), "params", "db_threshold"), "key", "left")
        .join(old, "key", "left")
    )
    known, present = F.col("db_name").isNotNull(), F.col("old_name").isNotNull()
    old_params = F.coalesce("old_parameters", F.array().cast(_EMPTY))
    params_differ = known & (_lowered(F.col("old_parameters")) != _lowered(F.col("params")))
    threshold_differs = known & (F.coalesce("old_threshold", F.lit(0)) != F.coalesce("db_threshold", F.lit(0)))
    status = (
        F.when(~known, "MISSING_IN_DB")
        .when(~present, "ADDED")
        .when(params_differ | threshold_differs, "UPDATED")
        .otherwise("UNMODIFIED")
    )

    def entry(added: Column, updated: Column) -> Column:
        return F.when(present, updated).when(known, added)

    merged_threshold = (
        F.when(~threshold_differs, F.col("old_threshold"))
        .when(F.col("db_threshold").isNotNull(), F.col("db_threshold"))
        .otherwise(F.lit(0).cast("long"))
    )
    processed = listed.select(
        F.when(present, F.col("old_name")).when(~known, F.col("listed_name")).otherwise(F.col("db_name")).alias("name"),
        status.alias("status"),
        entry(infer_display_name(F.col("db_name")), F.col("old_display_name")).alias("display_name"),
        entry(infer_data_type(F.col("db_name")), F.col("old_data_type")).alias("data_type"),
        entry(F.lit(STAGING_PLACEHOLDER), F.col("old_staging_table")).alias("staging_table"),
        entry(F.col("params"), F.when(params_differ, F.col("params")).otherwise(old_params)).alias("parameters"),
        entry(infer_file_prefix(F.col("db_name")), F.col("old_file_prefix")).alias("file_prefix"),
        entry(F.col("db_threshold"), merged_threshold).alias("threshold"),
        present.alias("registered"),
    )
    retained = keyed.join(master.select("key"), "key", "left_anti").withColumns({"status": F.lit("RETAINED"), "registered": F.lit(True)})
    return processed.unionByName(retained.select(*processed.columns))


def synced_registry(synced: DataFrame) -> DataFrame:
    """The registry to write back: every entry that the merge keeps, updates or adds; none that was registered goes."""
    return synced.filter((F.col("status") != "MISSING_IN_DB") | F.col("registered")).drop("status", "registered")


def sync_summary(synced: DataFrame) -> DataFrame:
    """Counts by status, zero where none; ``changed`` tells whether a write-back is due."""

    def having(*statuses: str) -> Column:
        return F.count(F.when(F.col("status").isin(*statuses), 1))

    return synced.agg(
        having("ADDED", "UPDATED", "UNMODIFIED", "MISSING_IN_DB").alias("listed"),
        having("ADDED").alias("added"),
        having("RETAINED").alias("retained"),
        having("UPDATED").alias("updated"),
        having("UNMODIFIED").alias("unmodified"),
        having("MISSING_IN_DB").alias("missing_in_db"),
        F.coalesce(F.bool_or(F.col("status").isin("ADDED", "UPDATED")), F.lit(False)).alias("changed"),
    )
