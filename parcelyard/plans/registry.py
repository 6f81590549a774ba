"""The maintenance runs over a job manifest: compare it with the catalog, merge a master list into it.

``reconcile_manifest`` and ``sync_manifest`` read a manifest and write a new one beside it. ``Registry`` keeps the manifest as
numbered versions in a folder: its runs read the latest, and what they write becomes the next only if nobody else
has published one since (``versions.LostRace`` otherwise, with nothing changed). ``reconcile_delta`` compares again only
the names that have changed on either side since the last comparison.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from parcelyard import versions
from parcelyard.operators.reconcile import autofix, compare, status_summary, sync, sync_summary, synced_registry
from parcelyard.plans.reports import reconcile_report, write_report
from parcelyard.session import drop_path, scratch_path
from parcelyard.sources.catalog import catalog_snapshot, master_list, name_key, only_named
from parcelyard.sources.manifest import has_jobs, read_manifest, write_manifest


@dataclass(frozen=True)
class Catalog:
    """What the database knows: routines(name), params(name, position, param), source(name, source)."""

    routines: DataFrame
    params: DataFrame
    source: DataFrame

    def snapshot(self, wanted: DataFrame) -> DataFrame:
        """The named routines only, with parameters and threshold."""
        return catalog_snapshot(*(only_named(table, wanted) for table in (self.routines, self.params, self.source)))


@dataclass(frozen=True)
class Reconciled:
    """Result of a comparison; ``fixed_manifest`` is set when a repaired manifest was written."""

    compared: DataFrame
    summary: Row
    report: str
    fixed_manifest: str | None

    @property
    def failed(self) -> bool:
        return self.summary["failed"]


def reconcile_manifest(
    spark: SparkSession,
    manifest: str,
    catalog: Catalog,
    report_dir: str,
    fix_to: str | None = None,
    when: dt.datetime | None = None,
    report_format: str = "text",
    one_per_file: bool = True,
) -> Reconciled:
    """Compare a manifest with the catalog and write a report of the state found.

    With ``fix_to``, and only when something mismatches, the repaired manifest is written there.
    """
    jobs = _jobs(spark, manifest, one_per_file)
    compared = compare(jobs, catalog.snapshot(jobs))
    summary = status_summary(compared).first()
    report = write_report(reconcile_report(compared), report_dir, when or dt.datetime.now(), report_format)
    fixed = fix_to if fix_to and summary["mismatch"] else None
    if fixed:
        write_manifest(autofix(compared), fixed)
    return Reconciled(compared, summary, report, fixed)


@dataclass(frozen=True)
class Synced:
    """Result of a merge; ``manifest`` is the path to use from now on."""

    entries: DataFrame
    summary: Row
    manifest: str


def sync_manifest(
    spark: SparkSession, manifest: str, names: str, catalog: Catalog, write_to: str, one_per_file: bool = True
) -> Synced:
    """Merge the master list at ``names`` into a manifest; write the result only if something changed."""
    master = master_list(spark.read.text(names))
    if master.isEmpty():
        raise ValueError(f"the master list {names} is empty")
    jobs = read_manifest(spark, manifest, one_per_file)
    entries = sync(jobs, catalog.snapshot(master), master)
    summary = sync_summary(entries).first()
    if summary["changed"]:
        write_manifest(synced_registry(entries), write_to)
    return Synced(entries, summary, write_to if summary["changed"] else manifest)


def _jobs(spark: SparkSession, manifest: str, one_per_file: bool) -> DataFrame:
    jobs = read_manifest(spark, manifest, one_per_file)
    if not has_jobs(jobs):
        raise ValueError(f"no jobs in the manifest {manifest}")
    return jobs


@dataclass(frozen=True)
class Registry:
    """A job manifest as numbered versions in ``folder``."""

    spark: SparkSession
    folder: str

    def version(self) -> int:
        return versions.latest(self.spark, self.folder)

    def read(self, version: int | None = None) -> DataFrame:
        """The jobs of a version, by default the latest."""
        version = version or self.version()
        if not version:
            raise FileNotFoundError(f"no version of the registry in {self.folder}")
        return read_manifest(self.spark, versions.version_path(self.folder, version), one_per_file=False)

    def publish(self, jobs: DataFrame, read: int) -> int:
        """Write ``jobs`` as the version after the one that was read."""
        prepared = f"{self.folder}/.prepared-{uuid.uuid4().hex}"
        write_manifest(jobs, prepared)
        return versions.publish_prepared(self.spark, prepared, self.folder, read)


@dataclass(frozen=True)
class RegistryRun:
    """What a maintenance run found and did: its counts, the version it read and the one that is to be used from now on.

    ``exit_code`` is that of a comparison: 1 if anything was missing or mismatched when it looked, else 0; a merge gives 0.
    """

    summary: Row
    read: int
    version: int
    report: str | None = None

    @property
    def exit_code(self) -> int:
        return int("failed" in self.summary and self.summary["failed"])


def reconcile_run(registry: Registry, catalog: Catalog, report_dir: str, fix: bool = False, when: dt.datetime | None = None,
                  report_format: str = "text") -> RegistryRun:
    """Compare the latest version with the catalog and write a report of the state found; with ``fix``, publish the repair.

    A version is published only where something mismatched. Entries missing in the catalog stay.
    """
    read = registry.version()
    jobs = registry.read(read)
    if not has_jobs(jobs):
        raise ValueError(f"no jobs in the registry {registry.folder}")
    # Compared once and stored: the counts, the sorted report and the repair all read the stored rows.
    path = scratch_path(registry.spark, "compared")
    try:
        compare(jobs, catalog.snapshot(jobs)).write.parquet(path)
        compared = registry.spark.read.parquet(path)
        summary = status_summary(compared).first()
        report = write_report(reconcile_report(compared), report_dir, when or dt.datetime.now(), report_format)
        version = registry.publish(autofix(compared), read) if fix and summary["mismatch"] else read
    finally:
        drop_path(registry.spark, path)
    return RegistryRun(summary, read, version, report)


def sync_run(registry: Registry, names: DataFrame, catalog: Catalog) -> RegistryRun:
    """Merge a master list (lines of text) into the latest version; publish the result only if something was added or updated."""
    master = master_list(names)
    if master.isEmpty():
        raise ValueError("the master list is empty")
    read = registry.version()
    entries = sync(registry.read(read), catalog.snapshot(master), master)
    summary = sync_summary(entries).first()
    version = registry.publish(synced_registry(entries), read) if summary["changed"] else read
    return RegistryRun(summary, read, version)


_SIDE_COLUMNS = {
    "registry": ("name", "display_name", "data_type", "staging_table", "parameters", "file_prefix", "threshold"),
    "routines": ("name",), "params": ("name", "position", "param"), "source": ("name", "source"),
}


def _digests(jobs: DataFrame, catalog: Catalog) -> DataFrame:
    """Per name how many rows either side has of it, and sums of two hashes of them: the same whatever their order."""
    tables = {"registry": jobs, "routines": catalog.routines, "params": catalog.params, "source": catalog.source}
    hashed = None
    for side, table in tables.items():
        row = F.to_json(F.struct(F.lit(side).alias("side"), *_SIDE_COLUMNS[side]))
        one = table.select(name_key(F.col("name")).alias("key"), F.xxhash64(row).alias("h"), F.crc32(row.cast("binary")).alias("c"))
        hashed = one if hashed is None else hashed.unionByName(one)

    def total(column: str) -> Column:
        return F.sum(F.col(column).cast("decimal(30,0)")).cast("string")

    return hashed.filter("key is not null").groupBy("key").agg(F.concat_ws(":", F.count("*"), total("h"), total("c")).alias("digest"))


def reconcile_delta(jobs: DataFrame, catalog: Catalog, state: str) -> tuple[DataFrame, int]:
    """The comparison of ``jobs`` with the catalog, computed for changed names only; and how many those were.

    ``state`` is a folder of versions. Each holds, per name, the digest of all rows that the comparison depends on, and the
    comparison's rows. A name whose digest is that of the last version keeps its rows; one that is new, changed or gone
    on either side is compared again, and only such rows of the catalog are joined and their sources searched. The
    digests take one pass over both sides with partial sums; the result is published as the next version.
    """
    spark = jobs.sparkSession
    read = versions.latest(spark, state)
    digests = _digests(jobs, catalog)
    if not read:
        fresh, kept, changed = compare(jobs, catalog.snapshot(jobs)), None, digests.select("key")
    else:
        last = versions.version_path(state, read)
        old = spark.read.parquet(f"{last}/digests")
        pairs = digests.join(old.withColumnRenamed("digest", "old"), "key", "full")
        changed = pairs.filter(~F.col("digest").eqNullSafe(F.col("old"))).select("key")
        changed_jobs = jobs.join(changed, name_key(F.col("name")) == F.col("key"), "left_semi")
        fresh = compare(changed_jobs, catalog.snapshot(changed_jobs))
        kept = spark.read.parquet(f"{last}/compared")
        kept = kept.join(changed, name_key(F.col("name")) == F.col("key"), "left_anti")
    compared = fresh.withColumn("compared_again", F.lit(True))
    if kept is not None:
        compared = compared.unionByName(kept.withColumn("compared_again", F.lit(False)))
    prepared = f"{state}/.prepared-{uuid.uuid4().hex}"
    digests.write.parquet(f"{prepared}/digests")
    compared.write.parquet(f"{prepared}/compared")
    again = changed.count()
    version = versions.publish_prepared(spark, prepared, state, read)
    return spark.read.parquet(f"{versions.version_path(state, version)}/compared"), again
