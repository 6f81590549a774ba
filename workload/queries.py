"""One registered query per operator; each takes the session and the folder of the tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelyard.functions import coerce, errors, text
from parcelyard.operators import extract, profile, reconcile, split, staging, totals, validate
from parcelyard.plans import audit, deliver, outcome, publish, registry, reports, run
from parcelyard.session import scratch_path
from parcelyard.sources import catalog, manifest, tables
from parcelyard.streaming import capped
from workload import derived

ROW_CAP = 4000
BYTE_CAP = 262_144
STARTED = dt.datetime(2024, 3, 5, 9, 30)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _orders(spark, sf):
    return derived.table(spark, sf, "orders")


def _staged_orders(spark, sf):
    return staging.stage(_orders(spark, sf), ["o_orderdate", "o_orderkey"])


# ---- sources ------------------------------------------------------------------------------------


def _manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    manifest.write_manifest(derived.manifest_jobs(spark, sf), path, jobs_per_document=50)
    return manifest.read_manifest(spark, path, one_per_file=False)


@query
def manifest_scan(spark, sf):
    return _manifest(spark, sf).withColumn("parameters", F.array_join("parameters", ","))


@query
def manifest_checks(spark, sf):
    return manifest.check_manifest(_manifest(spark, sf)).select("name", F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def staging_scan(spark, sf):
    return tables.read_table(spark, f"{sf}/orders.parquet")


@query
def staging_count(spark, sf):
    return tables.count_rows(derived.table(spark, sf, "lineitem"))


def _snapshot(spark, sf):
    return catalog.catalog_snapshot(*derived.catalog_tables(spark, sf))


@query
def catalog_snapshot(spark, sf):
    return _snapshot(spark, sf).withColumn("params", F.array_join("params", ","))


@query
def family_discovery(spark, sf):
    return catalog.discover_families(*derived.family_names(spark, sf), limit=True)


@query
def family_ignored(spark, sf):
    return catalog.ignored_siblings(*derived.family_names(spark, sf), limit=True)


@query
def master_list(spark, sf):
    return catalog.master_list(derived.master_lines(spark, sf))


@query
def name_in_list(spark, sf):
    part = derived.table(spark, sf, "part").select(F.col("p_name").alias("name"), "p_partkey", "p_brand")
    wanted = derived.table(spark, sf, "part").filter("p_size > 45").select(F.upper("p_name").alias("name"))
    return catalog.only_named(part, wanted)


@query
def storage_size(spark, sf):
    return tables.storage_size(spark, sf, ".parquet")


@query
def logical_size(spark, sf):
    return tables.logical_size(_orders(spark, sf))


# ---- extract ------------------------------------------------------------------------------------

RANGE_JOB = extract.Job(
    name="Orders_By_Day",
    sql="""select * from {orders}
           where o_orderdate >= to_timestamp_ntz(string(:mon), 'yyyyMMdd')
             and o_orderdate < to_timestamp_ntz(string(:mon1), 'yyyyMMdd') + interval 1 day""",
    parameters=("mon", "mon1"),
    file_prefix="Day_Orders",
    threshold=ROW_CAP,
    order_by=("o_orderdate", "o_orderkey"),
)


@query
def extract_range(spark, sf):
    return extract.run_job(spark, RANGE_JOB, {"mon": 19960115, "mon1": 19970210}, orders=_orders(spark, sf))


@query
def extract_month(spark, sf):
    return derived.table(spark, sf, "lineitem").filter(extract.in_month("l_shipdate", 199606))


@query
def request_validation(spark, sf):
    return extract.check_requests(derived.requests(spark, sf)).select(
        "request_id", "mon", "mon1", "status", "is_calendar_date", "output_prefix"
    )


# ---- split --------------------------------------------------------------------------------------


@query
def capped_split(spark, sf):
    return split.capped_split(_staged_orders(spark, sf), ROW_CAP)


@query
def capped_split_counts(spark, sf):
    return split.split_counts(split.capped_split(_staged_orders(spark, sf), ROW_CAP))


@query
def capped_split_plan(spark, sf):
    """The same counts without placing a row: they follow from the row count."""
    return split.capped_counts(spark, _orders(spark, sf).count(), ROW_CAP)


@query
def capped_split_stored(spark, sf):
    """Rows in the order they are stored in: no shuffle at all."""
    return split.capped_split(staging.index_stored(spark, f"{sf}/orders.parquet"), ROW_CAP)


@query
def byte_capped_split_stored(spark, sf):
    table = staging.index_stored(spark, f"{sf}/documents.parquet", measure_bytes=True)
    return split.byte_capped_split(table, BYTE_CAP).select("doc_id", "n_chars", "row_bytes", "row_index", "split_id")


@query
def capped_split_copies(spark, sf):
    """The order key (ship date) is far from unique; file and row number break its ties."""
    rows = staging.with_source_position(derived.table(spark, sf, "lineitem"))
    staged = staging.stage(rows, ["l_shipdate", staging.SOURCE_FILE, staging.SOURCE_ROW])
    halves = split.capped_split(staged, ROW_CAP)
    return halves.groupBy("split_id").agg(
        F.count("*").alias("row_count"), F.min("l_shipdate").alias("first_date"), F.max("l_shipdate").alias("last_date")
    )


@query
def byte_capped_split(spark, sf):
    staged = staging.stage(derived.table(spark, sf, "documents"), ["doc_id"], measure_bytes=True)
    return split.byte_capped_split(staged, BYTE_CAP).select("doc_id", "n_chars", "row_bytes", "row_index", "split_id")


@query
def byte_capped_split_hard(spark, sf):
    staged = staging.stage(derived.table(spark, sf, "documents"), ["doc_id"], measure_bytes=True)
    rows = split.byte_capped_split(staged, BYTE_CAP + staged.max_row_bytes, hard=True)
    return rows.groupBy("split_id").agg(F.count("*").alias("row_count"), F.sum("row_bytes").alias("split_bytes"))


def _by_priority(spark, sf, staged=None):
    staged = staged or staging.stage(_orders(spark, sf), ["o_orderpriority", "o_orderkey"])
    return split.split_by_key(staged, "o_orderpriority")


@query
def presplit_by_key(spark, sf):
    return _by_priority(spark, sf).rows.select("o_orderkey", "o_orderpriority", "split_id", "split_row")


@query
def presplit_family(spark, sf):
    """Sibling tables left behind by something else, one per priority, are the splits as they stand."""
    numbers = split.key_counts(_orders(spark, sf), "o_orderpriority").select(F.col("o_orderpriority").alias("of"), F.col("split_id").alias("n"))
    root, orders = scratch_path(spark, "family"), _orders(spark, sf)
    numbers = staging.broadcast_if_small(numbers, numbers.count() * staging.LOOKUP_ROW_BYTES * 4)  # rows stay in their order
    numbered = orders.join(numbers, orders["o_orderpriority"].eqNullSafe(numbers["of"])).drop("of")
    catalog.write_family(numbered, root, "family_orders", "n")
    staged = staging.store(catalog.read_family(spark, "family_orders", "table_number", root))
    parts = split.split_by_number(staged, "table_number", len(catalog.family_tables(spark, "family_orders", root)))
    return parts.rows.select("o_orderkey", "o_orderpriority", "split_id", "split_row")


@query
def split_counts(spark, sf):
    return split.key_counts(_orders(spark, sf), "o_orderpriority")


@query
def capped_read(spark, sf):
    events = derived.table(spark, sf, "events")
    return split.first_rows(events, ["ts", "event_id"], events.count() * 2 // 5)


# ---- profile, coercion, quarantine --------------------------------------------------------------


@query
def profile_map(spark, sf):
    frames = [
        profile.profile_map(derived.table(spark, sf, t)).withColumn("table_name", F.lit(t))
        for t in ("documents", "events")
    ]
    return frames[0].unionByName(frames[1])


@query
def target_ddl(spark, sf):
    frames = [profile.target_ddl(derived.table(spark, sf, t), f"out]{t}") for t in derived.FLAT_TABLES]
    ddl = frames[0]
    for frame in frames[1:]:
        ddl = ddl.unionByName(frame)
    return ddl


def _coerced(spark, sf, fn):
    return derived.raw_values(spark, sf).select("id", "raw", fn(F.col("raw")).alias("value"))


@query
def coerce_double(spark, sf):
    return _coerced(spark, sf, coerce.to_double)


@query
def coerce_decimal(spark, sf):
    return _coerced(spark, sf, coerce.to_decimal)


@query
def coerce_integer(spark, sf):
    return _coerced(spark, sf, coerce.to_integer)


@query
def coerce_timestamp(spark, sf):
    return _coerced(spark, sf, coerce.to_datetime)


@query
def coerce_boolean(spark, sf):
    return _coerced(spark, sf, coerce.to_boolean)


@query
def coerce_text(spark, sf):
    vectors = derived.table(spark, sf, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000)).alias("scaled"),
        "label",
        (F.col("label") > 4).alias("high"),
    )
    return profile.apply_profile(vectors, keep=("vec_id",)).select(
        "vec_id",
        F.col("scaled").alias("scaled_text"),
        coerce.to_text(F.col("label"), T.IntegerType()).alias("label_text"),
        coerce.to_text(F.col("high"), T.BooleanType()).alias("high_text"),
    )


@query
def pad_missing_columns(spark, sf):
    shape = T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts", T.TimestampNTZType()),
    ])
    orders = _orders(spark, sf).withColumn("source", F.lit("orders"))
    events = derived.table(spark, sf, "events").withColumn("source", F.lit("events"))
    return profile.pad_to(orders, shape).unionByName(profile.pad_to(events, shape))


def _quarantined(spark, sf):
    staged = staging.stage(derived.quarantine_input(spark, sf), ["o_orderdate", "o_orderkey"])
    rows = split.capped_split(staged, ROW_CAP).drop("row_index")
    rules = profile.profile_rules(rows.drop("split_id", "split_row"))
    return profile.quarantine(rows, rules)


@query
def quarantine_good(spark, sf):
    good, _ = _quarantined(spark, sf)
    return profile.apply_profile(good, keep=("split_id", "split_row"))


@query
def quarantine_rejects(spark, sf):
    _, rejects = _quarantined(spark, sf)
    return rejects.select(
        "split_id", "split_row", F.array_join("reject_reasons", ",").alias("reject_reasons"), "o_orderkey", "big_key"
    )


# ---- validation and delivery --------------------------------------------------------------------


def _counted_status(spark, sf, keep_key=False):
    """The status of the splits from counts alone: a scan of the key column."""
    orders = _orders(spark, sf)
    counts = split.key_counts(orders, "o_orderpriority")
    sums = counts.agg(F.sum("row_count"), F.count("*")).first()
    keys = ("o_orderpriority",) if keep_key else ()
    return validate.threshold_status(counts, (sums[0] or 0) // 5, "ORDERS", sums[1], keep=keys)


@query
def threshold_status(spark, sf):
    return _counted_status(spark, sf)


@query
def threshold_summary(spark, sf):
    return validate.threshold_summary(_counted_status(spark, sf))


@query
def threshold_report(spark, sf):
    return reports.threshold_report(_counted_status(spark, sf))


def _delivered(spark, sf, policy):
    """The policy decides on counts; only rows that it lets through are put in order."""
    orders, status = _orders(spark, sf), _counted_status(spark, sf, keep_key=True)
    kept = validate.deliverable_keys(status, policy, "o_orderpriority")
    staged = staging.stage(validate.rows_of_keys(orders, kept, "o_orderpriority"), ["o_orderpriority", "o_orderkey"])
    rows = _by_priority(spark, sf, staged).rows.drop("split_id")
    return rows.join(kept, rows["o_orderpriority"].eqNullSafe(kept["_key"])).select("o_orderkey", "split_id", "split_row")


@query
def deliver_all(spark, sf):
    return _delivered(spark, sf, "all")


@query
def deliver_valid_only(spark, sf):
    return _delivered(spark, sf, "valid_only")


@query
def deliver_cancel(spark, sf):
    return _delivered(spark, sf, "cancel")


@query
def delivery_plan(spark, sf):
    kept = validate.deliverable_splits(_counted_status(spark, sf), "valid_only")
    return deliver.plan_delivery(kept, "Orders", STARTED, ".parquet").select(
        "split_id", "table_name", "row_count", "file_index", "file_name", "inner_table"
    )


def _round_trip(spark, sf, fmt, **options):
    path = scratch_path(spark, "delivery")
    rows = split.capped_split(_staged_orders(spark, sf), ROW_CAP).drop("row_index")
    deliver.write_splits(rows, path, fmt, options=options)
    schema = rows.drop("split_row").schema
    return deliver.read_splits(spark, path, fmt, schema, **options)


@query
def split_sink_roundtrip(spark, sf):
    return _round_trip(spark, sf, "parquet").groupBy("split_id").agg(
        F.count("*").alias("row_count"),
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
        F.sum("o_orderkey").alias("key_sum"),
    )


@query
def split_sink_csv(spark, sf):
    return _round_trip(spark, sf, "csv", header="true").select("o_orderkey", "o_orderdate", "o_orderpriority", "split_id")


@query
def split_sink_json(spark, sf):
    return _round_trip(spark, sf, "json").select("o_orderkey", "o_custkey", "o_orderstatus", "split_id")


@query
def split_sink_orc(spark, sf):
    return _round_trip(spark, sf, "orc").select("o_orderkey", "o_totalprice", "o_orderdate", "split_id")


# ---- runs, audit, reports -----------------------------------------------------------------------


@query
def run_totals(spark, sf):
    return totals.run_totals(derived.delivery_files(spark, sf))


@query
def delivered_files(spark, sf):
    return reports.delivered_files(derived.delivery_files(spark, sf))


@query
def run_outcome(spark, sf):
    return outcome.run_outcome(derived.run_facts(spark, sf)).select(
        "process_id", "success", "outcome", "error_message", F.array_join("warnings", "; ").alias("warnings"),
        "planned_files", "error_files",
    )


@query
def run_summary(spark, sf):
    outcomes = outcome.run_outcome(derived.run_facts(spark, sf))
    return outcome.run_summary(outcomes, totals.run_totals(derived.delivery_files(spark, sf)))


@query
def audit_rows(spark, sf):
    outcomes = outcome.run_outcome(derived.run_facts(spark, sf))
    path = scratch_path(spark, "audit")
    audit.append_audit(audit.audit_rows(outcomes, totals.run_totals(derived.delivery_files(spark, sf)), "/out"), path)
    return audit.read_audit(spark, path)


# ---- scalar functions ---------------------------------------------------------------------------


@query
def fmt_bytes(spark, sf):
    size = F.expr("""case when doc_id % 10 = 0 then 0L
        else n_chars * shiftleft(1L, 10 * cast(doc_id % 5 as int)) * if(doc_id % 10 = 3, -1, 1) end""")
    return derived.table(spark, sf, "documents").select("doc_id", size.alias("size")).withColumn(
        "size_text", text.format_bytes(F.col("size"))
    )


@query
def fmt_duration(spark, sf):
    return derived.table(spark, sf, "events").select("event_id", "value").withColumn(
        "duration", text.format_duration(F.col("value"))
    )


@query
def rule_extract(spark, sf):
    source = derived.catalog_tables(spark, sf)[2]
    return source.select("name", text.threshold_from_source(F.col("source")).alias("threshold"))


@query
def infer_metadata(spark, sf):
    names = derived.catalog_tables(spark, sf)[0].unionByName(
        derived.table(spark, sf, "part").select(F.concat_ws("_", "p_type", "p_partkey").alias("name"))
    )
    name = F.col("name")
    return names.select(
        "name",
        text.infer_data_type(name).alias("data_type"),
        text.infer_display_name(name).alias("display_name"),
        text.infer_file_prefix(name).alias("file_prefix"),
    )


@query
def error_classify(spark, sf):
    code = F.col("code")
    return derived.attempts(spark, sf).select(
        "event_id", "code", "attempt",
        errors.error_class(code).alias("error_class"),
        errors.error_message(code, F.col("detail")).alias("message"),
        errors.is_transient(code).alias("transient"),
    )


@query
def error_collapse(spark, sf):
    messages = F.coalesce("only_wrappers", "messages")
    return derived.attempts(spark, sf).select("event_id", errors.collapse_messages(messages).alias("message"))


# ---- reconcile ----------------------------------------------------------------------------------


def _compared(spark, sf):
    return reconcile.compare(derived.registry(spark, sf), _snapshot(spark, sf))


@query
def reconcile_status(spark, sf):
    return _compared(spark, sf).select(
        "name", "status", "in_database", "params_match", "threshold_match", "threshold", "db_threshold"
    )


@query
def reconcile_param_diff(spark, sf):
    return reconcile.param_differences(_compared(spark, sf))


@query
def reconcile_summary(spark, sf):
    return reconcile.status_summary(_compared(spark, sf))


@query
def reconcile_autofix(spark, sf):
    return reconcile.autofix(_compared(spark, sf)).select(
        "name", F.array_join("parameters", ",").alias("parameters"), "threshold", "fixed"
    )


@query
def reconcile_report(spark, sf):
    return reports.reconcile_report(_compared(spark, sf))


def _synced(spark, sf):
    master = catalog.master_list(derived.master_lines(spark, sf))
    return reconcile.sync(derived.registry(spark, sf), _snapshot(spark, sf), master)


@query
def reconcile_report_text(spark, sf):
    return reports.report_text(reports.reconcile_report(_compared(spark, sf)))


@query
def registry_sync(spark, sf):
    return _synced(spark, sf).drop("registered").withColumn("parameters", F.array_join("parameters", ","))


@query
def registry_sync_summary(spark, sf):
    return reconcile.sync_summary(_synced(spark, sf))


@query
def manifest_write_back(spark, sf):
    path = scratch_path(spark, "manifest")
    manifest.write_manifest(reconcile.synced_registry(_synced(spark, sf)), path)
    return manifest.read_manifest(spark, path, one_per_file=False).withColumn(
        "parameters", F.array_join("parameters", ",")
    )


def _catalog(spark, sf):
    return registry.Catalog(*derived.catalog_tables(spark, sf))


def _registry(spark, sf):
    store = registry.Registry(spark, scratch_path(spark, "registry"))
    store.publish(derived.registry(spark, sf), 0)
    return store


@query
def reconcile_run(spark, sf):
    """A comparison that repairs the registry, and the comparison after it: counts, versions, verdict."""
    store, reports_dir = _registry(spark, sf), scratch_path(spark, "reports")
    runs = [registry.reconcile_run(store, _catalog(spark, sf), reports_dir, fix=True, when=STARTED + dt.timedelta(days=n)) for n in range(2)]
    rows = [(n, r.read, r.version, r.exit_code, r.summary["valid"], r.summary["missing"], r.summary["mismatch"]) for n, r in enumerate(runs, 1)]
    return spark.createDataFrame(rows, "run int, read int, version int, exit_code int, valid long, missing long, mismatch long")


@query
def reconcile_report_written(spark, sf):
    """The report file of a run, read again."""
    done = registry.reconcile_run(_registry(spark, sf), _catalog(spark, sf), scratch_path(spark, "reports"), when=STARTED, report_format="json")
    return spark.read.json(done.report).select("status", "name", "details")


@query
def sync_run(spark, sf):
    """The registry after a merge run, which a second run leaves as it is."""
    store = _registry(spark, sf)
    runs = [registry.sync_run(store, derived.master_lines(spark, sf), _catalog(spark, sf)) for _ in range(2)]
    return store.read().select(
        "name", "display_name", "data_type", "staging_table", F.array_join("parameters", ",").alias("parameters"), "file_prefix",
        "threshold", F.lit(runs[0].version).alias("version"), F.lit(runs[1].version).alias("version_after"),
    )


@query
def reconcile_delta(spark, sf):
    """A comparison after a tenth of the registry has changed and some routines have come, from the state of the last one."""
    state, jobs, now = scratch_path(spark, "state"), derived.registry(spark, sf), _catalog(spark, sf)
    number = F.substring_index("name", "_", -1).cast("int")
    before = jobs.filter(number % 40 != 1).withColumn("threshold", F.when(number % 10 == 0, 1).otherwise(F.col("threshold")))
    then = registry.Catalog(now.routines.filter(number % 25 != 2), now.params, now.source)
    registry.reconcile_delta(before, then, state)
    return registry.reconcile_delta(jobs, now, state)[0].select(
        "name", "status", "in_database", "params_match", "threshold_match", "threshold", "db_threshold", "compared_again"
    )


# ---- whole runs ---------------------------------------------------------------------------------


def _year_run(spark, sf, output):
    arguments = {"mon": 19960101, "mon1": 19971231}
    return run.deliver(spark, RANGE_JOB, arguments, output, started=STARTED, orders=_orders(spark, sf))


@query
def delivery_run_rows(spark, sf):
    """Request to delivered files: which output holds which order."""
    output = scratch_path(spark, "run")
    files = _year_run(spark, sf, output).files.select("file_index", F.substring_index("path", "=", -1).alias("output"))
    folder = f"{output}/data/{RANGE_JOB.file_prefix}_{STARTED:%d%m%Y}"
    return spark.read.parquet(folder).join(files, "output").select("o_orderkey", "o_custkey", "file_index")


@query
def delivery_run_files(spark, sf):
    return _year_run(spark, sf, scratch_path(spark, "run")).files.select("file_index", "rows")


@query
def delivery_run_audit(spark, sf):
    """The audit row that a run appends, without its times."""
    output = scratch_path(spark, "run")
    done = _year_run(spark, sf, output)
    written = spark.read.parquet(f"{output}/audit").count()
    return done.outcome.select("total_rows", "splits", "violations", "rejects", F.lit(written).alias("audit_rows"))


@query
def delivery_ordered_read(spark, sf):
    """The rows of each output in the order in which the run delivers them, as its commit lists them."""
    output = scratch_path(spark, "run")
    files = _year_run(spark, sf, output).files.select("file_index", F.substring_index("path", "=", -1).alias("output"))
    folder = f"{output}/data/{RANGE_JOB.file_prefix}_{STARTED:%d%m%Y}"
    return publish.read_ordered(spark, folder, "output").join(files, "output").select(
        "file_index", "row_number", "o_orderkey", "o_custkey"
    )


@query
def delivery_run_rejects(spark, sf):
    """Written and rejected rows of each output of a run whose rows mostly do not fit."""
    job = extract.Job("Orders_Wide", "select * from {orders}", file_prefix="Wide", threshold=ROW_CAP, order_by=("o_orderdate", "o_orderkey"))
    done = run.deliver(spark, job, {}, scratch_path(spark, "run"), started=STARTED, orders=derived.quarantine_input(spark, sf))
    return done.files.select("file_index", "rows", "rejects")


@query
def audit_rerun(spark, sf):
    """The audit trail after the same run was made twice."""
    output = scratch_path(spark, "run")
    for _ in range(2):
        _year_run(spark, sf, output)
    return audit.read_audit(spark, f"{output}/audit").select("StoreProcedureName", "Parameter", "Date", "RowsCount", "Message")


@query
def delivery_family(spark, sf):
    """A family of twelve tables, delivered whole."""
    base, root = "delivered_twelve", scratch_path(spark, "family")
    catalog.write_family(_orders(spark, sf).withColumn("n", F.col("o_orderkey") % 12 + 1), root, base, "n")
    job = extract.Job(name="Orders_Family", file_prefix="Day_Family", family=base, family_root=root)
    done = run.deliver(spark, job, {}, scratch_path(spark, "run"), started=STARTED)
    return done.files.select("table_name", "rows")


# ---- streaming ----------------------------------------------------------------------------------


@query
def stream_capped_split(spark, sf):
    """Orders arrive year by year; outputs rotate at the cap across batches."""
    base = scratch_path(spark, "stream")
    orders = _orders(spark, sf)
    orders.repartition(F.year("o_orderdate")).write.parquet(f"{base}/arrivals")
    stream = (
        spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/arrivals")
    )
    run = capped.start_capped_stream(stream, f"{base}/out", f"{base}/checkpoint", ROW_CAP)
    run.awaitTermination()
    return capped.read_stream_output(spark, f"{base}/out").groupBy("split_id").agg(F.count("*").alias("row_count"))
