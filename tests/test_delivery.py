"""Runs end to end: manifests, sinks, audit, reports, streaming."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from parcelyard import session, versions
from parcelyard.operators import extract, split, staging, totals
from parcelyard.plans import audit, deliver, publish, reports, run
from parcelyard.sources import catalog, manifest, tables
from parcelyard.streaming import capped

STARTED = dt.datetime(2024, 3, 5, 9, 30)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(values)

    with pytest.raises(ValueError):
        session.scratch_path(Session(**{"spark.master": "yarn"}), "x")
    path = session.scratch_path(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///c/"}), "x")
    assert path.startswith("hdfs:///c/x-")
    assert "parcelyard-" in session.scratch_path(Session(**{"spark.master": "local[2]"}), "x")


def test_manifest_with_byte_order_mark(spark, tmp_path):
    jobs = [
        {"Name": "J1", "DisplayName": "J 1", "DataType": "Export", "StagingTable": "T", "Parameters": ["mon", "mon1"],
         "FilePrefix": "P", "Threshold": 5},
        {"Name": "J2", "DisplayName": "J 2", "DataType": "Import", "StagingTable": "TODO_FILL_THIS_IN",
         "Parameters": ["mon"], "FilePrefix": "P"},
        {"Name": " ", "DataType": "Other", "Parameters": [], "Threshold": -1},
    ]
    path = tmp_path / "jobs.json"
    path.write_text(json.dumps({"StoredProcedures": jobs}, indent=2), encoding="utf-8-sig")
    got = manifest.read_manifest(spark, str(path))
    assert [r["threshold"] for r in got.collect()] == [5, None, -1]
    failed = [list(r["failed_rules"]) for r in manifest.check_manifest(got).collect()]
    assert failed == [
        [], ["staging_table_placeholder"],
        ["name_missing", "display_name_missing", "data_type_invalid", "staging_table_missing", "parameters_missing",
         "file_prefix_missing", "threshold_negative"],
    ]
    assert manifest.has_jobs(got)
    manifest.write_manifest(got, str(tmp_path / "new"), jobs_per_document=2)
    assert sorted(manifest.read_manifest(spark, str(tmp_path / "new"), one_per_file=False).collect()) == sorted(got.collect())
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        manifest.write_manifest(got, str(tmp_path / "new"))
    path.write_text('{"StoredProcedures": []}')
    assert not manifest.has_jobs(manifest.read_manifest(spark, str(path)))


def test_catalog_tables_in_several_formats(spark, tmp_path):
    df = spark.range(50).withColumn("v", F.col("id") * 2)
    for fmt in ("parquet", "orc", "json"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        assert tables.count_rows(tables.read_table(spark, str(tmp_path / fmt), fmt)).first()[0] == 50
    size = sum(f.stat().st_size for f in (tmp_path / "parquet").glob("*.parquet"))
    assert tables.storage_size(spark, str(tmp_path / "parquet"), ".parquet").first()["size_bytes"] == size
    assert tables.logical_size(df).first()["size_bytes"] == 50 * 16


@pytest.mark.parametrize("one_file", [False, True])
def test_sink_holds_every_row_in_its_split(spark, tmp_path, one_file):
    staged = staging.stage(spark.range(1000).withColumn("v", F.col("id") * 3), ["id"])
    path = str(tmp_path / "out")
    deliver.write_splits(split.capped_split(staged, 300).drop("row_index"), path, one_file=one_file)
    back = deliver.read_splits(spark, path)
    assert sorted(tuple(r) for r in back.select("id", "v", "split_id").collect()) == [
        (i, 3 * i, i // 300 + 1) for i in range(1000)
    ]
    sizes = {r["split_id"]: r["files"] for r in deliver.delivered(spark, path).collect()}
    assert set(sizes) == {1, 2, 3, 4}
    if one_file:
        assert set(sizes.values()) == {1}


def test_hot_split_is_written_as_several_files(spark, tmp_path):
    """One key holds a third of the rows; with one_file its files are bounded by rows_per_file."""
    rows = spark.range(9000).select(F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("k"), "id")
    parts = split.split_by_key(staging.stage(rows, ["k", "id"]), "k")
    path = str(tmp_path / "out")
    deliver.write_splits(parts.rows, path, rows_per_file=500, one_file=True)
    sizes = {r["split_id"]: r["files"] for r in deliver.delivered(spark, path).collect()}
    assert sizes[1] == 6 and set(sizes.values()) == {1, 6}
    assert deliver.read_splits(spark, path).count() == 9000


def test_sink_replaces_what_was_there(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (1000, 10):
        staged = staging.stage(spark.range(n), ["id"])
        deliver.write_splits(split.capped_split(staged, 100).drop("row_index"), path)
    assert deliver.read_splits(spark, path).count() == 10


def test_single_output_has_no_number(spark):
    status = spark.createDataFrame([(3, "T_3", 5)], "split_id int, table_name string, row_count long")
    row = deliver.plan_delivery(status, "Out", STARTED, ".csv").first()
    assert (row["file_index"], row["file_name"], row["inner_table"]) == (1, "Out_05032024.csv", "Out")


@pytest.mark.parametrize("zone", ["Pacific/Kiritimati", "Pacific/Niue"])
def test_names_and_times_do_not_depend_on_the_session_zone(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    late = dt.datetime(2024, 3, 5, 23, 59)
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        done = run.deliver(spark, JOB, {"top": 10}, str(tmp_path), started=late, t=source(spark))
        assert done.files.first()["path"].endswith("Small_05032024.parquet")
        assert done.process_id[3:7] == "2359"
        assert audit.read_audit(spark, f"{tmp_path}/audit").first()["Date"] == late
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_outputs_are_renumbered_after_filtering(spark):
    status = spark.createDataFrame([(2, "T_2", 5), (9, "T_9", 5)], "split_id int, table_name string, row_count long")
    rows = deliver.plan_delivery(status, "Out", STARTED, ".csv").orderBy("split_id").collect()
    assert [r["file_name"] for r in rows] == ["Out_1_05032024.csv", "Out_2_05032024.csv"]
    assert [r["inner_table"] for r in rows] == ["Out_1", "Out_2"]


def test_file_names_of_a_run_with_very_many_files(spark):
    files = spark.range(1, 2501).selectExpr(
        "'p' as process_id", "int(id) as file_index", "concat('/x/f', id) as path", "id as rows",
        "2 * id as table_size_bytes", "3 * id as file_size_bytes",
    )
    row = totals.run_totals(files).first()
    assert row["file_names"] == "; ".join(f"f{i}" for i in range(1, 2501))
    total = 2500 * 2501 // 2
    assert (row["files"], row["rows_written"], row["table_bytes"], row["file_bytes"]) == (2500, total, 2 * total, 3 * total)


JOB = extract.Job(
    "Small_EXP", "select * from {t} where id < :top", ("top",), file_prefix="Small", threshold=40, order_by=("id",)
)


def source(spark):
    return spark.range(200).withColumn("big", F.when(F.col("id") % 10 == 0, F.lit(2**40)).otherwise(F.col("id")))


def test_delivery_run(spark, tmp_path):
    out = str(tmp_path)
    done = run.deliver(spark, JOB, {"top": 100}, out, started=STARTED, t=source(spark))
    facts = done.outcome.first()
    assert (facts["outcome"], facts["total_rows"], facts["splits"], facts["rejects"]) == ("delivered", 100, 3, 10)
    files = done.files.orderBy("file_index").collect()
    assert [r["rows"] for r in files] == [36, 36, 18]
    assert [r["path"].rsplit("=", 1)[1] for r in files] == [f"Small_{i}_05032024.parquet" for i in (1, 2, 3)]
    assert all(r["file_size_bytes"] > 0 and r["table_size_bytes"] == r["rows"] // 9 * 10 * 16 for r in files)
    delivered = spark.read.parquet(f"{out}/data/Small_05032024")
    assert sorted(r["id"] for r in delivered.collect()) == [i for i in range(100) if i % 10]
    assert dict(delivered.dtypes)["big"] == "int"
    rejects = {r["id"]: (r["split_id"], r["split_row"]) for r in done.rejects.collect()}
    assert rejects == {i: (i // 40 + 1, i % 40 + 1) for i in range(0, 100, 10)}
    trail = audit.read_audit(spark, f"{out}/audit").first()
    assert (trail["Message"], trail["RowsCount"], trail["Parameter"]) == ("Success", 90, "@top=100")
    assert trail["ProcessId"] == done.process_id and done.warning is None
    assert "Files: 3" in trail["Comment"]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_run_in_other_formats_and_with_an_odd_prefix(spark, tmp_path, fmt):
    done = run.deliver(
        spark, JOB, {"top": 100}, str(tmp_path), prefix=" My Out: ü ", started=STARTED, fmt=fmt, t=source(spark)
    )
    files = done.files.orderBy("file_index").collect()
    assert [r["rows"] for r in files] == [36, 36, 18] and all(r["file_size_bytes"] > 0 for r in files)
    assert files[0]["path"].endswith(f"output=My Out: ü_1_05032024.{fmt}")


def test_outputs_of_another_day_stay(spark, tmp_path):
    out = str(tmp_path)
    for day, rows in ((STARTED, 100), (STARTED, 50), (STARTED + dt.timedelta(days=1), 10)):
        run.deliver(spark, JOB, {"top": rows}, out, started=day, t=source(spark))
    assert spark.read.parquet(f"{out}/data/Small_05032024").count() == 45
    assert spark.read.parquet(f"{out}/data/Small_06032024").count() == 9
    assert audit.read_audit(spark, f"{out}/audit").count() == 3


def test_empty_run_succeeds_and_failed_run_is_audited(spark, tmp_path):
    out = str(tmp_path)
    empty = run.deliver(spark, JOB, {"top": 0}, out, t=source(spark))
    assert (empty.outcome.first()["outcome"], empty.files.count()) == ("empty", 0)
    broken = extract.Job("Broken", "select nothing from {t}", file_prefix="B", order_by=("id",))
    failed = run.deliver(spark, broken, {}, out, t=source(spark))
    assert failed.outcome.first()["success"] is False
    messages = {r["StoreProcedureName"]: r["Message"] for r in audit.read_audit(spark, f"{out}/audit").collect()}
    assert messages["Small_EXP"] == "Success" and "nothing" in messages["Broken"]


@pytest.mark.parametrize(
    ("policy", "outcome", "indexes"),
    [("all", "delivered", [1, 2, 3]), ("valid_only", "partly_delivered", [1, 2]), ("cancel", "cancelled", [])],
)
def test_policies_of_a_run_split_by_key(spark, tmp_path, policy, outcome, indexes):
    rows = spark.range(100).withColumn("k", F.when(F.col("id") < 50, 1).when(F.col("id") < 70, 2).otherwise(3))
    job = extract.Job("Keyed", "select * from {t}", (), "Keyed", 40, ("id",), split_key="k")
    done = run.deliver(spark, job, {}, str(tmp_path), policy, started=STARTED, t=rows)
    assert done.outcome.first()["outcome"] == outcome
    assert [r["file_index"] for r in done.files.orderBy("file_index").collect()] == indexes


def test_job_without_an_order_is_delivered_as_it_comes(spark, tmp_path):
    job = extract.Job("Plain", "select * from {t}", file_prefix="Plain", threshold=30)
    done = run.deliver(spark, job, {}, str(tmp_path), t=spark.range(100).withColumn("m", F.create_map(F.lit(1), "id")))
    assert [r["rows"] for r in done.files.orderBy("file_index").collect()] == [30, 30, 30, 10]
    keyed = extract.Job("Keyed", "select id, id % 3 as k from {t}", file_prefix="Keyed", split_key="k")
    done = run.deliver(spark, keyed, {}, str(tmp_path), started=STARTED, t=spark.range(100))
    assert [r["rows"] for r in done.files.orderBy("file_index").collect()] == [34, 33, 33]
    assert spark.read.parquet(f"{tmp_path}/data/Keyed_05032024").columns == ["id", "k", "output"]


def family(spark, base, sizes):
    for i, size in enumerate(sizes, 1):
        spark.range(size).withColumn("t", F.lit(i)).createOrReplaceTempView(f"{base}_{i}")


@pytest.mark.parametrize(
    ("policy", "outcome", "delivered"),
    [
        ("all", "delivered", {"f1_1": 30, "f1_2": 60, "f1_3": 0, "f1_4": 5}),
        ("valid_only", "partly_delivered", {"f1_1": 30, "f1_3": 0, "f1_4": 5}),
        ("cancel", "cancelled", {}),
    ],
)
def test_family_of_tables(spark, tmp_path, policy, outcome, delivered):
    family(spark, "f1", [30, 60, 0, 5])
    job = extract.Job("Fam", family="f1", file_prefix="Fam", threshold=50)
    done = run.deliver(spark, job, {}, str(tmp_path), policy, started=STARTED)
    assert done.outcome.first()["outcome"] == outcome
    files = done.files.orderBy("file_index").collect()
    assert {r["table_name"]: r["rows"] for r in files} == delivered
    assert [r["file_index"] for r in files] == list(range(1, len(delivered) + 1))
    if delivered:
        back = spark.read.parquet(f"{tmp_path}/data/Fam_05032024")
        assert back.columns == ["id", "t", "output"] and back.count() == sum(delivered.values())


def test_family_of_one_is_judged_and_a_lone_table_is_not(spark, tmp_path):
    family(spark, "f2", [60])
    job = extract.Job("One", family="f2", file_prefix="One", threshold=50)
    assert run.deliver(spark, job, {}, str(tmp_path), "cancel").outcome.first()["outcome"] == "cancelled"
    spark.range(60).createOrReplaceTempView("f3")
    job = extract.Job("Lone", family="f3", file_prefix="Lone", threshold=50)
    done = run.deliver(spark, job, {}, str(tmp_path), "cancel")
    facts = done.outcome.first()
    assert facts["outcome"] == "delivered" and [r["rows"] for r in done.files.collect()] == [60]
    assert facts["warnings"] == ["Staging table [f3] has 60 rows (threshold: 50)."]


def test_dates_are_checked_before_a_run(spark, tmp_path):
    job = extract.Job("Dated", "select * from {t}", ("mon", "mon1"), "Dated")
    with pytest.raises(ValueError, match="mon1_before_mon"):
        run.deliver(spark, job, {"mon": 20240102, "mon1": 20240101}, str(tmp_path), t=spark.range(5))
    with pytest.raises(ValueError, match="mon_not_8_digits"):
        run.deliver(spark, job, {"mon1": 20240101}, str(tmp_path), t=spark.range(5))
    assert not list(tmp_path.iterdir())
    fine = run.deliver(spark, job, {"mon": 20240101, "mon1": 20240101}, str(tmp_path), t=spark.range(5))
    assert fine.outcome.first()["success"]


def test_nothing_valid(spark, tmp_path):
    job = extract.Job("Keyed", "select *, 1 as k from {t}", (), "Keyed", 40, ("id",), split_key="k")
    done = run.deliver(spark, job, {}, str(tmp_path), "valid_only", t=spark.range(100))
    assert done.outcome.first()["outcome"] == "nothing_valid" and done.files.count() == 0


def test_audit_can_be_disabled_and_its_failure_is_a_warning(spark, tmp_path):
    out = str(tmp_path)
    run.deliver(spark, JOB, {"top": 10}, out, audit=False, t=source(spark))
    assert not (tmp_path / "audit").exists()
    (tmp_path / "audit").write_text("in the way")
    done = run.deliver(spark, JOB, {"top": 10}, out, t=source(spark))
    assert done.outcome.first()["success"] and done.warning.startswith("Audit record was not written")


def test_report_is_written_under_a_name_with_its_time(spark, tmp_path):
    columns = ["status", "name", "display_name", "exists", "json_params", "db_params", "params_match",
               "json_threshold", "db_threshold", "threshold_ok", "details"]
    report = spark.createDataFrame(
        [("MISSING", "b", "B", "No", *[None] * 6, "gone"),
         ("VALID", "a", "A", "Yes", "mon", "mon", "Yes", "5", "5", "Yes", "")],
        ", ".join(f"`{c}` string" for c in columns),
    )
    path = reports.write_report(report, str(tmp_path), STARTED)
    assert path.endswith("validation_report_20240305_093000")
    assert [r["name"] for r in spark.read.json(path).orderBy("name").collect()] == ["a", "b"]
    text = reports.write_report(report, str(tmp_path / "text"), STARTED, "text")
    lines = sorted(r[0] for r in spark.read.text(text).collect())
    assert "[VALID]    a" in lines and "[MISSING]  b" in lines and "  ! gone" in lines
    assert sum("Threshold OK" in line for line in lines) == 1


def test_job_from_manifest(spark):
    jobs = spark.createDataFrame(
        [("J_EXP", "J", "Export", "STG", ["mon"], "Pre", None), ("K", "K", "Import", "T", ["a", "b"], "Q", 7)],
        "name string, display_name string, data_type string, staging_table string, parameters array<string>, "
        "file_prefix string, threshold long",
    )
    job = extract.job_from_manifest(jobs, "j_exp", "select 1", order_by=("x",))
    assert (job.name, job.parameters, job.threshold, job.staging_table) == ("J_EXP", ("mon",), 0, "STG")
    assert extract.job_from_manifest(jobs, "K", "select 1").threshold == 7
    with pytest.raises(LookupError):
        extract.job_from_manifest(jobs, "nope", "select 1")


def test_master_list_file(spark, tmp_path):
    (tmp_path / "list.txt").write_text("Job_B\n\n  job_a \nJOB_B\n")
    assert [r["key"] for r in catalog.master_list(spark.read.text(str(tmp_path / "list.txt"))).collect()] == ["job_a", "job_b"]


def arrivals(spark, path, start, stop):
    spark.range(start, stop).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("order_by", [None, ["id"]])
def test_stream_goes_on_where_it_stopped(spark, tmp_path, order_by):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def pump():
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(inbox)
        query = capped.start_capped_stream(stream, out, mark, 40, order_by)
        query.awaitTermination()

    arrivals(spark, inbox, 0, 30)
    arrivals(spark, inbox, 30, 65)
    pump()
    arrivals(spark, inbox, 65, 150)
    pump()
    pump()
    rows = capped.read_stream_output(spark, out)
    assert sorted(r["id"] for r in rows.collect()) == list(range(150))
    assert {r[0]: r[1] for r in rows.groupBy("split_id").count().collect()} == {1: 40, 2: 40, 3: 40, 4: 30}


def test_stream_restarts_after_a_failure_between_data_and_offset(spark, tmp_path, monkeypatch):
    """The second batch writes its data and dies; the restart writes it again, no row twice."""
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for start in (0, 50, 100):
        arrivals(spark, inbox, start, start + 50)
    write_offset, calls = capped._write_offset, []

    def dies_once(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        write_offset(*args)

    def pump():
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(inbox)
        capped.start_capped_stream(stream, out, mark, 40).awaitTermination()

    monkeypatch.setattr(capped, "_write_offset", dies_once)
    with pytest.raises(Exception, match="lost"):
        pump()
    pump()
    assert len(calls) == 4
    rows = capped.read_stream_output(spark, out)
    assert sorted(r["id"] for r in rows.collect()) == list(range(150))
    assert {r[0]: r[1] for r in rows.groupBy("split_id").count().collect()} == {1: 40, 2: 40, 3: 40, 4: 30}


def test_stream_batch_may_run_again_after_its_offset(spark, tmp_path):
    out = str(tmp_path / "out")
    capped.write_batch(spark.range(0, 50), 0, out, 40, ["id"])
    capped.write_batch(spark.range(50, 100), 1, out, 40, ["id"])
    capped.write_batch(spark.range(50, 100), 1, out, 40, ["id"])
    capped.write_batch(spark.range(100, 130), 5, out, 40, ["id"])  # ids need not be consecutive
    rows = capped.read_stream_output(spark, out)
    assert sorted(r["id"] for r in rows.collect()) == list(range(130))
    assert {r[0]: r[1] for r in rows.groupBy("split_id").count().collect()} == {1: 40, 2: 40, 3: 40, 4: 10}


def test_hot_order_key_is_cut_and_repeats(spark, tmp_path):
    """A third of the rows on one day: no partition holds them all, and two runs place every row alike."""
    source = str(tmp_path / "source")
    rows = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 7, id % 500) as day")
    rows.repartition(6).write.parquet(source)
    job = extract.Job(name="Hot", sql="select * from {rows}", order_by=("day",), partitions=12)
    places = []
    for turn in range(2):
        staged = run._stage(spark, job, {}, str(tmp_path / f"staged{turn}"), {"rows": spark.read.parquet(source)})
        sizes = [part.rows for part in staged.parts]
        assert max(sizes) < 2 * sum(sizes) / 12
        placed = split.capped_split(staged, 1_000).select("id", "split_id", "split_row")
        places.append({tuple(r) for r in placed.collect()})
    assert places[0] == places[1]


def test_nested_errors_are_told_in_one_line(spark):
    try:
        try:
            raise ValueError("disk full")
        except ValueError as inner:
            raise RuntimeError("write failed") from inner
    except RuntimeError as outer:
        assert run._told(spark, outer) == "RuntimeError: write failed — ValueError: disk full"


def published(spark, staged, path, cap=30, **options):
    rows = split.capped_split(staged.with_segments(), cap).drop("row_index")
    return publish.publish_splits(rows, path, "run", **options)


@pytest.mark.parametrize("one_file", [False, True])
@pytest.mark.parametrize("ordered", [False, True])
def test_commit_lists_files_in_row_order(spark, tmp_path, ordered, one_file):
    path, rows = str(tmp_path / "out"), spark.range(1000).repartition(7)
    staged = staging.stage(rows, ["id"]) if ordered else staging.store(rows)
    done = published(spark, staged, path, 300, rows_per_file=70, one_file=one_file)
    assert (done.version, done.rows) == (1, 1000)
    listed = done.manifest.orderBy("output", "ordinal").collect()
    assert sum(r["rows"] for r in listed) == 1000 and max(r["rows"] for r in listed) <= 70
    assert all((tmp_path / "out" / r["file"]).stat().st_size == r["bytes"] for r in listed)
    assert sorted(str(f.relative_to(path)) for f in (tmp_path / "out").glob("split_id=*/*.parquet")) == sorted(r["file"] for r in listed)
    want = {r["id"]: (r["split_id"], r["split_row"]) for r in split.capped_split(staged, 300).collect()}
    got = {r["id"]: (r["split_id"], r["row_number"]) for r in publish.read_ordered(spark, path).collect()}
    assert got == want


@pytest.mark.parametrize("dies_in", ["_place", "versions.publish", "versions.rename"])
def test_a_run_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch, dies_in):
    path = str(tmp_path / "out")
    published(spark, staging.store(spark.range(100)), path)
    owner, name = (publish, dies_in) if "." not in dies_in else (publish.versions, dies_in.split(".")[1])
    real, calls = getattr(owner, name), []

    def dies(*args, **options):
        calls.append(args)
        if name != "rename" or len(calls) > 2:  # some files have their names by then
            raise OSError("lost")
        return real(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(owner, name, dies)
        with pytest.raises(OSError):
            published(spark, staging.store(spark.range(500, 600)), path)
    ids = lambda: sorted(r["id"] for r in publish.read_committed(spark, path).collect())
    assert ids() == list(range(100)) and publish.manifest(spark, path).count() >= 4
    published(spark, staging.store(spark.range(700, 750)), path)
    assert ids() == list(range(700, 750))
    publish.vacuum(spark, path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(700, 750))


def test_files_are_placed_without_look_ups_for_each(spark, tmp_path, monkeypatch):
    """File systems, footers and folders are looked at once for a publication, not once for each of its files."""
    path, contexts, listed, loads = str(tmp_path / "o u%t"), [], [], []
    context, names, load = versions._context, versions.names, type(spark.read).load
    monkeypatch.setattr(versions, "_context", lambda *args: contexts.append(args) or context(*args))
    monkeypatch.setattr(versions, "names", lambda spark, folder: listed.append(folder) or names(spark, folder))
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameReader.load", lambda self, at=None, *a, **b: loads.append(at) or load(self, at, *a, **b))
    for start in (0, 1000):
        done = published(spark, staging.store(spark.range(start, start + 1000)), path)
    assert done.manifest.count() >= 34 and done.manifest.agg({"rows": "sum"}).first()[0] == 1000
    assert len(contexts) == 2  # for the commits
    assert not [folder for folder in listed if "split_id=" in folder]
    assert not [at for at in loads if isinstance(at, list)]
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(1000, 2000))


def test_one_of_two_writers_wins(spark, tmp_path, monkeypatch):
    path, place = str(tmp_path / "out"), publish._place
    published(spark, staging.store(spark.range(10)), path)

    def overtaken(*args):
        with monkeypatch.context() as patch:
            patch.setattr(publish, "_place", place)
            published(spark, staging.store(spark.range(20)), path)
        return place(*args)

    with monkeypatch.context() as patch:
        patch.setattr(publish, "_place", overtaken)
        with pytest.raises(versions.LostRace):
            published(spark, staging.store(spark.range(30)), path)
    assert publish.read_committed(spark, path).count() == 20
    assert publish.vacuum(spark, path) > 0 and spark.read.parquet(path).count() == 20


def test_versions_are_published_once(spark, tmp_path):
    folder = str(tmp_path / "v")
    assert versions.latest(spark, folder) == 0
    assert [versions.publish(spark.range(n), folder, n) for n in range(3)] == [1, 2, 3]
    with pytest.raises(versions.LostRace):
        versions.publish(spark.range(9), folder, 2)
    assert versions.latest(spark, folder) == 3 and len(versions.names(spark, folder)) == 3
    assert spark.read.parquet(versions.version_path(folder, 3)).count() == 2


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_a_run_counts_nothing_again(spark, tmp_path, monkeypatch, fmt):
    """Staging is read once for the outputs and once for the rejects; what was written is not opened to count it."""
    reads, read = [], staging.StagedRows.read
    monkeypatch.setattr(staging.StagedRows, "read", lambda self, *a: reads.append(self.path) or read(self, *a))
    monkeypatch.setattr(deliver, "delivered", None)
    for top, expected in ((100, 1), (8, 1)):
        reads.clear()
        done = run.deliver(spark, JOB, {"top": top}, str(tmp_path), started=STARTED, fmt=fmt, t=source(spark).filter("id % 10 > 0 or id > 8"))
        staged = [p for p in reads if p.endswith("/staging/Small_EXP")]
        assert len(staged) == expected, reads
        files = done.files.orderBy("file_index").collect()
        whole = [i for i in range(top) if i % 10 or i > 8]
        assert sum(r["rows"] for r in files) == len([i for i in whole if i % 10])
        assert sum(r["rejects"] for r in files) == len([i for i in whole if i % 10 == 0]) == done.outcome.first()["rejects"]


def test_skipped_tables_are_named(spark, tmp_path):
    family(spark, "f9", [30, 60, 70, 5])
    job = extract.Job("Fam", family="f9", file_prefix="Fam", threshold=50)
    done = run.deliver(spark, job, {}, str(tmp_path), "valid_only", started=STARTED)
    assert done.outcome.first()["warnings"] == ["Skipped 2 table(s) exceeding threshold: f9_2, f9_3"]


def test_the_same_run_is_audited_once(spark, tmp_path):
    out = str(tmp_path)
    for top in (100, 100, 50):
        run.deliver(spark, JOB, {"top": top}, out, started=STARTED, t=source(spark))
    assert sorted(r["RowsCount"] for r in audit.read_audit(spark, f"{out}/audit").collect()) == [45, 90]
    rows = audit.read_audit(spark, f"{out}/audit")
    path = str(tmp_path / "other")
    for frame in (rows, rows.limit(1), rows.union(rows)):
        assert audit.append_audit(frame, path) is None
    assert audit.read_audit(spark, path).count() == 2


def test_family_of_many_folders_is_one_scan(spark, tmp_path):
    root = str(tmp_path / "family")
    catalog.write_family(spark.range(900).withColumn("n", F.col("id") % 300 + 1), root, "Many_x", "n")
    versions.rename(spark, f"{root}/Many_x_200", f"{root}/Many_x_left")
    assert catalog.family_tables(spark, "many_X", root) == [f"Many_x_{n}" for n in range(1, 200)]
    rows = catalog.read_family(spark, "Many_x", "part", root)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    assert {(r["part"] - 1, r["id"] % 300) for r in rows.collect()} == {(n, n) for n in range(199)}
    lone = spark.range(5).withColumn("extra", F.lit(1))
    lone.write.parquet(f"{root}/lone")
    assert catalog.read_family(spark, "lone", "part", root).filter("part = 1").count() == 5
    lone.write.mode("overwrite").parquet(f"{root}/Many_x_1")  # another set of columns
    padded = catalog.read_family(spark, "Many_x", "part", root)
    assert padded.columns == ["id", "extra", "part"] and padded.filter("extra is not null").count() == 5
    with pytest.raises(Exception, match="n is NULL"):
        catalog.write_family(spark.range(3).withColumn("n", F.lit(None).cast("int")), root, "Nulls", "n")


def test_family_job_over_folders(spark, tmp_path):
    root = str(tmp_path / "family")
    catalog.write_family(spark.range(100).withColumn("n", F.when(F.col("id") < 70, 1).otherwise(2)), root, "f", "n")
    job = extract.Job("Fam", family="f", family_root=root, file_prefix="Fam", threshold=50)
    done = run.deliver(spark, job, {}, str(tmp_path), "valid_only", started=STARTED)
    assert [(r["table_name"], r["rows"]) for r in done.files.collect()] == [("f_2", 30)]


def test_stream_readers_see_finished_batches_only(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    capped.write_batch(spark.range(0, 50).repartition(3), 0, out, 40, None)
    with monkeypatch.context() as patch:
        patch.setattr(capped, "_write_offset", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            capped.write_batch(spark.range(50, 90), 1, out, 40, None)
    assert sorted(r["id"] for r in capped.read_stream_output(spark, out).collect()) == list(range(50))
    capped.write_batch(spark.range(50, 90), 1, out, 40, None)
    rows = capped.read_stream_output(spark, out)
    assert {r[0]: r[1] for r in rows.groupBy("split_id").count().collect()} == {1: 40, 2: 40, 3: 10}
    assert not list((tmp_path / "out").rglob("split_id=*"))  # rows stay in the one file they were written to
