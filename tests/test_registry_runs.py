"""Maintenance runs over manifest files, end to end."""

import datetime as dt
import json
import random

import pytest

from parcelyard.operators.reconcile import compare
from parcelyard.plans.registry import Catalog, Registry, reconcile_delta, reconcile_manifest, reconcile_run, sync_manifest, sync_run
from parcelyard.sources.manifest import read_manifest
from parcelyard.versions import LostRace


def job(name, params, threshold):
    entry = {"Name": name, "DisplayName": name, "DataType": "Export", "StagingTable": "S", "Parameters": params,
             "FilePrefix": "P"}
    return entry if threshold is None else {**entry, "Threshold": threshold}


@pytest.fixture
def manifest(tmp_path):
    path = tmp_path / "jobs.json"
    jobs = [job("A_EXP_1", ["mon", "mon1"], 2100000), job("B_EXP_2", ["mon"], 5), job("Gone", ["mon"], None)]
    path.write_text(json.dumps({"StoredProcedures": jobs}), encoding="utf-8-sig")
    return str(path)


@pytest.fixture
def catalog(spark):
    routines = ["a_exp_1", "b_exp_2", "New_IMP_X", "Other"]
    params = [("a_exp_1", 1, "@mon"), ("a_exp_1", 2, "@mon1"), ("b_exp_2", 1, "@Mon"), ("b_exp_2", 2, "@extra")]
    source = [("a_exp_1", "if @cnt > 2100000"), ("b_exp_2", "IF @cnt>6"), ("New_IMP_X", "if @cnt > 9")]
    return Catalog(
        spark.createDataFrame([(r,) for r in routines], "name string"),
        spark.createDataFrame(params, "name string, position int, param string"),
        spark.createDataFrame(source, "name string, source string"),
    )


def test_reconcile_reports_and_repairs(spark, tmp_path, manifest, catalog):
    when = dt.datetime(2024, 3, 5, 9, 30)
    fixed_path = str(tmp_path / "fixed")
    done = reconcile_manifest(spark, manifest, catalog, str(tmp_path / "reports"), fixed_path, when)
    assert (done.summary["valid"], done.summary["missing"], done.summary["mismatch"]) == (1, 1, 1) and done.failed
    text = "\n".join(r[0] for r in spark.read.text(done.report).collect())
    assert "[MISMATCH] B_EXP_2" in text and "Threshold MISMATCH: JSON=5  DB=6" in text
    fixed = {r["name"]: (r["parameters"], r["threshold"]) for r in
             read_manifest(spark, done.fixed_manifest, one_per_file=False).collect()}
    assert fixed == {"A_EXP_1": (["mon", "mon1"], 2100000), "B_EXP_2": (["Mon", "extra"], 6), "Gone": (["mon"], None)}
    again = reconcile_manifest(
        spark, fixed_path, catalog, str(tmp_path / "reports"), str(tmp_path / "more"), one_per_file=False
    )
    assert again.summary["mismatch"] == 0 and again.fixed_manifest is None


def test_reconcile_wants_jobs(spark, tmp_path, catalog):
    path = tmp_path / "empty.json"
    path.write_text('{"StoredProcedures": []}')
    with pytest.raises(ValueError):
        reconcile_manifest(spark, str(path), catalog, str(tmp_path))


def test_sync_writes_only_changes(spark, tmp_path, manifest, catalog):
    names = tmp_path / "names.txt"
    names.write_text("B_exp_2\n new_imp_x \n\nNEW_IMP_X\nnowhere\n")
    done = sync_manifest(spark, manifest, str(names), catalog, str(tmp_path / "next"))
    assert tuple(done.summary) == (3, 1, 2, 1, 0, 1, True) and done.manifest == str(tmp_path / "next")
    entries = {r["name"]: r["staging_table"] for r in read_manifest(spark, done.manifest, one_per_file=False).collect()}
    assert entries == {"A_EXP_1": "S", "B_EXP_2": "S", "Gone": "S", "New_IMP_X": "TODO_FILL_THIS_IN"}
    again = sync_manifest(spark, done.manifest, str(names), catalog, str(tmp_path / "last"), one_per_file=False)
    assert not again.summary["changed"] and again.manifest == done.manifest and not (tmp_path / "last").exists()
    names.write_text("  \n")
    with pytest.raises(ValueError):
        sync_manifest(spark, manifest, str(names), catalog, str(tmp_path / "x"))


@pytest.fixture
def registry(spark, tmp_path, manifest):
    store = Registry(spark, str(tmp_path / "registry"))
    assert store.publish(read_manifest(spark, manifest), 0) == 1
    return store


def test_a_repair_is_the_next_version(spark, tmp_path, registry, catalog):
    reports = str(tmp_path / "reports")
    looked = reconcile_run(registry, catalog, reports, when=dt.datetime(2024, 1, 1))
    assert (looked.read, looked.version, looked.exit_code, registry.version()) == (1, 1, 1, 1)
    fixed = reconcile_run(registry, catalog, reports, fix=True, when=dt.datetime(2024, 1, 2))
    assert (fixed.read, fixed.version, fixed.exit_code, fixed.summary["mismatch"]) == (1, 2, 1, 1)
    assert {r["name"]: r["threshold"] for r in registry.read().collect()} == {"A_EXP_1": 2100000, "B_EXP_2": 6, "Gone": None}
    assert {r["name"]: r["threshold"] for r in registry.read(1).collect()}["B_EXP_2"] == 5
    again = reconcile_run(registry, catalog, reports, fix=True, when=dt.datetime(2024, 1, 3))
    assert (again.version, again.summary["mismatch"], again.exit_code) == (2, 0, 1)  # one is still missing
    lines = [r[0] for r in spark.read.text(fixed.report).collect()]
    assert "[VALID]    A_EXP_1" in lines and "[MISMATCH] B_EXP_2" in lines and "[MISSING]  Gone" in lines
    assert "  ! Threshold MISMATCH: JSON=5  DB=6" in lines
    with pytest.raises(FileNotFoundError):
        Registry(spark, str(tmp_path / "none")).read()


def test_a_run_compares_once(spark, tmp_path, registry, catalog):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    routines = catalog.routines.mapInArrow(count, catalog.routines.schema)
    reconcile_run(registry, Catalog(routines, catalog.params, catalog.source), str(tmp_path / "reports"), fix=True)
    assert seen.value == catalog.routines.count()


def test_a_lost_race_changes_nothing(spark, tmp_path, registry, catalog, monkeypatch):
    names = spark.createDataFrame([("new_imp_x",)], "value string")
    real = Registry.publish

    def overtaken(self, jobs, read):
        real(self, self.read(read).limit(1), read)
        return real(self, jobs, read)

    monkeypatch.setattr(Registry, "publish", overtaken)
    with pytest.raises(LostRace):
        sync_run(registry, names, catalog)
    assert registry.version() == 2 and registry.read().count() == 1
    monkeypatch.setattr(Registry, "publish", real)
    done = sync_run(registry, names, catalog)
    assert (done.read, done.version, done.exit_code, done.summary["added"], registry.read().count()) == (2, 3, 0, 1, 2)
    assert sync_run(registry, names, catalog).version == 3
    with pytest.raises(ValueError):
        sync_run(registry, names.limit(0), catalog)


def test_delta_equals_the_whole_comparison(spark, tmp_path):
    state, rng = str(tmp_path / "state"), random.Random(4)
    columns = "name string, display_name string, data_type string, staging_table string, parameters array<string>, file_prefix string, threshold long"
    jobs = {f"J{n}": (f"J{n}", "d", "Export", "s", ["mon"], "p", n) for n in range(40)}
    known = {f"j{n}": (["@mon"] * (n % 5 > 0), f"if @cnt > {n}") for n in range(3, 45)}
    for turn in range(4):
        extra = [jobs["J5"]] if "J5" in jobs and turn == 2 else []  # a name twice
        job_rows = spark.createDataFrame([*jobs.values(), *extra], columns)
        catalog = Catalog(
            spark.createDataFrame([(k,) for k in known], "name string"),
            spark.createDataFrame([(k, i, p) for k, (ps, _) in known.items() for i, p in enumerate(ps)], "name string, position int, param string"),
            spark.createDataFrame([(k, s) for k, (_, s) in known.items()], "name string, source string"),
        )
        got, again = reconcile_delta(job_rows, catalog, state)
        want = compare(job_rows, catalog.snapshot(job_rows))
        assert sorted(got.drop("compared_again").collect(), key=repr) == sorted(want.select(got.drop("compared_again").columns).collect(), key=repr)
        if turn:
            assert again == len(touched) and got.filter("compared_again").count() <= again + 1
        touched = set(rng.sample(range(45), 6)) if turn < 2 else {5}
        for n in touched:
            if n % 3 == 0:
                jobs.pop(f"J{n}", None) or jobs.update({f"J{n}": (f"J{n}", "d", "Import", "s", None, "p", None)})
            elif n % 3 == 1:
                known.pop(f"j{n}", None) or known.update({f"j{n}": (["@a"], "nothing")})
            else:
                known[f"j{n}"] = (["@mon", "@more"], f"if @cnt > {1000 + turn}")
