"""Decision tables: coercion, thresholds, outcomes, reconcile and merge."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelyard.functions import coerce, errors, text
from parcelyard.operators import extract, profile, reconcile, validate
from parcelyard.plans import outcome
from parcelyard.sources import catalog


def values(spark, fn, raws):
    rows = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("raw"))).collect()]


NUMBERS = {
    "1,234.5": 1234.5, " 12 ": 12.0, "1.5": 1.5, "1e3": 1000.0, "(5)": -5.0, "-7": -7.0, "+7": 7.0, "7-": -7.0,
    "7+": 7.0, "1": 1.0, ".5": 0.5, "5.": 5.0, "1,2,3": 123.0, "1e-2": 0.01, "-1.5E+2": -150.0, "(1,000.25)": -1000.25,
    "¤5": 5.0, "5 ¤": 5.0, "(5 )": -5.0, "\t9\n": 9.0, "-0.5": -0.5, "5 -": -5.0,
    "abc": None, "": None, " ": None, ",5": None, ".": None, "1.2.3": None, "1.2,3": None, "--5": None, "-5-": None,
    "(-5)": None, "(5": None, "5)": None, "1 2": None, "1d": None, "0x1": None, "1e": None, "True": None, None: None,
}


@pytest.mark.parametrize("fn", [coerce.to_double, coerce.to_decimal])
def test_numbers(spark, fn):
    assert values(spark, fn, NUMBERS) == list(NUMBERS.values())


def test_number_words_and_range(spark):
    raws = ["NaN", " infinity", "-Infinity", "1e400", "8e28", "7e28", "-8e28", "1e-40"]
    doubles = values(spark, coerce.to_double, raws)
    assert str(doubles[0]) == "nan" and doubles[1:4] == [float("inf"), float("-inf"), float("inf")]
    assert values(spark, coerce.to_decimal, raws) == [None, None, None, None, None, 7e28, None, 0.0]


def test_integers(spark):
    table = {
        " 12 ": 12, "-7": -7, "+7": 7, "1": 1, "9223372036854775807": 2**63 - 1, "9223372036854775808": None,
        "1.5": None, "1,000": None, "(5)": None, "1e3": None, "abc": None, "": None, "7-": None, None: None,
    }
    assert values(spark, coerce.to_integer, table) == list(table.values())


def test_datetimes(spark):
    table = {
        "2024-02-29": dt.datetime(2024, 2, 29), "2024/02/29": dt.datetime(2024, 2, 29),
        " 2024-01-02 03:04 ": dt.datetime(2024, 1, 2, 3, 4), "2024-01-02T03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04:05.25": dt.datetime(2024, 1, 2, 3, 4, 5, 250000),
        "2024-02-30": None, "2024-13-01": None, "2024-01-02 25:00": None, "1.5": None, "2024": None, "2024-01": None,
        "2024-01/02": None, "20240102": None, "abc": None, None: None,
    }
    assert values(spark, coerce.to_datetime, table) == list(table.values())


def test_datetimes_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist on that day there
        assert values(spark, coerce.to_datetime, ["2024-03-10 02:30:00"]) == [dt.datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_booleans(spark):
    table = {"True": True, "false ": False, " TRUE": True, "1": None, "yes": None, "t": None, "": None, None: None}
    assert values(spark, coerce.to_boolean, table) == list(table.values())


def test_format_bytes(spark):
    table = {
        0: "0 B", 1: "1 B", 1023: "1023 B", 1024: "1 KB", 1536: "1.5 KB", -2048: "-2 KB", 1024**2: "1 MB",
        1024**3: "1 GB", 1024**4: "1 TB", 1024**5: "1 PB", 1024**6: "1 EB", 1000 * 1024: "1000 KB",
        1152: "1.12 KB", -(2**63): "-8 EB", 2**63 - 1: "8 EB", 1408: "1.38 KB", None: None,
    }
    rows = spark.createDataFrame(list(enumerate(table)), "i int, n long")
    assert [r[0] for r in rows.orderBy("i").select(text.format_bytes(F.col("n"))).collect()] == list(table.values())


def test_format_duration(spark):
    table = {0.0: "0.0s", 59.94: "59.9s", 60.0: "1m 00s", 65.9: "1m 05s", 3725.0: "62m 05s", None: None}
    rows = spark.createDataFrame(list(enumerate(table)), "i int, s double")
    assert [r[0] for r in rows.orderBy("i").select(text.format_duration(F.col("s"))).collect()] == list(table.values())


def test_base_name_prefix_and_run_id(spark):
    row = spark.range(1).select(
        text.base_name(F.lit("/a/b.x")), text.base_name(F.lit("C:\\o\\c.y")), text.base_name(F.lit("d")),
        text.prefix_or_default(F.lit(" \t"), F.lit("dflt")), text.prefix_or_default(F.lit(" p "), F.lit("dflt")),
        text.run_id(F.lit("s"), F.lit(dt.datetime(2024, 1, 1, 7, 5)).cast("timestamp_ntz"), "ABC"),
    ).first()
    assert list(row[:5]) == ["b.x", "c.y", "d", "dflt", "p"]
    assert len(row[5]) == 13 and row[5].startswith("ABC0705") and not set(row[5][7:]) & set("IO")


def test_threshold_from_source(spark):
    table = {
        "IF @cnt > 1800000 x": 1800000, "if   @CNT>5 if @cnt>6": 5, "if @count > 5": None, "select 1": None, None: None,
        "if @cnt\n>\n7": 7,
    }
    assert values(spark, text.threshold_from_source, table) == list(table.values())


def test_error_classes(spark):
    rows = spark.createDataFrame([(208,), (230,), (-2,), (40613,), (7,), (None,)], "code int")
    out = rows.select(errors.error_class(F.col("code")), errors.is_transient(F.col("code"))).collect()
    assert [tuple(r) for r in out] == [
        ("missing_object", False), ("permission_denied", False), ("timeout", True), ("other", True), ("other", False),
        (None, None),
    ]


def test_collapsed_messages(spark):
    rows = spark.createDataFrame([
        (0, [" a ", "b", "a"]), (1, ["One or more errors occurred. (x)", "real"]), (2, []),
        (3, ["x See the inner exception for details."]),
    ], "i int, m array<string>")
    got = [r[0] for r in rows.orderBy("i").select(errors.collapse_messages(F.col("m"))).collect()]
    assert got == ["a — b", "real", "An unknown error occurred.", "An unknown error occurred."]


def test_requests(spark):
    table = [
        (True, 20240101, 20240131, "ok", True), (True, 202401, 20240131, "mon_not_8_digits", False),
        (True, 20240101, 202401, "mon1_not_8_digits", False), (True, 20240102, 20240101, "mon1_before_mon", True),
        (False, 202401, None, "ok", True), (False, 20240101, None, "mon_not_6_digits", False),
        (True, 20241301, 20241340, "ok", False), (False, 202413, None, "ok", False),
        (False, 99999999, None, "mon_not_6_digits", False), (False, 2**31 - 1, None, "mon_not_6_digits", False),
        (True, -2024010, 20240101, "ok", False),
        (True, 20240101, 20240101, "ok", True), (True, 20240101, None, "mon1_not_8_digits", False),
    ]
    rows = spark.createDataFrame(
        [(i, h, m, m1, "", "d") for i, (h, m, m1, _, _) in enumerate(table)],
        "request_id int, has_mon1 boolean, mon int, mon1 int, prefix string, default_prefix string",
    )
    got = extract.check_requests(rows).orderBy("request_id").collect()
    assert [(r["status"], r["is_calendar_date"]) for r in got] == [t[3:] for t in table]


def test_run_job_wants_exactly_its_parameters(spark):
    job = extract.Job("j", "select * from {t} where id >= :mon", ("mon",))
    assert extract.run_job(spark, job, {"mon": 3}, t=spark.range(5)).count() == 2
    with pytest.raises(ValueError):
        extract.run_job(spark, job, {"mon": 3, "mon1": 4}, t=spark.range(5))


def test_profile_of_every_type(spark):
    df = spark.sql("""select cast(1 as smallint) a, 1 b, 1L c, cast(1 as float) d, 1.5D e, 1.5BD f,
        date'2024-01-01' g, timestamp_ntz'2024-01-01 00:00:00' h, true i, binary('x') j, cast(1 as tinyint) k,
        interval 1 day l, array(1) m, 'abc' n, repeat('x', 300) o, '' p, cast(null as string) q""")
    got = {r["name"]: (r["target_type"], r["max_len"]) for r in profile.profile_map(df).collect()}
    assert got == {
        "a": ("SHORT", None), "b": ("LONG", None), "c": ("LONG", None), "d": ("DOUBLE", None), "e": ("DOUBLE", None),
        "f": ("DOUBLE", None), "g": ("DATETIME", None), "h": ("DATETIME", None), "i": ("YESNO", None),
        "j": ("LONGBINARY", None), "k": ("TEXT(255)", 255), "l": ("TEXT(255)", 255), "m": ("MEMO", -1),
        "n": ("TEXT(255)", 3), "o": ("MEMO", 300), "p": ("MEMO", 0), "q": ("MEMO", 0),
    }
    row = profile.apply_profile(df.drop("j")).first()
    assert (row["k"], row["l"], row["m"], row["f"]) == ("1", "INTERVAL '1' DAY", "[1]", 1.5)
    assert profile.apply_profile(df).first()["j"] == bytearray(b"x")


def test_declared_sizes_are_not_measured(spark):
    schema = T.StructType([
        T.StructField("s", T.StringType(), True, {"max_len": 300}), T.StructField("t", T.StringType(), True, {"max_len": 10})
    ])
    df = spark.createDataFrame([("x", "y")], schema)
    rows = {r["name"]: (r["max_len"], r["target_type"]) for r in profile.profile_map(df).collect()}
    assert rows == {"s": (300, "MEMO"), "t": (10, "TEXT(255)")}


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x")], "`a]b` int, `c.d` string")
    ddl = [r["column_ddl"] for r in profile.target_ddl(df, "t").orderBy("position").collect()]
    assert ddl == ["[a]]b] LONG", "[c.d] TEXT(255)"]
    assert profile.apply_profile(df).columns == ["a]b", "c.d"]


def test_quarantine_divides_all_rows(spark):
    df = spark.createDataFrame(
        [(1, "1", "x"), (2**40, "40000", "x"), (3, "nope", "x" * 300), (-(2**31), "-32768", None), (None, None, "")],
        "n long, s string, t string",
    )
    good, bad = profile.quarantine(df, profile.profile_rules(df, {"s": "SHORT", "t": "TEXT(255)"}))
    assert good.count() + bad.count() == 5
    reasons = {r["s"]: list(r["reject_reasons"]) for r in bad.collect()}
    assert reasons == {"40000": ["int32_overflow:n", "int16_overflow:s"], "nope": ["text_overflow:t"]}
    assert {r["n"] for r in profile.apply_profile(good).collect()} == {1, -(2**31), None}


def test_quarantine_without_rules(spark):
    good, bad = profile.quarantine(spark.createDataFrame([("a",)], "t string"), {})
    assert good.count() == 1 and bad.count() == 0 and bad.schema["reject_reasons"].dataType == T.ArrayType(T.StringType())


def status_of(spark, counts, threshold, **options):
    frame = spark.createDataFrame(list(enumerate(counts, 1)), "split_id int, row_count long")
    return validate.threshold_status(frame, threshold, "T", len(counts), **options)


@pytest.mark.parametrize(
    ("counts", "threshold", "options", "exceeds"),
    [
        ([5, 6], 5, {}, [False, True]), ([5, 6], 0, {}, [False, False]), ([5, 6], None, {}, [False, False]),
        ([6], 5, {}, [True]), ([6], 5, {"strict_parity": True}, [False]), ([6, 6], 5, {"strict_parity": True}, [True, True]),
    ],
)
def test_threshold_status(spark, counts, threshold, options, exceeds):
    rows = status_of(spark, counts, threshold, **options).orderBy("split_id").collect()
    assert [r["exceeds"] for r in rows] == exceeds
    assert [r["table_name"] for r in rows] == (["T"] if len(counts) == 1 else [f"T_{i + 1}" for i in range(len(counts))])


def test_policies(spark):
    status = status_of(spark, [5, 6, 4], 5)
    kept = {p: sorted(r[0] for r in validate.deliverable_splits(status, p).select("split_id").collect())
            for p in validate.POLICIES}
    assert kept == {"all": [1, 2, 3], "valid_only": [1, 3], "cancel": []}
    fine = status_of(spark, [5, 4], 5)
    assert validate.deliverable_splits(fine, "cancel").count() == 2
    with pytest.raises(validate.NothingToDeliver):
        validate.deliverable_splits(status_of(spark, [6, 7], 5), "valid_only")
    with pytest.raises(ValueError):
        validate.deliverable_splits(fine, "some")
    assert tuple(validate.threshold_summary(status_of(spark, [], 5)).first()) == (0, 0, 0, False)


OUTCOMES = [
    # rows, splits, violations, policy, threshold, code -> outcome, success, planned, warnings
    (0, 0, 0, "all", 5, None, "empty", True, 0, 1),
    (9, 1, 0, "all", 5, None, "delivered", True, 1, 1),
    (9, 1, 0, "all", 0, None, "delivered", True, 1, 0),
    (9, 3, 0, "cancel", 5, None, "delivered", True, 3, 0),
    (9, 3, 1, "all", 5, None, "delivered", True, 3, 1),
    (9, 3, 1, "valid_only", 5, None, "partly_delivered", True, 2, 1),
    (9, 3, 3, "valid_only", 5, None, "nothing_valid", False, 0, 0),
    (9, 3, 1, "cancel", 5, None, "cancelled", False, 0, 0),
    (9, 3, 1, "cancel", 5, 208, "failed", False, 0, 0),
    (0, 0, 0, "all", 5, 1205, "failed", False, 0, 0),
]


def test_outcomes(spark):
    rows = spark.createDataFrame(
        [(i, "S", *case[:6], "d", 0) for i, case in enumerate(OUTCOMES)],
        "process_id int, staging_table string, total_rows long, splits int, violations int, policy string, "
        "threshold long, error_code int, error_detail string, rejects long",
    )
    got = outcome.run_outcome(rows).orderBy("process_id").collect()
    assert [(r["outcome"], r["success"], r["planned_files"], len(r["warnings"])) for r in got] == [c[6:] for c in OUTCOMES]


REGISTRY = "name string, display_name string, data_type string, staging_table string, parameters array<string>, file_prefix string, threshold long"
CATALOG = "key string, name string, params array<string>, has_source boolean, db_threshold long, source string"


def entry(name, params, threshold):
    return (name, name, "Export", "S", params, "P", threshold)


def known(name, params, has_source, threshold):
    return (name.lower(), name, params, has_source, threshold, None)


DECISIONS = [
    # registry parameters, threshold; catalog parameters, has source, threshold -> status, params_match, threshold_match
    (["mon"], 5, None, None, None, "MISSING", False, False),
    (["mon"], 5, ["MON"], True, 5, "VALID", True, True),
    (["a", "b"], 5, ["b", "a"], True, 5, "VALID", True, True),
    (["a"], 5, ["a", "b"], True, 5, "MISMATCH", False, True),
    (["a", "b"], 5, ["a"], True, 5, "MISMATCH", False, True),
    (["a"], 5, ["a"], True, None, "MISMATCH", True, False),
    (["a"], 5, ["a"], True, 6, "MISMATCH", True, False),
    (["a"], 0, ["a"], True, 6, "MISMATCH", True, False),
    (["a"], None, ["a"], True, 6, "MISMATCH", True, False),
    (["a"], None, ["a"], True, None, "VALID", True, True),
    (["a"], 0, ["a"], True, None, "VALID", True, True),
    (["a"], 5, ["a"], False, None, "VALID", True, False),
    ([], None, [], True, None, "VALID", True, True),
]


def decision_tables(spark):
    registry = spark.createDataFrame([entry(f"J{i:02}", d[0], d[1]) for i, d in enumerate(DECISIONS)], REGISTRY)
    snapshot = spark.createDataFrame(
        [known(f"j{i:02}", *d[2:5]) for i, d in enumerate(DECISIONS) if d[2] is not None], CATALOG
    )
    return registry, snapshot


def test_reconcile_decisions(spark):
    got = reconcile.compare(*decision_tables(spark)).orderBy("name").collect()
    assert [(r["status"], r["params_match"], r["threshold_match"]) for r in got] == [d[5:] for d in DECISIONS]
    assert all(bool(r["details"]) == (r["status"] != "VALID") for r in got)


def test_autofix_makes_everything_valid_but_the_missing(spark):
    registry, snapshot = decision_tables(spark)
    fixed = reconcile.autofix(reconcile.compare(registry, snapshot)).drop("fixed")
    again = reconcile.compare(fixed, snapshot).groupBy("status").count().collect()
    assert {r[0]: r[1] for r in again} == {"MISSING": 1, "VALID": len(DECISIONS) - 1}


def test_sample_report(spark):
    """Three entries, two valid, one with a threshold of another size."""
    registry = spark.createDataFrame([entry(n, ["mon", "mon1"], 2100000) for n in ("A", "B", "C")], REGISTRY)
    snapshot = spark.createDataFrame(
        [known(n, ["mon", "mon1"], True, t) for n, t in (("A", 2100000), ("B", 210000), ("C", 2100000))], CATALOG
    )
    compared = reconcile.compare(registry, snapshot)
    assert tuple(reconcile.status_summary(compared).first()) == (3, 2, 0, 1, True)
    details = compared.filter("name = 'B'").first()["details"]
    assert details == ["Threshold MISMATCH: JSON=2,100,000  DB=210,000"]


def test_expected_statuses_of_the_derived_registry(spark):
    from workload import queries

    row = queries.reconcile_summary(spark, "/root/testdata/sf0.01").first()
    assert (row["total"], row["missing"], row["mismatch"], row["valid"]) == (2000, 118, 422, 1460)


def test_sync_decisions(spark):
    registry = spark.createDataFrame([
        entry("Keep", ["a"], 1), entry("Same", ["a", "b"], 5), entry("Order", ["a", "b"], 5),
        entry("Limit", ["a"], 5), entry("Zero", ["a"], 0), entry("Drop", ["a"], 7), entry("Gone", ["a"], 1),
    ], REGISTRY)
    snapshot = spark.createDataFrame([
        known("SAME", ["A", "B"], True, 5), known("ORDER", ["b", "a"], True, 5), known("LIMIT", ["a"], True, 6),
        known("ZERO", ["a"], True, None), known("DROP", ["a"], True, None), known("My_IMP_X", ["a"], True, 9),
    ], CATALOG)
    names = ["same", "Order", "limit", "Zero", "drop", "my_imp_x", "Gone", "nowhere"]
    master = spark.createDataFrame([(n.lower(), n) for n in names], "key string, name string")
    synced = reconcile.sync(registry, snapshot, master)
    got = {r["name"]: (r["status"], r["parameters"], r["threshold"]) for r in synced.collect()}
    assert got == {
        "Keep": ("RETAINED", ["a"], 1), "Same": ("UNMODIFIED", ["a", "b"], 5), "Order": ("UPDATED", ["b", "a"], 5),
        "Limit": ("UPDATED", ["a"], 6), "Zero": ("UNMODIFIED", ["a"], 0), "Drop": ("UPDATED", ["a"], 0),
        "My_IMP_X": ("ADDED", ["a"], 9), "Gone": ("MISSING_IN_DB", ["a"], 1), "nowhere": ("MISSING_IN_DB", None, None),
    }
    added = synced.filter("status = 'ADDED'").first()
    assert (added["display_name"], added["data_type"], added["staging_table"], added["file_prefix"]) == (
        "My IMP X", "Import", "TODO_FILL_THIS_IN", "Import_X"
    )
    assert reconcile.synced_registry(synced).count() == 8
    summary = reconcile.sync_summary(synced).first()
    assert tuple(summary) == (8, 1, 1, 3, 2, 2, True)
    again = reconcile.sync(reconcile.synced_registry(synced), snapshot, master)
    assert not reconcile.sync_summary(again).first()["changed"]


def test_hot_name_in_registry_does_not_multiply(spark):
    """A third of the entries share a name that differs in case only; each stays one row."""
    registry = spark.range(300).selectExpr(
        "if(id < 100, if(id % 2 = 0, 'Hot', 'HOT'), concat('J', id)) as name", "'d' as display_name",
        "'Export' as data_type", "concat('S', id) as staging_table", "array('a') as parameters", "'p' as file_prefix",
        "5L as threshold",
    )
    snapshot = spark.createDataFrame([known("hot", ["a"], True, 5)], CATALOG)
    assert reconcile.compare(registry, snapshot).groupBy("status").count().orderBy("status").collect()[1][1] == 100
    master = spark.createDataFrame([("hot", "hot")], "key string, name string")
    assert reconcile.sync(registry, snapshot, master).count() == 1 + 200


def test_families(spark):
    names = ["A", "A_1", "A_2", "A_4", "B", "C", "C_2", "D", "d_1", "E_1", "F"] + [f"F_{i}" for i in range(1, 13)]
    tables = spark.createDataFrame([(n,) for n in names], "name string")
    bases = spark.createDataFrame([(b,) for b in "ABCDF"], "base string")
    got = catalog.discover_families(tables, bases).orderBy("base", "split_id").collect()
    found = {}
    for r in got:
        found.setdefault(r["base"], []).append(r["table_name"])
    assert found == {
        "A": ["A_1", "A_2"], "B": ["B"], "C": ["C"], "D": ["D_1"], "F": [f"F_{i}" for i in range(1, 10)],
    }
    assert {r["base"]: r["ignored_tables"] for r in got} == {"A": 1, "B": 0, "C": 1, "D": 0, "F": 3}
    ignored = sorted(r["name"] for r in catalog.ignored_siblings(tables, bases).collect())
    assert ignored == ["A_4", "C_2", "F_10", "F_11", "F_12"]


def test_families_without_the_limit(spark):
    names = ["A_1", "a_2", "A_4", "B", "C_2", "C_3"] + [f"F_{i}" for i in [*range(1, 13), 14]] + ["f_3"]
    tables = spark.createDataFrame([(n,) for n in names], "name string")
    bases = spark.createDataFrame([(b,) for b in "ABCFf"], "base string")
    got = catalog.discover_families(tables, bases, limit=False).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["split_id"]):
        found.setdefault(r["base"], []).append(r["table_name"])
    assert found == {"A": ["A_1", "A_2"], "B": ["B"], "C": ["C"], "F": [f"F_{i}" for i in range(1, 13)]}
    assert {r["base"]: r["ignored_tables"] for r in got} == {"A": 1, "B": 0, "C": 2, "F": 2}
    ignored = sorted(r["name"] for r in catalog.ignored_siblings(tables, bases, limit=False).collect())
    assert ignored == ["A_4", "C_2", "C_3", "F_14"]


def test_read_family(spark):
    for i in (1, 2, 4):
        spark.range(i).createOrReplaceTempView(f"fam_{i}")
    spark.range(9).createOrReplaceTempView("lone")
    rows = catalog.read_family(spark, "fam").groupBy("split_id").count().collect()
    assert {r[0]: r[1] for r in rows} == {1: 1, 2: 2}
    assert catalog.read_family(spark, "lone").count() == 9


def test_snapshot_keeps_routines_without_parameters_and_merges_copies(spark):
    routines = spark.createDataFrame([("P",), ("Q",), ("q",)], "name string")
    params = spark.createDataFrame(
        [("P", 2, "@b"), ("P", 1, "@a"), ("p", 1, "@a"), ("Q", 1, None)], "name string, position int, param string"
    )
    source = spark.createDataFrame([("p", "if @cnt > 3")], "name string, source string")
    got = {r["key"]: (r["name"], r["params"], r["has_source"], r["db_threshold"])
           for r in catalog.catalog_snapshot(routines, params, source).collect()}
    assert got == {"p": ("P", ["a", "b"], True, 3), "q": ("Q", [], False, None)}


def test_hot_routine_and_hot_family(spark):
    """Copies of one routine's rows, and the siblings of one base, are a third of everything."""
    n = 30_000
    hot = spark.range(n).selectExpr("if(id % 2 = 0, 'Hot', 'HOT') as name", "int(id % 3) as position", "concat('@p', id % 3) as param")
    rest = spark.range(2 * n).selectExpr("concat('J', id) as name", "1 as position", "'@mon' as param")
    params = hot.unionByName(rest)
    got = catalog.catalog_snapshot(params.select("name"), params, spark.createDataFrame([], "name string, source string"))
    assert got.count() == 2 * n + 1
    assert got.filter("key = 'hot'").first()["params"] == ["p0", "p1", "p2"]
    names = spark.range(1, n).selectExpr("concat('Hot_', id) as name").unionByName(rest.select("name"))
    bases = spark.createDataFrame([("Hot",), ("HOT",), ("J5",)], "base string")
    families = catalog.discover_families(names, bases).collect()
    assert sorted(r["table_name"] for r in families) == [f"HOT_{i}" for i in range(1, 10)] + ["J5"]
    assert families[0]["ignored_tables"] in (0, n - 10)
    assert catalog.ignored_siblings(names, bases).count() == n - 10


def test_master_list(spark):
    lines = spark.createDataFrame([(" b ",), ("B",), ("",), ("  \t",), ("a",)], "value string")
    assert [r["name"] for r in catalog.master_list(lines).collect()] == ["a", "B"]
