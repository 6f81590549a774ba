"""Physical plans: no one-task window, no cross join, filters in the scan, no needless shuffle."""

import re

from parcelyard.operators import split, staging, validate
from workload import queries


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_crosses_or_gathers_all_rows(spark, sf):
    for name, query in queries.QUERIES.items():
        if name == "stream_capped_split":
            continue
        plan = plan_of(query(spark, sf))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        first_terms = re.findall(r"windowspecdefinition\(([^,]*),", plan)
        assert not any(" ASC" in term or " DESC" in term for term in first_terms), name
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan, name


def test_key_numbers_need_no_wide_row_and_no_single_task(spark, sf):
    orders = queries._orders(spark, sf)
    numbered = split.key_counts(orders, "o_custkey")
    plan = plan_of(numbered)
    assert "Window" not in plan and "o_orderdate" not in plan
    rows = numbered.orderBy("split_id").collect()
    want = sorted(orders.groupBy("o_custkey").count().collect())
    assert [(r["split_id"], r["o_custkey"], r["row_count"]) for r in rows] == [(n, k, c) for n, (k, c) in enumerate(want, 1)]


def test_range_filter_reaches_the_scan(spark, sf):
    plan = plan_of(queries.extract_range(spark, sf))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    plan = plan_of(queries.extract_month(spark, sf))
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_counts_read_no_wide_column(spark, sf):
    plan = plan_of(split.split_counts(split.capped_split(staging.stage(queries._orders(spark, sf), ["o_orderkey"]), 100)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("o_" not in s for s in schemas)


def test_capped_split_shuffles_nothing_after_staging(spark, sf):
    staged = staging.stage(queries._orders(spark, sf), ["o_orderdate", "o_orderkey"])
    plan = plan_of(split.capped_split(staged, 100))
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan


def test_stored_split_shuffles_nothing(spark, sf):
    plan = plan_of(queries.capped_split_stored(spark, sf))
    assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan and "Sort" not in plan


def test_byte_split_does_not_shuffle_wide_rows(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    staged = staging.stage(documents, ["doc_id"], measure_bytes=True)
    plan = plan_of(split.byte_capped_split(staged, 100_000))
    lines = plan.splitlines()
    wide = next(i for i, line in enumerate(lines) if "FileScan" in line and "text#" in line)
    depth = re.match(r"[\s:+-]*", lines[wide]).end()
    above = [line for line in lines[:wide] if re.match(r"[\s:+-]*", line).end() < depth]
    assert not any("Exchange hashpartitioning" in line for line in above)


def test_capped_read_skips_partitions_by_filter(spark, sf):
    staged = staging.stage(spark.range(10_000), ["id"])
    assert "LessThanOrEqual(_part" in plan_of(split.capped_read(staged, 10))


def test_looking_for_rejects_skips_row_groups(spark, sf):
    plan = plan_of(queries.quarantine_rejects(spark, sf))
    assert "Or(Or(LessThan(o_orderkey,-2147483648),GreaterThan(o_orderkey,2147483647))" in plan.replace(" ", "")


def test_comparison_shuffles_no_source_text(spark, sf):
    plan = plan_of(queries.reconcile_status(spark, sf))
    assert "partial_count(1)" in plan and "min(source" not in plan


def test_storage_size_opens_no_file(spark, sf):
    plan = plan_of(queries.storage_size(spark, sf))
    assert "content" not in re.search(r"ReadSchema: struct<([^>]*)>", plan)[1]


def test_capped_read_neither_sorts_nor_writes_the_table(spark, sf, monkeypatch):
    events, staged = spark.read.parquet(f"{sf}/events.parquet"), []
    real = split.stage
    monkeypatch.setattr(split, "stage", lambda df, *args: staged.append(df) or real(df, *args))
    limit = events.count() // 10
    split.first_rows(events, ["ts", "event_id"], limit)
    plan = plan_of(staged[0])
    assert "LessThanOrEqual(ts," in plan and "Sort" not in plan and "Exchange" not in plan
    assert staged[0].count() == limit


def test_counts_decide_before_rows_are_moved(spark, sf):
    keys = validate.rows_of_keys(spark.range(10).withColumnRenamed("id", "k"), spark.createDataFrame([(1, 3)], "split_id int, _key long"), "k")
    assert [r["k"] for r in keys.collect()] == [3]
    plan = plan_of(queries.delivery_plan(spark, sf))
    assert "o_orderdate" not in plan and "o_totalprice" not in plan
