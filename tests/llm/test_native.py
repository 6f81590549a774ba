"""Operators that must be DataFrame code alone: no Python function runs in a task, in the result or on the way to it."""

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from parcelyard.llm import decontaminate, queries


@pytest.mark.parametrize("name", ["op6_decontamination", "op10_line_dedup"])
def test_no_python_in_tasks(spark, sf, monkeypatch, name):
    def refused(*args, **options):
        raise AssertionError("Python in a task")

    for method in ("mapInArrow", "mapInPandas", "toPandas"):
        monkeypatch.setattr(DataFrame, method, refused)
    monkeypatch.setattr(DataFrame, "rdd", property(refused))
    for function in ("udf", "pandas_udf", "arrow_udf", "udtf"):
        monkeypatch.setattr(decontaminate.F, function, refused, raising=False)
    found = queries.QUERIES[name](spark, sf)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert found.count() > 0
