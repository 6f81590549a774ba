"""Every registered query against its oracle SQL, and the contract of the entry module."""

import pytest
from oracle_check import connect, difference

import __spark_entry__ as entry

OPTIONAL = set(entry.LLM_QUERIES)  # tested in their own folder
QUERIES = {k: v for k, v in entry.queries().items() if k not in OPTIONAL}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k not in OPTIONAL}
# Sizes of stored files differ by engine; test_storage_size_is_that_of_the_files checks them.
WITHOUT_ORACLE = {"storage_size"}


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, duck, name):
    assert difference(duck, ORACLES[name], QUERIES[name](spark, sf)) is None


def test_every_query_has_an_oracle_but_those_named():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_ORACLE
    assert set(ORACLES) <= set(QUERIES)


def test_storage_size_is_that_of_the_files(spark, sf):
    from pathlib import Path

    files = list(Path(sf).glob("*.parquet"))
    row = QUERIES["storage_size"](spark, sf).first()
    assert (row["files"], row["size_bytes"]) == (len(files), sum(f.stat().st_size for f in files))


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert sum(r["row_count"] for r in rows) > 0
    assert not any(r["exceeds"] for r in rows)
    assert [r["split_id"] for r in sorted(rows)] == list(range(1, len(rows) + 1))
