"""Run registered queries against their oracle SQL: ``python tests/oracle_check.py [sf] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(arrow: pa.Table) -> list[tuple]:
    """Rows as comparable texts, columns by name, in a fixed row order."""
    names = sorted(arrow.column_names)
    columns = [arrow.column(name).to_pylist() for name in names]
    return sorted(tuple(map(repr, row)) for row in zip(*columns))


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP"}


def difference(con: duckdb.DuckDBPyConnection, sql: str, result) -> str | None:
    """None when result and oracle agree on names, types and rows, else what differs."""
    relation = con.sql(sql)
    want_types = dict(zip(relation.columns, map(str, relation.types)))
    have_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in result.schema.fields}
    if want_types != have_types:
        return f"schema {sorted(set(have_types.items()) ^ set(want_types.items()))}"
    want, have = normal(relation.to_arrow_table()), normal(result.toArrow())
    if len(want) != len(have):
        return f"rows {len(have)} instead of {len(want)}"
    wrong = [pair for pair in zip(have, want) if pair[0] != pair[1]]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0][0]} instead of {wrong[0][1]} ({sorted(want_types)})"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.monotonic()
        try:
            result = queries[name](spark, sf_dir)
            verdict = difference(con, oracles[name], result) if name in oracles else f"no oracle, {result.count()} rows"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += name in oracles and verdict is not None
        print(f"{name:26s} {time.monotonic() - start:6.2f}s {verdict or 'ok'}", flush=True)
    print(f"{bad} of {len(queries)} disagree")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
