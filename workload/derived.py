"""Inputs of the registered queries, derived by Spark from the given tables.

The delivery engine works on manifests, catalogs, run facts and the like. Every such table here is a
deterministic expression over one of the given tables, row by row or by key, so it grows with them.
``workload/oracles.py`` states the same definitions in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelyard.functions.text import run_id


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Tables whose column types the target profile and its oracle cover.
FLAT_TABLES = (
    "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations"
).split()


# ---- registry and catalog, from part ------------------------------------------------------------

_JOB = "concat('Job_', if(p_partkey % 2 = 1, 'EXP', 'IMP'), '_', p_partkey)"


def registry(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        f"{_JOB} as name",
        "concat('Job ', if(p_partkey % 2 = 1, 'EXP', 'IMP'), ' ', p_partkey) as display_name",
        "if(p_partkey % 2 = 1, 'Export', 'Import') as data_type",
        "concat('STG_', p_partkey) as staging_table",
        "array('mon', 'mon1') as parameters",
        "concat(if(p_partkey % 2 = 1, 'Export_', 'Import_'), p_partkey) as file_prefix",
        "if(p_partkey % 19 = 0, null, 100000L * (p_size + 1)) as threshold",
    )


def manifest_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Registry entries with defects: missing fields, placeholder table, unknown data type."""
    return table(spark, sf, "part").selectExpr(
        f"{_JOB} as name",
        "concat('Job ', p_partkey) as display_name",
        "case when p_partkey % 31 = 0 then 'Unknown' when p_partkey % 2 = 1 then 'Export' else 'Import' end as data_type",
        "case when p_partkey % 23 = 0 then 'TODO_FILL_THIS_IN' when p_partkey % 29 = 0 then null"
        " else concat('STG_', p_partkey) end as staging_table",
        "if(p_partkey % 7 = 0, array('mon'), array('mon', 'mon1')) as parameters",
        "if(p_partkey % 37 = 0, ' ', concat('Out_', p_partkey)) as file_prefix",
        "if(p_partkey % 19 = 0, null, 100000L * (p_size + 1)) as threshold",
    )


def catalog_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """routines(name), params(name, position, param), source(name, source)."""
    part = table(spark, sf, "part").selectExpr("p_partkey as k", "p_size", f"upper({_JOB}) as job")
    routines = part.filter("k % 17 <> 0").select(F.col("job").alias("name")).unionByName(
        part.filter("k % 50 = 7").selectExpr("concat('Extra_EXP_', k) as name")
    )
    params = part.selectExpr(
        "job as name",
        """inline(array(
            named_struct('position', if(k % 23 = 0, 2, 1), 'param', '@mon'),
            named_struct('position', if(k % 23 = 0, 1, 2), 'param', if(k % 11 = 0, '@month_end', '@MON1'))
        ))""",
    )
    source = part.filter("k % 31 <> 0").selectExpr(
        "job as name",
        """case when k % 29 = 0 then 'select 1'
           else concat('declare @cnt int; IF @cnt > ',
                       100000L * (p_size + 1) + if(k % 13 = 0, 7, 0), ' begin split end') end as source""",
    ).unionByName(
        part.filter("k % 100 = 7").selectExpr("concat('Extra_EXP_', k) as name", "concat('if @cnt>', k) as source")
    )
    return routines, params, source


def master_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a master list: padded, repeated in another case, blank, and names beyond the registry."""
    part = table(spark, sf, "part").selectExpr("p_partkey as k", f"{_JOB} as job")
    lines = F.expr("""filter(array(
        if(k % 3 = 0, concat('  ', job, ' '), null),
        if(k % 6 = 0, upper(job), null),
        if(k % 10 = 0, '   ', null),
        if(k % 50 = 7, concat('extra_exp_', k), null),
        if(k % 50 = 9, concat('Ghost_', k), null)
    ), x -> x is not null)""")
    return part.select(F.explode(lines).alias("value"))


def family_names(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """names(name) and bases(base): families with a gap, without a first sibling, with twelve, and so on."""
    part = table(spark, sf, "part").selectExpr("p_partkey as k", "concat('Tab', p_partkey) as base")
    numbers = F.expr("""case k % 8
        when 1 then array(1, 2, 4) when 2 then array(2) when 3 then array(1)
        when 4 then sequence(1, 12) when 5 then sequence(1, 3) when 6 then array(1)
        when 7 then sequence(1, 9) else array() end""")
    siblings = part.select("k", "base", F.explode(numbers).alias("n")).selectExpr(
        "if(k % 8 = 5, lower(concat(base, '_', n)), concat(base, '_', n)) as name"
    )
    names = siblings.unionByName(part.select(F.col("base").alias("name")))
    return names, part.filter("k % 8 <> 6").select("base")


# ---- raw text, from orders ----------------------------------------------------------------------


def raw_values(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as id",
        """case o_orderkey % 14
            when 0 then '1,234.5' when 1 then ' 12 ' when 2 then '1.5' when 3 then '1e3'
            when 4 then '(5)' when 5 then '-7' when 6 then 'abc' when 7 then 'True'
            when 8 then 'false ' when 9 then '1' when 10 then '2024-02-30' when 11 then null
            when 12 then cast(o_custkey as string) || '-'
            else date_format(o_orderdate, 'yyyy-MM-dd') end as raw""",
    )


def quarantine_input(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderkey * 10000000 as big_key", "o_totalprice", "o_orderdate", "o_orderpriority"
    )


# ---- requests, errors, durations, from events ---------------------------------------------------


def requests(spark: SparkSession, sf: str) -> DataFrame:
    day = "cast(date_format(ts, 'yyyyMMdd') as int)"
    month = "cast(date_format(ts, 'yyyyMM') as int)"
    return table(spark, sf, "events").selectExpr(
        "event_id as request_id",
        "event_id % 4 <> 0 as has_mon1",
        f"""case when event_id % 17 = 0 and event_id % 4 <> 0 then 20241301
             when event_id % 17 = 0 then 202413
             when event_id % 11 = 0 then {month}
             when event_id % 4 <> 0 then {day} else {month} end as mon""",
        f"""case when event_id % 4 = 0 then null
             when event_id % 13 = 0 then {day} - 1
             when event_id % 19 = 0 then {month}
             else 20241231 end as mon1""",
        "case when event_id % 5 = 0 then '  ' else concat(' out_', event_type, ' ') end as prefix",
        "concat('Export_', event_type) as default_prefix",
    )


_CODES = "array(208, 229, 230, 18456, -2, 258, 1205, 515, 547, 4060, 99999)"


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id",
        f"element_at({_CODES}, cast(event_id % 11 as int) + 1) as code",
        "cast(event_id % 4 as int) + 1 as attempt",
        "concat('object of ', event_type) as detail",
        """array(concat(' outer ', event_type, ' '),
                 'One or more errors occurred. (inner)',
                 concat('inner ', cast(event_id % 7 as string)),
                 concat('outer ', event_type),
                 if(event_id % 9 = 0, 'failed. See the inner exception for details.', 'disk full')) as messages""",
        """if(event_id % 13 = 0, array('One or more errors occurred.'), null) as only_wrappers""",
    )


# ---- runs and files, from orders ----------------------------------------------------------------

_MONTH = "(12 * year(o_orderdate) + month(o_orderdate))"


def _rows_per_month_and_priority(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(F.expr(_MONTH).alias("m"), "o_orderpriority").agg(
        F.count("*").alias("rows"), F.min("o_orderdate").alias("first_day")
    )


def run_facts(spark: SparkSession, sf: str) -> DataFrame:
    """One run per month of orders; its splits are the priorities."""
    month = Window.partitionBy("m")
    per_split = _rows_per_month_and_priority(spark, sf).withColumns({
        "month_rows": F.sum("rows").over(month),
        "priorities": F.count("*").over(month),
    }).withColumn("threshold", F.expr(
        "case when m % 4 = 0 then 0L when m % 7 = 3 then 1L else month_rows div priorities end"
    ))
    months = per_split.groupBy("m", "threshold", "priorities").agg(
        F.sum("rows").alias("rows"),
        F.min(F.date_trunc("month", F.col("first_day"))).cast("timestamp_ntz").alias("month_start"),
        F.sum(F.expr("int(threshold > 0 and rows > threshold)")).alias("over"),
    )
    facts = months.selectExpr(
        "m",
        "concat('run', m) as seed",
        "concat('Job_', if(m % 2 = 0, 'EXP', 'IMP'), '_', m % 8) as job",
        "concat('STG_', m % 8) as staging_table",
        """array(named_struct('name', 'mon', 'value', cast(date_format(month_start, 'yyyyMM') as int) * 100 + 1),
                 named_struct('name', 'mon1', 'value', cast(date_format(month_start, 'yyyyMM') as int) * 100 + 28))
           as parameters""",
        "month_start + make_dt_interval(0, cast(m % 24 as int), cast(m % 60 as int), 0) as start_time",
        "cast((m % 7) * 0.5 + (m % 7) * 13.25 + 0.75 as double) as duration_s",
        "cast((m % 7) * 0.5 as double) as sp_s",
        "cast((m % 7) * 13.25 as double) as write_s",
        "if(m % 10 = 0, 0L, rows) as total_rows",
        "if(m % 5 = 0, 1, cast(priorities as int)) as splits",
        "if(m % 5 = 0, 0, cast(over as int)) as violations",
        "case m % 3 when 0 then 'all' when 1 then 'valid_only' else 'cancel' end as policy",
        "threshold",
        f"if(m % 9 = 0, element_at({_CODES}, cast(m % 11 as int) + 1), null) as error_code",
        "concat('job ', m % 8) as error_detail",
        "cast(m % 3 as bigint) as rejects",
    )
    return facts.withColumn("process_id", run_id(F.col("seed"), F.col("start_time"))).drop("seed")


def delivery_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the months that were neither empty nor failed: one per priority."""
    runs = run_facts(spark, sf).filter("total_rows > 0 and error_code is null")
    per_split = _rows_per_month_and_priority(spark, sf)
    files = per_split.join(runs.select("m", "process_id", "start_time", "job"), "m")
    return files.selectExpr(
        "process_id",
        "cast(substr(o_orderpriority, 1, 1) as int) as file_index",
        """concat('/out/', job, '/', job, '_', substr(o_orderpriority, 1, 1), '_',
                  date_format(start_time, 'ddMMyyyy'), '.parquet') as path""",
        "concat(job, '_', substr(o_orderpriority, 1, 1)) as table_name",
        "rows",
        "rows * 64 as table_size_bytes",
        "rows * 24 as file_size_bytes",
    )
