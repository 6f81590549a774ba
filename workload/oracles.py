"""DuckDB SQL for every registered query that SQL can express, over the same tables."""

from __future__ import annotations

from workload.queries import BYTE_CAP, ROW_CAP

ORACLES: dict[str, str] = {}

# ---- derived inputs -----------------------------------------------------------------------------

JOB = "('Job_' || CASE WHEN p_partkey % 2 = 1 THEN 'EXP' ELSE 'IMP' END || '_' || p_partkey)"

REGISTRY = f"""registry AS (
  SELECT {JOB} AS name,
         'Job ' || CASE WHEN p_partkey % 2 = 1 THEN 'EXP' ELSE 'IMP' END || ' ' || p_partkey AS display_name,
         CASE WHEN p_partkey % 2 = 1 THEN 'Export' ELSE 'Import' END AS data_type,
         'STG_' || p_partkey AS staging_table,
         ['mon', 'mon1'] AS parameters,
         CASE WHEN p_partkey % 2 = 1 THEN 'Export_' ELSE 'Import_' END || p_partkey AS file_prefix,
         CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(100000 AS BIGINT) * (p_size + 1) END AS threshold
  FROM part)"""

MANIFEST = f"""manifest AS (
  SELECT {JOB} AS name, 'Job ' || p_partkey AS display_name,
         CASE WHEN p_partkey % 31 = 0 THEN 'Unknown' WHEN p_partkey % 2 = 1 THEN 'Export' ELSE 'Import' END AS data_type,
         CASE WHEN p_partkey % 23 = 0 THEN 'TODO_FILL_THIS_IN' WHEN p_partkey % 29 = 0 THEN NULL
              ELSE 'STG_' || p_partkey END AS staging_table,
         CASE WHEN p_partkey % 7 = 0 THEN 'mon' ELSE 'mon,mon1' END AS parameters,
         CASE WHEN p_partkey % 37 = 0 THEN ' ' ELSE 'Out_' || p_partkey END AS file_prefix,
         CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(100000 AS BIGINT) * (p_size + 1) END AS threshold
  FROM part)"""

CATALOG = f"""routines AS (
  SELECT upper({JOB}) AS name FROM part WHERE p_partkey % 17 <> 0
  UNION ALL SELECT 'Extra_EXP_' || p_partkey FROM part WHERE p_partkey % 50 = 7),
params AS (
  SELECT upper({JOB}) AS name, CASE WHEN p_partkey % 23 = 0 THEN 2 ELSE 1 END AS position, '@mon' AS param FROM part
  UNION ALL
  SELECT upper({JOB}), CASE WHEN p_partkey % 23 = 0 THEN 1 ELSE 2 END,
         CASE WHEN p_partkey % 11 = 0 THEN '@month_end' ELSE '@MON1' END FROM part),
source AS (
  SELECT upper({JOB}) AS name,
         CASE WHEN p_partkey % 29 = 0 THEN 'select 1'
              ELSE 'declare @cnt int; IF @cnt > '
                   || (CAST(100000 AS BIGINT) * (p_size + 1) + CASE WHEN p_partkey % 13 = 0 THEN 7 ELSE 0 END)
                   || ' begin split end' END AS source
  FROM part WHERE p_partkey % 31 <> 0
  UNION ALL SELECT 'Extra_EXP_' || p_partkey, 'if @cnt>' || p_partkey FROM part WHERE p_partkey % 100 = 7),
snapshot AS (
  SELECT lower(r.name) AS key, r.name,
         coalesce(p.params, []) AS params,
         s.source IS NOT NULL AS has_source,
         TRY_CAST(nullif(regexp_extract(s.source, '(?i)if\\s+@cnt\\s*>\\s*(\\d+)', 1), '') AS BIGINT) AS db_threshold,
         s.source
  FROM routines r
  LEFT JOIN (SELECT name, list(ltrim(param, '@') ORDER BY position) AS params FROM params GROUP BY name) p
    ON p.name = r.name
  LEFT JOIN source s ON s.name = r.name)"""

MASTER = f"""lines AS (
  SELECT '  ' || {JOB} || ' ' AS value FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT upper({JOB}) FROM part WHERE p_partkey % 6 = 0
  UNION ALL SELECT '   ' FROM part WHERE p_partkey % 10 = 0
  UNION ALL SELECT 'extra_exp_' || p_partkey FROM part WHERE p_partkey % 50 = 7
  UNION ALL SELECT 'Ghost_' || p_partkey FROM part WHERE p_partkey % 50 = 9),
master AS (
  SELECT lower(trim(value)) AS key, min(trim(value)) AS name FROM lines WHERE trim(value) <> '' GROUP BY 1)"""

FAMILY = """numbered AS (
  SELECT p_partkey AS k, 'Tab' || p_partkey AS base, unnest(CASE p_partkey % 8
    WHEN 1 THEN [1, 2, 4] WHEN 2 THEN [2] WHEN 3 THEN [1] WHEN 4 THEN range(1, 13) WHEN 5 THEN range(1, 4)
    WHEN 6 THEN [1] WHEN 7 THEN range(1, 10) ELSE [] END) AS n FROM part),
named AS (
  SELECT CASE WHEN k % 8 = 5 THEN lower(base) ELSE base END || '_' || n AS name, base, n::INT AS n FROM numbered),
bases AS (SELECT 'Tab' || p_partkey AS base FROM part WHERE p_partkey % 8 <> 6),
ranked AS (
  SELECT b.base, m.n, m.name, row_number() OVER (PARTITION BY b.base ORDER BY m.n) AS r
  FROM bases b JOIN named m ON m.base = b.base),
taken AS (SELECT base, n, name FROM ranked WHERE n = r AND n <= 9),
runs AS (SELECT base, count(*) AS run FROM taken GROUP BY base),
totals AS (SELECT base, count(*) AS numbered FROM ranked GROUP BY base)"""

RAW = """raw_values AS (
  SELECT o_orderkey AS id, CASE o_orderkey % 14
    WHEN 0 THEN '1,234.5' WHEN 1 THEN ' 12 ' WHEN 2 THEN '1.5' WHEN 3 THEN '1e3' WHEN 4 THEN '(5)'
    WHEN 5 THEN '-7' WHEN 6 THEN 'abc' WHEN 7 THEN 'True' WHEN 8 THEN 'false ' WHEN 9 THEN '1'
    WHEN 10 THEN '2024-02-30' WHEN 11 THEN NULL WHEN 12 THEN o_custkey || '-'
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM orders)"""

REQUESTS = """days AS (
  SELECT event_id, event_type, strftime(ts, '%Y%m%d')::INT AS d, strftime(ts, '%Y%m')::INT AS m FROM events),
requests AS (
  SELECT event_id AS request_id, event_id % 4 <> 0 AS has_mon1,
    CASE WHEN event_id % 17 = 0 AND event_id % 4 <> 0 THEN 20241301 WHEN event_id % 17 = 0 THEN 202413
         WHEN event_id % 11 = 0 THEN m WHEN event_id % 4 <> 0 THEN d ELSE m END AS mon,
    CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 13 = 0 THEN d - 1 WHEN event_id % 19 = 0 THEN m
         ELSE 20241231 END AS mon1,
    CASE WHEN event_id % 5 = 0 THEN '' ELSE 'out_' || event_type END AS prefix,
    'Export_' || event_type AS default_prefix
  FROM days)"""

CODES = "[208, 229, 230, 18456, -2, 258, 1205, 515, 547, 4060, 99999]"

ATTEMPTS = f"""attempts AS (
  SELECT event_id, {CODES}[(event_id % 11)::INT + 1] AS code, (event_id % 4)::INT + 1 AS attempt,
         'object of ' || event_type AS detail, event_type FROM events)"""

ALPHABET = "ABCDEFGHJKLMNPQRSTUVWXYZ0123456789"
PICKS = " || ".join(
    f"substr('{ALPHABET}', ('0x' || substr(md5('run' || m), {1 + 4 * i}, 4))::INT % 34 + 1, 1)" for i in range(6)
)

RUNS = f"""per_split AS (
  SELECT 12 * year(o_orderdate) + month(o_orderdate) AS m, o_orderpriority, count(*) AS rows,
         min(o_orderdate) AS first_day FROM orders GROUP BY 1, 2),
months AS (
  SELECT m, sum(rows)::BIGINT AS rows, count(*) AS priorities, min(date_trunc('month', first_day))::TIMESTAMP AS month_start,
         CASE WHEN m % 4 = 0 THEN 0 WHEN m % 7 = 3 THEN 1 ELSE sum(rows)::BIGINT // count(*) END::BIGINT AS threshold
  FROM per_split GROUP BY m),
over_t AS (
  SELECT p.m, sum(CASE WHEN threshold > 0 AND p.rows > threshold THEN 1 ELSE 0 END)::INT AS over_n
  FROM per_split p JOIN months USING (m) GROUP BY p.m),
run_facts AS (
  SELECT m, 'Job_' || CASE WHEN m % 2 = 0 THEN 'EXP' ELSE 'IMP' END || '_' || m % 8 AS job,
         'STG_' || m % 8 AS staging_table,
         '@mon=' || (strftime(month_start, '%Y%m') || '01') || ', @mon1=' || (strftime(month_start, '%Y%m') || '28') AS parameters,
         month_start + to_hours(m % 24) + to_minutes(m % 60) AS start_time,
         (m % 7) * 0.5::DOUBLE + (m % 7) * 13.25::DOUBLE + 0.75::DOUBLE AS duration_s,
         (m % 7) * 0.5::DOUBLE AS sp_s, (m % 7) * 13.25::DOUBLE AS write_s,
         CASE WHEN m % 10 = 0 THEN 0 ELSE rows END AS total_rows,
         CASE WHEN m % 5 = 0 THEN 1 ELSE priorities END AS splits,
         CASE WHEN m % 5 = 0 THEN 0 ELSE over_n END AS violations,
         CASE m % 3 WHEN 0 THEN 'all' WHEN 1 THEN 'valid_only' ELSE 'cancel' END AS policy,
         threshold,
         CASE WHEN m % 9 = 0 THEN {CODES}[(m % 11)::INT + 1] END AS error_code,
         'job ' || m % 8 AS error_detail, m % 3 AS rejects
  FROM months JOIN over_t USING (m)),
runs AS (
  SELECT 'RUN' || strftime(start_time, '%H%M') || {PICKS} AS process_id, * FROM run_facts)"""


def error_message(code: str, detail: str) -> str:
    return f"""CASE WHEN {code} IS NULL THEN NULL
      WHEN {code} = 208 THEN 'A table or view used by the job was not found; check its staging table. ' || {detail}
      WHEN {code} IN (229, 230) THEN 'The login may not use an object of the job. ' || {detail}
      WHEN {code} = 18456 THEN 'The database refused the login.'
      WHEN {code} IN (-2, 258) THEN 'The job ran out of time; use a narrower range or try later.'
      WHEN {code} = 1205 THEN 'The job lost a deadlock; run it again.'
      WHEN {code} = 515 THEN 'A required column is NULL. ' || {detail}
      WHEN {code} = 547 THEN 'A constraint was violated. ' || {detail}
      ELSE 'Database error (' || {code} || '): ' || {detail} END"""


OUTCOMES = f"""facts AS (
  SELECT *, error_code IS NOT NULL AS failed, error_code IS NULL AND total_rows = 0 AS is_empty FROM runs),
judged AS (
  SELECT *, NOT failed AND NOT is_empty AS ran,
         NOT failed AND NOT is_empty AND threshold > 0 AND violations > 0 AS violated FROM facts),
outcomes AS (
  SELECT *,
    CASE WHEN failed THEN {error_message('error_code', 'error_detail')}
         WHEN violated AND policy = 'cancel' THEN 'Operation cancelled by user due to threshold violations.'
         WHEN violated AND policy = 'valid_only' AND violations = splits
           THEN 'All split tables exceed the threshold — no tables to process.' END AS error_message,
    CASE WHEN failed THEN 'failed' WHEN is_empty THEN 'empty'
         WHEN violated AND policy = 'cancel' THEN 'cancelled'
         WHEN violated AND policy = 'valid_only' AND violations = splits THEN 'nothing_valid'
         WHEN violated AND policy = 'valid_only' THEN 'partly_delivered' ELSE 'delivered' END AS outcome,
    concat_ws('; ',
      CASE WHEN is_empty THEN 'Staging table returned 0 rows.' END,
      CASE WHEN ran AND splits = 1 AND threshold > 0 AND total_rows > threshold
        THEN format('Staging table [{{}}] has {{:,}} rows (threshold: {{:,}}).', staging_table, total_rows, threshold) END,
      CASE WHEN violated AND policy = 'valid_only' AND violations < splits
        THEN format('Skipped {{}} table(s) exceeding threshold', violations) END,
      CASE WHEN violated AND policy = 'all' THEN 'All tables were delivered, also those above the threshold, as the policy asks.' END,
      CASE WHEN ran AND rejects > 0 THEN format('{{}} row(s) rejected', rejects) END) AS warnings
  FROM judged),
final AS (
  SELECT *, error_message IS NULL AS success,
    CASE WHEN outcome IN ('failed', 'empty', 'cancelled', 'nothing_valid') THEN 0
         WHEN outcome = 'partly_delivered' THEN splits - violations ELSE splits END::INT AS planned_files,
    failed::INT AS error_files
  FROM outcomes)"""

FILES = """files AS (
  SELECT r.process_id, substr(o_orderpriority, 1, 1)::INT AS file_index,
         r.job || '_' || substr(o_orderpriority, 1, 1) || '_' || strftime(r.start_time, '%d%m%Y') || '.parquet' AS file_name,
         r.job || '_' || substr(o_orderpriority, 1, 1) AS table_name,
         p.rows, p.rows * 64 AS table_size_bytes, p.rows * 24 AS file_size_bytes
  FROM per_split p JOIN runs r ON r.m = p.m WHERE r.total_rows > 0 AND r.error_code IS NULL),
totals AS (
  SELECT process_id, count(*) AS files, sum(rows)::BIGINT AS rows_written,
         sum(table_size_bytes)::BIGINT AS table_bytes, sum(file_size_bytes)::BIGINT AS file_bytes,
         string_agg(file_name, '; ' ORDER BY file_index) AS file_names
  FROM files GROUP BY process_id)"""


def bytes_text(size: str) -> str:
    power = f"floor(ln(abs({size})::DOUBLE) / ln(1024::DOUBLE))"
    scaled = f"sign({size}) * round_even(abs({size})::DOUBLE / pow(1024, {power}) * 100, 0)::DOUBLE / 100"
    return f"""CASE WHEN {size} = 0 THEN '0 B' ELSE
      regexp_replace(({scaled})::DOUBLE::VARCHAR, '\\.0$', '') || ' '
      || ['B', 'KB', 'MB', 'GB', 'TB', 'PB', 'EB'][({power})::INT + 1] END"""


def duration_text(seconds: str) -> str:
    return f"""CASE WHEN {seconds} >= 60
      THEN printf('%dm %02ds', (floor({seconds})::BIGINT // 60)::BIGINT, (floor({seconds})::BIGINT % 60)::BIGINT)
      ELSE printf('%.1fs', round({seconds}::DECIMAL(18, 6), 1)::DOUBLE) END"""


# ---- sources ------------------------------------------------------------------------------------

ORACLES["manifest_scan"] = f"WITH {MANIFEST} SELECT * FROM manifest"

ORACLES["manifest_checks"] = f"""WITH {MANIFEST} SELECT name, concat_ws(',',
  CASE WHEN data_type NOT IN ('Import', 'Export') THEN 'data_type_invalid' END,
  CASE WHEN staging_table IS NULL THEN 'staging_table_missing' END,
  CASE WHEN staging_table = 'TODO_FILL_THIS_IN' THEN 'staging_table_placeholder' END,
  CASE WHEN trim(file_prefix) = '' THEN 'file_prefix_missing' END) AS failed_rules FROM manifest"""

ORACLES["staging_scan"] = "SELECT * FROM orders"

ORACLES["staging_count"] = "SELECT count(*) AS row_count FROM lineitem"

ORACLES["catalog_snapshot"] = f"""WITH {CATALOG}
SELECT key, name, array_to_string(params, ',') AS params, has_source, db_threshold, source FROM snapshot"""

ORACLES["family_discovery"] = f"""WITH {FAMILY}
SELECT b.base, coalesce(t.n, 1) AS split_id,
       CASE WHEN t.n IS NULL THEN b.base ELSE b.base || '_' || t.n END AS table_name,
       coalesce(c.numbered, 0) - coalesce(r.run, 0) AS ignored_tables
FROM bases b LEFT JOIN taken t USING (base) LEFT JOIN runs r USING (base) LEFT JOIN totals c USING (base)"""

ORACLES["family_ignored"] = f"""WITH {FAMILY}
SELECT base, name, n FROM ranked WHERE NOT (n = r AND n <= 9)"""

ORACLES["master_list"] = f"WITH {MASTER} SELECT key, name FROM master"

ORACLES["name_in_list"] = """SELECT p_name AS name, p_partkey, p_brand FROM part
WHERE lower(p_name) IN (SELECT lower(p_name) FROM part WHERE p_size > 45)"""

ORACLES["logical_size"] = """SELECT count(*) AS row_count,
  sum(8 + 8 + strlen(o_orderstatus) + 8 + 8 + strlen(o_orderpriority))::BIGINT AS size_bytes FROM orders"""

# ---- extract ------------------------------------------------------------------------------------

ORACLES["extract_range"] = """SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-15' AND o_orderdate < TIMESTAMP '1997-02-11'"""

ORACLES["extract_month"] = """SELECT * FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-06-01' AND l_shipdate < TIMESTAMP '1996-07-01'"""

ORACLES["request_validation"] = f"""WITH {REQUESTS}
SELECT request_id, mon, mon1,
  CASE WHEN has_mon1 AND length(mon::VARCHAR) <> 8 THEN 'mon_not_8_digits'
       WHEN NOT has_mon1 AND length(mon::VARCHAR) <> 6 THEN 'mon_not_6_digits'
       WHEN has_mon1 AND coalesce(length(mon1::VARCHAR), 0) <> 8 THEN 'mon1_not_8_digits'
       WHEN has_mon1 AND mon1 < mon THEN 'mon1_before_mon' ELSE 'ok' END AS status,
  CASE WHEN has_mon1 THEN coalesce(length(mon::VARCHAR) = 8 AND length(mon1::VARCHAR) = 8
         AND try_strptime(mon::VARCHAR, '%Y%m%d') IS NOT NULL
         AND try_strptime(mon1::VARCHAR, '%Y%m%d') IS NOT NULL, false)
       ELSE try_strptime(mon::VARCHAR || '01', '%Y%m%d') IS NOT NULL END AS is_calendar_date,
  coalesce(nullif(prefix, ''), default_prefix) AS output_prefix
FROM requests"""

# ---- split --------------------------------------------------------------------------------------

INDEXED = "indexed AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_index FROM orders)"
SPLIT = f"((row_index - 1) // {ROW_CAP} + 1)::INT"
SPLIT_ROW = f"((row_index - 1) % {ROW_CAP} + 1)"

ORACLES["capped_split"] = f"WITH {INDEXED} SELECT *, {SPLIT} AS split_id, {SPLIT_ROW} AS split_row FROM indexed"

ORACLES["capped_split_counts"] = f"""WITH {INDEXED}
SELECT {SPLIT} AS split_id, count(*) AS row_count FROM indexed GROUP BY 1"""

# The files hold orders by o_orderkey and documents by doc_id.
ORACLES["capped_split_stored"] = f"""WITH indexed AS (
  SELECT *, row_number() OVER (ORDER BY o_orderkey) AS row_index FROM orders)
SELECT *, {SPLIT} AS split_id, {SPLIT_ROW} AS split_row FROM indexed"""

ORACLES["capped_split_plan"] = ORACLES["capped_split_counts"]

ORACLES["capped_split_copies"] = f"""WITH indexed AS (
  SELECT l_shipdate, row_number() OVER (ORDER BY l_shipdate) AS row_index FROM lineitem)
SELECT {SPLIT} AS split_id, count(*) AS row_count, min(l_shipdate) AS first_date, max(l_shipdate) AS last_date
FROM indexed GROUP BY 1"""

SIZED = """sized AS (
  SELECT doc_id, n_chars, 8 + coalesce(strlen(text), 0) + coalesce(strlen(lang), 0) + coalesce(strlen(source), 0)
         + CASE WHEN n_chars IS NULL THEN 0 ELSE 8 END AS row_bytes FROM documents),
running AS (
  SELECT *, row_number() OVER (ORDER BY doc_id) AS row_index,
         sum(row_bytes) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - row_bytes AS before FROM sized)"""

ORACLES["byte_capped_split"] = f"""WITH {SIZED}
SELECT doc_id, n_chars, row_bytes::BIGINT AS row_bytes, row_index, (before // {BYTE_CAP} + 1)::INT AS split_id FROM running"""

ORACLES["byte_capped_split_stored"] = ORACLES["byte_capped_split"]

ORACLES["byte_capped_split_hard"] = f"""WITH {SIZED}
SELECT (before // {BYTE_CAP} + 1)::INT AS split_id, count(*) AS row_count, sum(row_bytes)::BIGINT AS split_bytes
FROM running GROUP BY 1"""

BY_KEY = """by_key AS (
  SELECT *, dense_rank() OVER (ORDER BY o_orderpriority)::INT AS split_id,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS split_row FROM orders),
status AS (
  SELECT split_id, 'ORDERS_' || split_id AS table_name, count(*) AS row_count,
         (SELECT count(*) // 5 FROM orders) AS threshold, count(*) > (SELECT count(*) // 5 FROM orders) AS exceeds
  FROM by_key GROUP BY split_id)"""

ORACLES["presplit_by_key"] = f"WITH {BY_KEY} SELECT o_orderkey, o_orderpriority, split_id, split_row FROM by_key"

# Each sibling holds its orders in the order of the file, which is that of o_orderkey.
ORACLES["presplit_family"] = ORACLES["presplit_by_key"]

ORACLES["split_counts"] = f"""WITH {BY_KEY}
SELECT split_id, o_orderpriority, count(*) AS row_count FROM by_key GROUP BY ALL"""

ORACLES["capped_read"] = """WITH indexed AS (
  SELECT *, row_number() OVER (ORDER BY ts, event_id) AS row_index FROM events)
SELECT * FROM indexed WHERE row_index <= (SELECT count(*) * 2 // 5 FROM events)"""

# ---- profile, coercion, quarantine --------------------------------------------------------------

_SCHEMAS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "bigint")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
}
_TARGETS = {"int": "LONG", "bigint": "LONG", "double": "DOUBLE", "timestamp_ntz": "DATETIME"}
_STORED = {"LONG": "int", "DOUBLE": "double", "DATETIME": "timestamp_ntz"}


def _text_target(column: str) -> str:
    return f"CASE WHEN coalesce(max(length({column})), 0) BETWEEN 1 AND 255 THEN 'TEXT(255)' ELSE 'MEMO' END"


def _profile_rows(name: str) -> list[str]:
    rows = []
    for i, (column, kind) in enumerate(_SCHEMAS[name], 1):
        head = f"SELECT {i} AS position, '{column}' AS name, '{kind}' AS source_type"
        if kind == "string":
            rows.append(f"""{head}, coalesce(max(length({column})), 0)::INT AS max_len,
                {_text_target(column)} AS target_type, 'string' AS stored_as, '{name}' AS table_name FROM {name}""")
        else:
            target = _TARGETS[kind]
            rows.append(f"""{head}, NULL::INT AS max_len, '{target}' AS target_type,
                '{_STORED[target]}' AS stored_as, '{name}' AS table_name""")
    return rows


ORACLES["profile_map"] = " UNION ALL ".join(_profile_rows("documents") + _profile_rows("events"))

ORACLES["target_ddl"] = " UNION ALL ".join(
    f"""SELECT '[out]]{name}]' AS table_name, position, '[' || name || '] ' || target_type AS column_ddl
        FROM ({" UNION ALL ".join(_profile_rows(name))})"""
    for name in _SCHEMAS
)

_NUMBER = r"\s*[-+]?(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?\s*"
_DOUBLE = rf"""CASE
  WHEN regexp_full_match(raw, '{_NUMBER}') THEN TRY_CAST(replace(trim(raw), ',', '') AS DOUBLE)
  WHEN regexp_full_match(raw, '\s*\({_NUMBER}\)\s*') THEN -TRY_CAST(replace(trim(raw, '() '), ',', '') AS DOUBLE)
  WHEN regexp_full_match(raw, '{_NUMBER}-\s*') THEN -TRY_CAST(replace(trim(raw, '- '), ',', '') AS DOUBLE) END"""

ORACLES["coerce_double"] = f"WITH {RAW} SELECT id, raw, {_DOUBLE} AS value FROM raw_values"
ORACLES["coerce_decimal"] = f"WITH {RAW} SELECT id, raw, {_DOUBLE} + 0.0 AS value FROM raw_values"
ORACLES["coerce_integer"] = rf"""WITH {RAW} SELECT id, raw,
  CASE WHEN regexp_full_match(raw, '\s*[-+]?[0-9]+\s*') THEN TRY_CAST(trim(raw) AS BIGINT) END AS value FROM raw_values"""
ORACLES["coerce_timestamp"] = rf"""WITH {RAW} SELECT id, raw,
  CASE WHEN regexp_full_match(raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST(raw AS TIMESTAMP) END AS value
FROM raw_values"""
ORACLES["coerce_boolean"] = f"""WITH {RAW} SELECT id, raw,
  CASE lower(trim(raw)) WHEN 'true' THEN true WHEN 'false' THEN false END AS value FROM raw_values"""

ORACLES["coerce_text"] = """SELECT vec_id,
  to_json(list_transform(embedding, lambda x: floor(x::DOUBLE * 1000)::BIGINT))::VARCHAR AS scaled_text,
  label::VARCHAR AS label_text, (label > 4)::VARCHAR AS high_text FROM embeddings"""

ORACLES["pad_missing_columns"] = """
SELECT 'orders' AS source, o_orderkey, NULL::BIGINT AS event_id, o_totalprice, NULL::DOUBLE AS value, NULL::TIMESTAMP AS ts
FROM orders
UNION ALL SELECT 'events', NULL, event_id, NULL, value, ts FROM events"""

QUARANTINE = f"""indexed AS (
  SELECT *, o_orderkey * 10000000 AS big_key, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_index
  FROM orders),
placed AS (SELECT *, {SPLIT} AS split_id, {SPLIT_ROW} AS split_row FROM indexed)"""

ORACLES["quarantine_good"] = f"""WITH {QUARANTINE}
SELECT o_orderkey::INT AS o_orderkey, big_key::INT AS big_key, o_totalprice, o_orderdate, o_orderpriority, split_id, split_row
FROM placed WHERE big_key BETWEEN -2147483648 AND 2147483647 AND o_orderkey BETWEEN -2147483648 AND 2147483647"""

ORACLES["quarantine_rejects"] = f"""WITH {QUARANTINE},
judged AS (SELECT *, concat_ws(',',
    CASE WHEN o_orderkey NOT BETWEEN -2147483648 AND 2147483647 THEN 'int32_overflow:o_orderkey' END,
    CASE WHEN big_key NOT BETWEEN -2147483648 AND 2147483647 THEN 'int32_overflow:big_key' END) AS reject_reasons
  FROM placed)
SELECT split_id, split_row, reject_reasons, o_orderkey, big_key FROM judged WHERE reject_reasons <> ''"""

# ---- validation and delivery --------------------------------------------------------------------

ORACLES["threshold_status"] = f"WITH {BY_KEY} SELECT * FROM status"

ORACLES["threshold_summary"] = f"""WITH {BY_KEY}
SELECT count(*) AS splits, sum(row_count)::BIGINT AS total_rows, sum(exceeds::INT)::BIGINT AS violations,
       bool_or(exceeds) AS has_violations FROM status"""

ORACLES["threshold_report"] = f"""WITH {BY_KEY}
SELECT split_id::VARCHAR AS "index", table_name, format('{{:,}}', row_count) AS row_count,
       CASE WHEN exceeds THEN 'EXCEEDS' ELSE 'OK' END AS status FROM status
UNION ALL
SELECT '', 'Total', format('{{:,}}', sum(row_count)::BIGINT),
       format('{{}} of {{}} exceed', sum(exceeds::INT)::BIGINT, count(*)) FROM status"""

ORACLES["deliver_all"] = f"WITH {BY_KEY} SELECT o_orderkey, split_id, split_row FROM by_key"
ORACLES["deliver_valid_only"] = f"""WITH {BY_KEY}
SELECT o_orderkey, split_id, split_row FROM by_key WHERE split_id IN (SELECT split_id FROM status WHERE NOT exceeds)"""
ORACLES["deliver_cancel"] = f"""WITH {BY_KEY}
SELECT o_orderkey, split_id, split_row FROM by_key WHERE NOT (SELECT bool_or(exceeds) FROM status)"""

ORACLES["delivery_plan"] = f"""WITH {BY_KEY},
kept AS (SELECT *, row_number() OVER (ORDER BY split_id)::INT AS file_index, count(*) OVER () AS n
         FROM status WHERE NOT exceeds)
SELECT split_id, table_name, row_count, file_index,
  CASE WHEN n = 1 THEN 'Orders_05032024.parquet' ELSE 'Orders_' || file_index || '_05032024.parquet' END AS file_name,
  CASE WHEN n = 1 THEN 'Orders' ELSE 'Orders_' || file_index END AS inner_table FROM kept"""

ORACLES["split_sink_roundtrip"] = f"""WITH {INDEXED}
SELECT {SPLIT} AS split_id, count(*) AS row_count, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date,
       sum(o_orderkey)::BIGINT AS key_sum FROM indexed GROUP BY 1"""
ORACLES["split_sink_csv"] = f"WITH {INDEXED} SELECT o_orderkey, o_orderdate, o_orderpriority, {SPLIT} AS split_id FROM indexed"
ORACLES["split_sink_json"] = f"WITH {INDEXED} SELECT o_orderkey, o_custkey, o_orderstatus, {SPLIT} AS split_id FROM indexed"
ORACLES["split_sink_orc"] = f"WITH {INDEXED} SELECT o_orderkey, o_totalprice, o_orderdate, {SPLIT} AS split_id FROM indexed"

# ---- runs, audit, reports -----------------------------------------------------------------------

ORACLES["run_totals"] = f"WITH {RUNS}, {FILES} SELECT * FROM totals"

ORACLES["delivered_files"] = f"""WITH {RUNS}, {FILES}
SELECT process_id, file_index, file_name, table_name, format('{{:,}}', rows) AS rows,
       {bytes_text('table_size_bytes')} AS table_size, {bytes_text('file_size_bytes')} AS file_size FROM files"""

ORACLES["run_outcome"] = f"""WITH {RUNS}, {OUTCOMES}
SELECT process_id, success, outcome, error_message, warnings, planned_files, error_files FROM final"""

ORACLES["run_summary"] = f"""WITH {RUNS}, {OUTCOMES}, {FILES}
SELECT process_id, job, parameters, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
  {duration_text('duration_s')} AS total_duration,
  CASE WHEN sp_s > 0 THEN {duration_text('sp_s')} ELSE '—' END AS extract_time,
  CASE WHEN write_s > 0 THEN {duration_text('write_s')} ELSE '—' END AS write_time,
  CASE WHEN sp_s > 0 AND write_s > 0 THEN {duration_text('(duration_s - sp_s - write_s)')} ELSE '—' END AS overhead,
  format('{{:,}}', total_rows) AS rows_read, format('{{:,}}', coalesce(rows_written, 0)) AS rows_written,
  CASE WHEN write_s > 0 THEN coalesce(rows_written, 0) / write_s ELSE 0 END AS rows_per_second,
  {bytes_text('coalesce(table_bytes, 0)')} AS total_table_size, {bytes_text('coalesce(file_bytes, 0)')} AS total_file_size,
  planned_files, coalesce(files, 0) AS success_files, error_files,
  CASE WHEN success THEN 'SUCCESS' ELSE 'FAILED' END AS status, error_message, warnings
FROM final LEFT JOIN totals USING (process_id)"""

ORACLES["audit_rows"] = f"""WITH {RUNS}, {OUTCOMES}, {FILES}
SELECT job AS "StoreProcedureName", parameters AS "Parameter", process_id AS "ProcessId", start_time AS "Date",
  coalesce(file_names, '') AS "FileNames", coalesce(rows_written, 0) AS "RowsCount",
  CASE WHEN success THEN 'Success' ELSE error_message END AS "Message",
  'Duration: ' || {duration_text('duration_s')} || ' | Files: ' || planned_files
  || ' | Total Table Size: ' || {bytes_text('coalesce(table_bytes, 0)')}
  || ' | Total File Size: ' || {bytes_text('coalesce(file_bytes, 0)')} || ' | OutputDir: /out' AS "Comment"
FROM final LEFT JOIN totals USING (process_id)"""

# ---- scalar functions ---------------------------------------------------------------------------

ORACLES["fmt_bytes"] = f"""WITH sizes AS (
  SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 0
    ELSE n_chars * (1::BIGINT << (10 * (doc_id % 5))::INT) * CASE WHEN doc_id % 10 = 3 THEN -1 ELSE 1 END END AS size
  FROM documents)
SELECT doc_id, size, {bytes_text('size')} AS size_text FROM sizes"""

ORACLES["fmt_duration"] = f"SELECT event_id, value, {duration_text('value')} AS duration FROM events"

ORACLES["rule_extract"] = f"""WITH {CATALOG}
SELECT name, TRY_CAST(nullif(regexp_extract(source, '(?i)if\\s+@cnt\\s*>\\s*(\\d+)', 1), '') AS BIGINT) AS threshold
FROM source"""


def _inferred(name: str) -> str:
    return f"""CASE WHEN upper({name}) LIKE '%\\_EXP\\_%' ESCAPE '\\' THEN 'Export'
         WHEN upper({name}) LIKE '%\\_IMP\\_%' ESCAPE '\\' THEN 'Import' ELSE 'Unknown' END AS data_type,
    replace({name}, '_', ' ') AS display_name,
    CASE WHEN upper({name}) LIKE '%\\_EXP\\_%' ESCAPE '\\' THEN regexp_replace({name}, '(?i).*_EXP_', 'Export_')
         WHEN upper({name}) LIKE '%\\_IMP\\_%' ESCAPE '\\' THEN regexp_replace({name}, '(?i).*_IMP_', 'Import_')
         ELSE {name} END AS file_prefix"""


ORACLES["infer_metadata"] = f"""WITH {CATALOG},
names AS (SELECT name FROM routines UNION ALL SELECT p_type || '_' || p_partkey FROM part)
SELECT name, {_inferred('name')} FROM names"""

ORACLES["error_classify"] = f"""WITH {ATTEMPTS}
SELECT event_id, code, attempt,
  CASE WHEN code = 208 THEN 'missing_object' WHEN code IN (229, 230) THEN 'permission_denied'
       WHEN code = 18456 THEN 'login_failed' WHEN code IN (-2, 258) THEN 'timeout' WHEN code = 1205 THEN 'deadlock'
       WHEN code = 515 THEN 'null_not_allowed' WHEN code = 547 THEN 'constraint_violation' ELSE 'other' END AS error_class,
  {error_message('code', 'detail')} AS message,
  code IN (-2, 258, 1205, 4060, 40197, 40501, 40613) AS transient
FROM attempts"""

ORACLES["error_collapse"] = """SELECT event_id,
  CASE WHEN event_id % 13 = 0 THEN 'An unknown error occurred.'
       ELSE 'outer ' || event_type || ' — inner ' || event_id % 7
            || CASE WHEN event_id % 9 = 0 THEN '' ELSE ' — disk full' END END AS message FROM events"""

# ---- reconcile ----------------------------------------------------------------------------------

COMPARED = f"""{REGISTRY}, {CATALOG},
pairs AS (
  SELECT r.*, s.name IS NOT NULL AS in_database, coalesce(s.has_source, false) AS has_source, s.db_threshold,
    s.params AS db_params,
    list_filter(['mon', 'mon1'], lambda p: NOT list_contains(list_transform(s.params, lambda x: lower(x)), p)) AS missing_params,
    list_filter(list_transform(s.params, lambda x: lower(x)), lambda p: NOT list_contains(['mon', 'mon1'], p)) AS extra_params
  FROM registry r LEFT JOIN snapshot s ON s.key = lower(r.name)),
flags AS (
  SELECT *, in_database AND len(missing_params) = 0 AND len(extra_params) = 0 AS params_match,
    in_database AND has_source
      AND coalesce(nullif(threshold, 0), -1) = coalesce(db_threshold, -1) AS threshold_match
  FROM pairs),
compared AS (
  SELECT *, CASE WHEN NOT in_database THEN 'MISSING'
                 WHEN NOT params_match OR (has_source AND NOT threshold_match) THEN 'MISMATCH' ELSE 'VALID' END AS status
  FROM flags)"""

ORACLES["reconcile_status"] = f"""WITH {COMPARED}
SELECT name, status, in_database, params_match, threshold_match, threshold, db_threshold FROM compared"""

ORACLES["reconcile_param_diff"] = f"""WITH {COMPARED}
SELECT name, 'registry_only' AS side, unnest(missing_params) AS param FROM compared WHERE in_database
UNION ALL SELECT name, 'catalog_only', unnest(extra_params) FROM compared WHERE in_database"""

ORACLES["reconcile_summary"] = f"""WITH {COMPARED}
SELECT count(*) AS total, count(*) FILTER (status = 'VALID') AS valid, count(*) FILTER (status = 'MISSING') AS missing,
       count(*) FILTER (status = 'MISMATCH') AS mismatch, bool_or(status <> 'VALID') AS failed FROM compared"""

ORACLES["reconcile_autofix"] = f"""WITH {COMPARED}
SELECT name,
  array_to_string(CASE WHEN status = 'MISMATCH' AND NOT params_match THEN db_params ELSE parameters END, ',') AS parameters,
  CASE WHEN status = 'MISMATCH' AND has_source AND NOT threshold_match
       THEN coalesce(db_threshold, CASE WHEN threshold IS NOT NULL THEN 0 END) ELSE threshold END AS threshold,
  status = 'MISMATCH' AS fixed
FROM compared"""

ORACLES["reconcile_report"] = f"""WITH {COMPARED}
SELECT status, name, display_name, CASE WHEN in_database THEN 'Yes' ELSE 'No' END AS "exists",
  CASE WHEN in_database THEN 'mon, mon1' END AS json_params,
  CASE WHEN in_database THEN lower(array_to_string(db_params, ', ')) END AS db_params,
  CASE WHEN in_database THEN CASE WHEN params_match THEN 'Yes' ELSE 'No' END END AS params_match,
  CASE WHEN in_database AND threshold > 0 THEN format('{{:,}}', threshold) END AS json_threshold,
  CASE WHEN in_database AND db_threshold IS NOT NULL THEN format('{{:,}}', db_threshold) END AS db_threshold,
  CASE WHEN in_database THEN CASE WHEN threshold_match THEN 'Yes' ELSE 'No' END END AS threshold_ok,
  concat_ws(chr(10),
    CASE WHEN NOT in_database THEN 'Stored procedure does not exist in database.' END,
    CASE WHEN len(missing_params) > 0
      THEN 'Parameters in JSON but NOT in DB: @' || array_to_string(missing_params, ', @') END,
    CASE WHEN len(extra_params) > 0
      THEN 'Parameters in DB but NOT in JSON: @' || array_to_string(extra_params, ', @') END,
    CASE WHEN has_source AND threshold > 0 AND db_threshold IS NULL
      THEN 'Threshold defined in JSON (' || threshold || ') but no threshold logic found in SP source.' END,
    CASE WHEN has_source AND threshold > 0 AND db_threshold <> threshold
      THEN format('Threshold MISMATCH: JSON={{:,}}  DB={{:,}}', threshold, db_threshold) END,
    CASE WHEN has_source AND threshold IS NULL AND db_threshold IS NOT NULL
      THEN format('Threshold found in SP source ({{:,}}) but not defined in JSON.', db_threshold) END) AS details
FROM compared"""

ORACLES["reconcile_report_text"] = f"""WITH report AS ({ORACLES["reconcile_report"]})
SELECT name, concat_ws(chr(10),
  rpad('[' || status || ']', 11, ' ') || name,
  '  Display Name  : ' || display_name, '  SP Exists     : ' || "exists", '  JSON Params   : ' || json_params,
  '  DB Params     : ' || db_params, '  Params Match  : ' || params_match, '  JSON Threshold: ' || json_threshold,
  '  DB Threshold  : ' || db_threshold, '  Threshold OK  : ' || threshold_ok,
  CASE WHEN details <> '' THEN '  ! ' || replace(details, chr(10), chr(10) || '  ! ') END) AS text FROM report"""

SYNCED = f"""{REGISTRY}, {CATALOG}, {MASTER},
matched AS (
  SELECT m.name AS listed_name, s.name AS db_name, s.params, s.db_threshold, r.name AS old_name, r.display_name,
         r.data_type, r.staging_table, r.parameters, r.file_prefix, r.threshold,
         list_transform(s.params, lambda x: lower(x)) <> r.parameters AS params_differ,
         coalesce(r.threshold, 0) <> coalesce(s.db_threshold, 0) AS threshold_differs
  FROM master m LEFT JOIN snapshot s ON s.key = m.key LEFT JOIN registry r ON lower(r.name) = m.key),
processed AS (
  SELECT coalesce(old_name, listed_name) AS name, 'MISSING_IN_DB' AS status, display_name, data_type, staging_table,
         parameters, file_prefix, threshold FROM matched WHERE db_name IS NULL
  UNION ALL
  SELECT db_name, 'ADDED', replace(db_name, '_', ' '), 'Export', 'TODO_FILL_THIS_IN', params,
         regexp_replace(db_name, '(?i).*_EXP_', 'Export_'), db_threshold
  FROM matched WHERE db_name IS NOT NULL AND old_name IS NULL
  UNION ALL
  SELECT old_name, CASE WHEN params_differ OR threshold_differs THEN 'UPDATED' ELSE 'UNMODIFIED' END,
         display_name, data_type, staging_table, CASE WHEN params_differ THEN params ELSE parameters END, file_prefix,
         CASE WHEN threshold_differs THEN coalesce(db_threshold, 0) ELSE threshold END
  FROM matched WHERE db_name IS NOT NULL AND old_name IS NOT NULL
  UNION ALL
  SELECT name, 'RETAINED', display_name, data_type, staging_table, parameters, file_prefix, threshold
  FROM registry WHERE lower(name) NOT IN (SELECT key FROM master))"""

_SYNC_COLUMNS = "name, display_name, data_type, staging_table, array_to_string(parameters, ',') AS parameters, file_prefix, threshold"

ORACLES["reconcile_run"] = f"""WITH {COMPARED},
counts AS (SELECT count(*) FILTER (status = 'VALID') AS valid, count(*) FILTER (status = 'MISSING') AS missing,
                  count(*) FILTER (status = 'MISMATCH') AS mismatch FROM compared),
unread AS (SELECT count(*) AS n FROM compared WHERE status = 'MISMATCH' AND NOT has_source AND params_match) -- none can be left
SELECT 1 AS run, 1 AS read, CASE WHEN mismatch > 0 THEN 2 ELSE 1 END AS version, (missing + mismatch > 0)::INT AS exit_code,
       valid, missing, mismatch FROM counts
UNION ALL
SELECT 2, CASE WHEN mismatch > 0 THEN 2 ELSE 1 END, CASE WHEN mismatch > 0 THEN 2 ELSE 1 END, (missing + n > 0)::INT,
       valid + mismatch - n, missing, n FROM counts, unread"""

ORACLES["reconcile_report_written"] = f"""WITH report AS ({ORACLES["reconcile_report"]}) SELECT status, name, details FROM report"""

ORACLES["reconcile_delta"] = f"""WITH {COMPARED}, numbered AS (SELECT *, split_part(name, '_', -1)::INT AS k FROM compared)
SELECT name, status, in_database, params_match, threshold_match, threshold, db_threshold,
       k % 40 = 1 OR (k % 10 = 0 AND coalesce(threshold, 0) <> 1) OR (k % 25 = 2 AND k % 17 <> 0) AS compared_again FROM numbered"""

ORACLES["registry_sync"] = f"WITH {SYNCED} SELECT status, {_SYNC_COLUMNS} FROM processed"

ORACLES["registry_sync_summary"] = f"""WITH {SYNCED}
SELECT count(*) FILTER (status <> 'RETAINED') AS listed, count(*) FILTER (status = 'ADDED') AS added,
  count(*) FILTER (status = 'RETAINED') AS retained, count(*) FILTER (status = 'UPDATED') AS updated,
  count(*) FILTER (status = 'UNMODIFIED') AS unmodified, count(*) FILTER (status = 'MISSING_IN_DB') AS missing_in_db,
  bool_or(status IN ('ADDED', 'UPDATED')) AS changed FROM processed"""

ORACLES["manifest_write_back"] = f"""WITH {SYNCED} SELECT {_SYNC_COLUMNS} FROM processed
WHERE status <> 'MISSING_IN_DB' OR lower(name) IN (SELECT lower(name) FROM registry)"""

ORACLES["sync_run"] = f"""{ORACLES["manifest_write_back"].replace("SELECT name, display_name", "SELECT 2 AS version, 2 AS version_after, name, display_name")}"""

# ---- whole runs ---------------------------------------------------------------------------------

DELIVERED = f"""ordered AS (
  SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_index FROM orders
  WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'),
placed AS (SELECT *, {SPLIT} AS file_index FROM ordered)"""

ORACLES["delivery_run_rows"] = f"""WITH {DELIVERED} -- the target profile has 32-bit integers
SELECT o_orderkey::INTEGER AS o_orderkey, o_custkey::INTEGER AS o_custkey, file_index FROM placed"""

ORACLES["delivery_run_files"] = f"WITH {DELIVERED} SELECT file_index, count(*) AS rows FROM placed GROUP BY file_index"

ORACLES["delivery_run_audit"] = f"""WITH {DELIVERED}
SELECT count(*) AS total_rows, max(file_index) AS splits, 0 AS violations, 0::BIGINT AS rejects, 1 AS audit_rows FROM placed"""

ORACLES["delivery_ordered_read"] = f"""WITH {DELIVERED}
SELECT file_index, {SPLIT_ROW} AS row_number, o_orderkey::INTEGER AS o_orderkey, o_custkey::INTEGER AS o_custkey FROM placed"""

ORACLES["delivery_run_rejects"] = f"""WITH {QUARANTINE},
judged AS (SELECT split_id AS file_index, big_key BETWEEN -2147483648 AND 2147483647
    AND o_orderkey BETWEEN -2147483648 AND 2147483647 AS fits FROM placed)
SELECT file_index, count(*) FILTER (fits) AS rows, count(*) FILTER (NOT fits) AS rejects FROM judged GROUP BY 1"""

ORACLES["audit_rerun"] = f"""WITH {DELIVERED}
SELECT 'Orders_By_Day' AS "StoreProcedureName", '@mon=19960101, @mon1=19971231' AS "Parameter",
       TIMESTAMP '2024-03-05 09:30:00' AS "Date", count(*) AS "RowsCount", 'Success' AS "Message" FROM placed"""

ORACLES["delivery_family"] = """SELECT 'delivered_twelve_' || (o_orderkey % 12 + 1) AS table_name, count(*) AS rows
FROM orders GROUP BY 1"""

# ---- streaming ----------------------------------------------------------------------------------

ORACLES["stream_capped_split"] = f"""WITH numbered AS (SELECT row_number() OVER () AS row_index FROM orders)
SELECT {SPLIT} AS split_id, count(*) AS row_count FROM numbered GROUP BY 1"""
