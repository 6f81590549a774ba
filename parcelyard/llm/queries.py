"""Registered queries: each applies an operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.llm import (
    decontaminate, langid, line_dedup, near_dups, packing, secrets, suffix_dedup, token_planes, topk, toxicity, turns, warc,
    whitening,
)
from parcelyard.llm.common import table


def op1_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), 20, F.col("vec_id") % 20 == 0)


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.token_files(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_id", "row_hash")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.select("doc_id", toxicity.grade().alias("grade")))
    return toxicity.predict(docs, model)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), size=2).drop("row_id", "row_hash")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"), stored=True)


def op11_structural_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return turns.repair_report(rows, turns.damaged(rows))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_impact_topk": op1_impact_topk,
    "op2_warc_index": op2_warc_index,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_token_planes": op4_token_planes,
    "op5_language_id": op5_language_id,
    "op6_decontamination": op6_decontamination,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_toxicity": op8_toxicity,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_line_dedup": op10_line_dedup,
    "op11_structural_secrets": op11_structural_secrets,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
}
_VECTORS = """
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
"""

def _way(state: str, cost: str, edit: str, line: str | None = None, when: str = "true") -> str:
    """SQL: a state's cheapest repair so far, lengthened by an edit and perhaps a line; NULL where it can't be."""
    lines = f"concat_ws(chr(10), {state}.o, {line})" if line else f"{state}.o"
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'e': {state}.e || '{edit}', 'o': {lines}}} END"


def _kept(state: str, initial: str) -> str:
    return _way(state, "extra", "K", "role || ':' || text", f"stays AND left(role, 1) = '{initial}'")


def _given(state: str, role: str) -> str:
    return _way(state, "extra + 3", "R", f"'{role}:' || text", "stays")


def _added(state: str, role: str) -> str:
    return _way(state, "3", "I", f"'{role}:'")


# A forward search, row by row, for the least (cost, edits) in each state of (s?(ua)+)?: nothing, after s, u, a.
_REPAIR = f"""
    WITH RECURSIVE marked AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
    ), kinds AS (
        SELECT *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT),
            lambda crc, b: list_reduce(range(8), lambda c, n: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, b)),
            4294967295), 4294967295) % 20 AS kind FROM marked
    ), damaged AS (
        SELECT coalesce('=' || conv_id::VARCHAR, '') AS conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0
    ), ordered AS (
        SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n,
               rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid FROM damaged
    ), faults AS (
        SELECT conv, turn, role, text, n, CASE WHEN solid = '' THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY n) > 1 THEN 'duplicate'
                   WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY n) || left(role, 1) AS pair FROM ordered
    ), rows AS (
        SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM faults
    ), search AS (
        SELECT conv, 0::BIGINT AS n, {{'c': 0, 'e': '', 'o': NULL::VARCHAR}} AS q, NULL::STRUCT(c INTEGER, e VARCHAR, o VARCHAR) AS s,
               {{'c': 3, 'e': 'I', 'o': 'user:'}} AS u, {{'c': 6, 'e': 'II', 'o': 'user:' || chr(10) || 'assistant:'}} AS a
        FROM (SELECT DISTINCT conv FROM rows)
        UNION ALL
        SELECT conv, n, q, s, u, least(a, {_added("u", "assistant")}) AS a FROM (
            SELECT conv, n, q, s, least(u, {_added("q", "user")}, {_added("s", "user")}, {_added("a", "user")}) AS u, a FROM (
                SELECT conv, rows.n AS n, {_way("q", "4", "D")} AS q, least({_way("s", "4", "D")}, {_kept("q", "s")}) AS s,
                       least({_way("u", "4", "D")}, {", ".join(_kept(x, "u") + ", " + _given(x, "user") for x in "qsa")}) AS u,
                       least({_way("a", "4", "D")}, {_kept("u", "a")}, {_given("u", "assistant")}) AS a
                FROM search JOIN rows USING (conv) WHERE rows.n = search.n + 1
            )
        )
    ), counted AS (
        SELECT conv, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows GROUP BY conv
    ), best AS (SELECT conv, n, least(q, a) AS found FROM search)
    SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
           coalesce(found.c, 0)::BIGINT AS cost, coalesce(found.e, '') AS audit, sha256(coalesce(found.o, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id::VARCHAR, '') AS conv FROM conversations)
    LEFT JOIN counted USING (conv) LEFT JOIN best USING (conv, n)
"""

ORACLES: dict[str, str] = {
    "op12_conversation_repair": _REPAIR,
    "op1_impact_topk": f"""
        WITH vectors AS ({_VECTORS}), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op2_warc_index": """
        WITH p AS (
            SELECT page_id, sha1(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS size FROM pages
        ), m AS (SELECT digest, max(page_id) AS original FROM p WHERE size >= 1000 GROUP BY digest)
        SELECT page_id, size::BIGINT AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original <> page_id THEN original END AS refers_to
        FROM p LEFT JOIN m ON p.digest = m.digest AND size >= 1000
    """,
    "op6_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
        ), b AS (
            SELECT item_id, coalesce(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark
        ), windows AS (
            SELECT item_id, n, w[i:i + n - 1] AS g
            FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
                  FROM b WHERE len(w) > 0)
        ), grams AS (
            SELECT r, i, n, w[i:i + n - 1] AS g
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows))
        ), found AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, g)),
        hits AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found) GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
    """,
}
