"""The engine's input shapes, made from the driver's tables.

Each is one SQL text that Spark and other SQL engines read alike ({name} stands for a table or another input),
so a query and its oracle start from the same rows. lineitem has no unique key: it is summed to one row per
order and line first.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

INPUTS = {
    "lines": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
               min(l_partkey) AS part, min(l_suppkey) AS supp, CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS qty
        FROM {lineitem} GROUP BY l_orderkey, CAST(l_linenumber AS BIGINT)""",
    # Forty orders are a page, so pages grow with the data; an order is a band of its page, its lines are the band's tokens.
    "tokens": """
        SELECT page, band_id, token_id, text, x0, x0 + length(text) * 5E0 AS x1, y0, y0 + 8E0 AS y1 FROM (
          SELECT CAST(floor(l_orderkey / 40) AS BIGINT) AS page, l_orderkey % 40 AS band_id, l_orderkey * 8 + line AS token_id,
                 CASE line % 4 WHEN 0 THEN CAST(qty AS STRING) WHEN 1 THEN 'Item' || CAST(part % 1000 AS STRING)
                   WHEN 2 THEN CAST(1 + CAST(floor(cents / 100000) AS BIGINT) AS STRING) || ',' || lpad(CAST(CAST(floor(cents / 100) AS BIGINT) % 1000 AS STRING), 3, '0') ELSE 'Road' END AS text,
                 (part % 120) * 6E0 AS x0, (l_orderkey % 40) * 20E0 + (supp % 3) * 0.25E0 AS y0
          FROM {lines}) AS t""",
    # The same tokens, some of which are markers, codes and currency signs, and stand closer.
    "marked": """
        SELECT page, band_id, token_id, text, x0, x0 + length(text) * 5E0 AS x1, y0, y1 FROM (
          SELECT page, band_id, token_id, y0, y1, CAST(floor(x0 / 2) AS DOUBLE) AS x0,
                 CASE WHEN x0 < 72 AND token_id % 4 <> 2 THEN CAST(1 + token_id % 12 AS STRING) || CASE WHEN token_id % 3 = 0 THEN '.' WHEN token_id % 3 = 1 THEN ')' ELSE '' END
                   WHEN x0 < 96 THEN '.' WHEN x0 < 132 THEN '310101' || lpad(CAST(token_id % 100000 AS STRING), 9, '0')
                   WHEN x0 BETWEEN 300 AND 396 THEN 'P' WHEN x0 BETWEEN 402 AND 450 THEN 'php' || CAST(token_id % 10 AS STRING) WHEN x0 BETWEEN 456 AND 480 THEN CASE WHEN token_id % 2 = 0 THEN ',' ELSE '(' END ELSE text END AS text
          FROM {tokens}) AS t""",
    "phrases": """
        SELECT page, band_id, token_id AS phrase_id, text, x0, y0, x1, y1,
               CASE token_id % 4 WHEN 0 THEN 'money_candidate' WHEN 2 THEN 'money_candidate' WHEN 1 THEN 'mixed_candidate' ELSE 'text_candidate' END AS observation
        FROM {tokens}""",
    # Rows of tables of five hundred orders; ranks that rise and fall, so that stacks pop.
    "rows": """
        SELECT CAST(floor(l_orderkey / 500) AS BIGINT) AS table_id, l_orderkey * 8 + line AS doc_pos, 'r' || CAST(l_orderkey * 8 + line AS STRING) AS id,
               CAST(floor(l_orderkey / 50) AS BIGINT) AS page, part % 8 AS rank, supp % 11 = 0 AS marked, part % 97 = 0 AS expense,
               part % 8 = 0 AND supp % 5 = 0 AS top_section, supp % 7 = 0 AND part % 8 <> 0 AND part % 97 <> 0 AS attached, cents AS amount, part, supp, qty, line
        FROM {lines}""",
    "sums": "SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM {orders} GROUP BY o_custkey",
    "tree": """
        SELECT id, parent, kind, code, excluded, synthetic, page, amount, doc_pos, label FROM (
          SELECT 'root' AS id, CAST(NULL AS STRING) AS parent, 'table_root' AS kind, CAST(NULL AS STRING) AS code, FALSE AS excluded, FALSE AS synthetic, CAST(NULL AS BIGINT) AS page, CAST(NULL AS BIGINT) AS amount, CAST(0 AS BIGINT) AS doc_pos, 'all' AS label
          UNION ALL SELECT 'r' || CAST(r_regionkey AS STRING), 'root', 'region', NULL, FALSE, FALSE, CAST(1 AS BIGINT), NULL, 1000 + CAST(r_regionkey AS BIGINT), r_name FROM {region}
          UNION ALL SELECT 'n' || CAST(n_nationkey AS STRING), 'r' || CAST(n_regionkey AS STRING), 'office', NULL, FALSE, n_nationkey % 6 = 0, CAST(1 + n_nationkey AS BIGINT), CAST(n_nationkey AS BIGINT) * 100000, 2000 + CAST(n_nationkey AS BIGINT), n_name FROM {nation}
          UNION ALL SELECT 'c' || CAST(c_custkey AS STRING), 'n' || CAST(c_nationkey AS STRING), 'program', NULL, FALSE, FALSE, 1 + c_custkey % 200,
            CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE s.cents + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END END, 10000 + c_custkey, c_name
            FROM {customer} LEFT JOIN {sums} s ON s.o_custkey = c_custkey
          UNION ALL SELECT 'o' || CAST(o_orderkey AS STRING), 'c' || CAST(o_custkey AS STRING), CASE WHEN o_orderkey % 31 = 0 THEN 'subtotal' ELSE 'activity' END,
            CASE WHEN o_orderkey % 17 = 0 THEN '310101' || CAST(2 + o_orderkey % 2 AS STRING) || lpad(CAST(o_orderkey % 100000 AS STRING), 5, '0') || '000' END, o_orderkey % 29 = 0, FALSE, 1 + o_orderkey % 400,
            CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(round(o_totalprice * 100) AS BIGINT) END, 1000000 + o_orderkey, o_orderpriority FROM {orders}) AS t""",
    "coded": """
        SELECT p_partkey % 3 AS table_id, p_partkey AS doc_pos, 'p' || CAST(p_partkey AS STRING) AS id, CASE WHEN p_partkey % 4 = 0 THEN 'root' ELSE 'p' || CAST(p_partkey - p_partkey % 4 AS STRING) END AS parent,
               CASE WHEN p_partkey % 10 = 1 THEN NULL WHEN p_partkey % 10 = 0 THEN substr(c, 1, 6) || '000000000' ELSE c END AS code
        FROM (SELECT p_partkey, CAST(1 + p_partkey % 3 AS STRING) || lpad(CAST(p_partkey % 7 AS STRING), 2, '0') || lpad(CAST(p_size % 5 AS STRING), 2, '0') || CAST(p_partkey % 2 AS STRING)
                     || CAST(1 + p_size % 3 AS STRING) || lpad(CAST(p_partkey % 997 AS STRING), 5, '0') || '000' AS c FROM {part}) AS t""",
    "labels": """
        SELECT p_partkey AS id, p_partkey % 9 AS rank,
               CASE p_partkey % 6 WHEN 0 THEN '  ' || p_name || '  (s)  Road - K' || lpad(CAST(p_partkey % 10000 AS STRING), 4, '0') || ' + ' || CAST(100 + p_size AS STRING) || ' - K' || lpad(CAST(p_partkey % 10000 + 1 AS STRING), 4, '0') || ' + ' || CAST(200 + p_size AS STRING)
                 WHEN 1 THEN 'A.1 ' || p_name || ' (14.' || lpad(CAST(p_partkey % 1000000 AS STRING), 6, '0') || ', 120.' || lpad(CAST(p_partkey * 7 % 1000000 AS STRING), 6, '0') || ')'
                 WHEN 2 THEN 'Region IV-A ' || p_name WHEN 3 THEN 'Sub-Total, ' || p_name WHEN 4 THEN p_brand || ' District Engineering Office' ELSE 'b. ' || p_name || ' PROGRAM' END AS label
        FROM {part}""",
    "ticks": "SELECT event_id, user_id, CAST(round(value * 100) AS BIGINT) / 100E0 AS distance FROM {events}",
    "amounts": """
        SELECT page, 'r' || CAST(token_id AS STRING) AS id, 'Amount ' || CAST(1 + band_id % 6 AS STRING) AS role, token_id % 100000 AS value FROM {tokens} WHERE token_id % 4 = 2""",
    "all_pages": "SELECT DISTINCT page FROM {rows}",
    # Pages with gaps, for the questions about gaps.
    "row_pages": "SELECT page FROM {all_pages} WHERE page % 10 <> 7",
    "findings": """
        SELECT page, token_id AS seq, CASE token_id % 8 WHEN 1 THEN 'multiple_money_candidates_in_cell' WHEN 2 THEN 'no_main_text_anchor' WHEN 3 THEN 'main_text_candidate_outside_label_cell' ELSE 'other_code' END AS code,
               CASE WHEN token_id % 8 = 4 THEN 'info' END AS severity, CASE WHEN token_id % 8 = 1 THEN token_id END AS cell_id, CASE WHEN token_id % 8 < 3 THEN band_id END AS row_id,
               CASE WHEN token_id % 8 = 3 THEN token_id % 5 END AS column_id, CASE WHEN token_id % 8 = 5 THEN band_id END AS band_id
        FROM {tokens}""",
}


def _needs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input, or one of the driver's tables."""
    if name not in INPUTS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = INPUTS[name]
    return spark.sql(sql, **{n: read_input(spark, sf_dir, n) for n in _needs(sql) if n != name})


def with_inputs(sql: str) -> str:
    """An oracle's SQL with the inputs it names in braces as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in INPUTS and name not in order:
            for n in _needs(INPUTS[name]):
                add(n)
            order.append(name)

    for n in _needs(sql):
        add(n)
    plain = lambda s: re.sub(r"\{(\w+)\}", lambda m: f"in_{m[1]}" if m[1] in INPUTS else m[1], s)
    ctes = ", ".join(f"in_{n} AS ({plain(INPUTS[n])})" for n in order)
    body = plain(sql).strip()
    if not ctes:
        return body
    recursive = "RECURSIVE " if body.upper().startswith("WITH RECURSIVE") else ""
    if body.upper().startswith("WITH"):
        body = re.sub(r"(?i)^WITH (RECURSIVE )?", "", body)
        return f"WITH {recursive}{ctes}, {body}"
    return f"WITH {ctes} {body}"
