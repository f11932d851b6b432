"""SQL with the same rows as the registered queries, over the same inputs ({name}) but by other means."""

from __future__ import annotations

_WHY = "CASE WHEN c.kind IN ('subtotal', 'grand_total') THEN 1 WHEN c.excluded THEN 1 WHEN c.code IS NOT NULL AND substr(c.code, 7, 1) IN ('2', '3') THEN 1 ELSE 0 END"


def _medians(value: str, order: str, tolerance: float, where: str) -> str:
    """Row by row of a page: the members of all clusters so far, and the cluster that the row joins."""
    near = f"list_min(list_filter(list_transform(s.members, lambda m, i: {{{{'d': abs(r.v - list_aggregate(m, 'median')), 'i': i}}}}), lambda e: e.d <= {tolerance}))"
    return f"""WITH RECURSIVE r AS (SELECT page, phrase_id AS id, {value} AS v, row_number() OVER (PARTITION BY page ORDER BY {order}, phrase_id) AS n FROM {{phrases}} WHERE {where}),
       s AS (SELECT page, id, n, [[v]] AS members, CAST(1 AS BIGINT) AS k FROM r WHERE n = 1
         UNION ALL SELECT page, id, n, CASE WHEN near IS NULL THEN list_append(members, [v]) ELSE list_transform(members, lambda m, i: CASE WHEN i = near.i THEN list_append(m, v) ELSE m END) END, CAST(coalesce(near.i, len(members) + 1) AS BIGINT)
         FROM (SELECT r.page, r.id, r.n, r.v, s.members, {near} AS near FROM s JOIN r ON r.page = s.page AND r.n = s.n + 1) AS j)
       SELECT s.page, s.id, s.k - 1 AS cluster, list_aggregate(f.members[s.k], 'median') AS centre FROM s JOIN (SELECT page, arg_max(members, n) AS members FROM s GROUP BY page) f ON f.page = s.page""".replace("{{", "{").replace("}}", "}")


def _checks(boundary: str = "FALSE", tolerance: int = 0, kids: str = "SELECT * FROM {tree}", parents: str = "TRUE", extra: str = "") -> str:
    return f"""
    kids AS ({kids}),
    sums AS (SELECT c.parent, count(*) AS n_children, sum(1 - {_WHY}) AS n_additive, sum({_WHY}) AS n_excluded,
        sum(CASE WHEN {_WHY} = 0 AND c.amount IS NULL THEN 1 ELSE 0 END) AS n_missing, coalesce(sum(CASE WHEN {_WHY} = 0 THEN c.amount END), 0) AS child_sum
      FROM kids c WHERE c.parent IS NOT NULL GROUP BY c.parent),
    checks AS (SELECT p.id AS parent_id, p.kind AS parent_kind, p.page AS parent_page, p.amount AS parent_amount, CAST(s.child_sum AS BIGINT) AS child_sum, CAST(p.amount - s.child_sum AS BIGINT) AS difference,
        CAST(n_children AS BIGINT) AS n_children, CAST(n_additive AS BIGINT) AS n_additive_children, CAST(n_excluded AS BIGINT) AS n_excluded_children, CAST(n_missing AS BIGINT) AS n_missing_children, {boundary} AS boundary_incomplete,
        CASE WHEN n_additive = 0 THEN 'no_additive_children' WHEN p.amount IS NULL THEN 'missing_parent_total' WHEN n_missing > 0 THEN 'incomplete_children'
          WHEN {boundary} AND p.amount - s.child_sum < -{tolerance} THEN 'mismatch' WHEN {boundary} THEN 'boundary_incomplete'
          WHEN abs(p.amount - s.child_sum) <= {tolerance} THEN 'pass' ELSE 'mismatch' END AS status
      FROM {{tree}} p JOIN sums s ON s.parent = p.id {extra} WHERE p.page IS NOT NULL AND NOT p.synthetic AND {parents})"""


_UP = "up AS (SELECT id, parent AS ancestor, 1 AS hops FROM {tree} WHERE parent IS NOT NULL UNION ALL SELECT u.id, t.parent, u.hops + 1 FROM up u JOIN {tree} t ON t.id = u.ancestor WHERE t.parent IS NOT NULL)"
_SHELLS = "reach AS (SELECT parent, id, synthetic FROM {tree} WHERE parent IS NOT NULL UNION ALL SELECT r.parent, t.id, t.synthetic FROM reach r JOIN {tree} t ON t.parent = r.id WHERE r.synthetic)"
_MAXPAGE = "last AS (SELECT t.id, max(coalesce(b.page, t.page)) AS below, max(t.page) AS own FROM {tree} t LEFT JOIN up u ON u.ancestor = t.id LEFT JOIN {tree} b ON b.id = u.id GROUP BY t.id)"
_MONEY = "SELECT *, CAST(floor(x1 / 60) AS BIGINT) AS column_id FROM {phrases} WHERE observation = 'money_candidate'"
_SUMMARY = f"""m AS ({_MONEY}), c AS (SELECT page, column_id, median(x1) AS med, min(x0) AS left_x, count(*) AS n FROM m GROUP BY page, column_id),
    s AS (SELECT c.page, c.column_id, c.n AS n_phrases, round(c.med, 2) AS right_x, round(median(abs(m.x1 - c.med)), 2) AS right_mad, c.left_x, c.n >= 3 AS recurring FROM c JOIN m USING (page, column_id) GROUP BY c.page, c.column_id, c.n, c.med, c.left_x)"""
_COLUMNS = "cols AS (SELECT page, k AS column_id, 180E0 * k AS left_x, 180E0 * (k + 1) AS right_x, k = 4 AS is_last, CASE WHEN k = 0 THEN 'Labels' ELSE 'Amount ' || CAST(k AS STRING) END AS role FROM (SELECT DISTINCT page FROM {phrases}) p, (SELECT unnest([0, 1, 2, 3, 4]) AS k) ks)"
_IN_COLUMN = "SELECT p.page, p.phrase_id, CAST(c.column_id AS BIGINT) AS column_id FROM {phrases} p JOIN cols c ON c.page = p.page WHERE (p.x0 + p.x1) / 2 >= c.left_x + 0.01E0 * ((p.y0 + p.y1) / 2) AND ((p.x0 + p.x1) / 2 < c.right_x + 0.01E0 * ((p.y0 + p.y1) / 2) OR (c.is_last AND (p.x0 + p.x1) / 2 = c.right_x + 0.01E0 * ((p.y0 + p.y1) / 2)))"
_BOUNDS = "b AS (SELECT page, band_id, phrase_id AS label_id, row_number() OVER (PARTITION BY page ORDER BY band_id, phrase_id) - 1 AS row_id FROM {phrases} WHERE phrase_id % 8 = 1 AND band_id % 3 = 0)"
_DOWN = "SELECT p.page, p.phrase_id, CAST(b.row_id AS BIGINT) AS row_id FROM {phrases} p JOIN b ON b.page = p.page LEFT JOIN b n ON n.page = b.page AND n.row_id = b.row_id + 1 WHERE p.band_id >= b.band_id AND (n.row_id IS NULL OR p.band_id < n.band_id)"
_CLUSTERS = "t AS (SELECT user_id AS page, distance, event_id FROM {ticks}), g AS (SELECT *, CASE WHEN lag(distance) OVER (PARTITION BY page ORDER BY distance DESC) - distance > 6 THEN 1 ELSE 0 END AS s FROM t), k AS (SELECT *, sum(s) OVER (PARTITION BY page ORDER BY distance DESC RANGE UNBOUNDED PRECEDING) AS cluster_no FROM g)"
_CODE = "length(code) = 15"
_CUTS = "(SELECT unnest([1, 3, 5, 6, 7, 8, 13]) AS n) cuts"
_ANC = f"anc AS (SELECT DISTINCT table_id, id, doc_pos, code, rpad(substr(code, 1, n), 15, '0') AS a FROM {{coded}}, {_CUTS} WHERE {_CODE}), up AS (SELECT * FROM anc WHERE a <> code AND a <> repeat('0', 15))"
_INDEX = f"ix AS (SELECT table_id, code, arg_max(id, doc_pos) AS found FROM {{coded}} WHERE {_CODE} GROUP BY table_id, code)"
# The nearest ancestor has the longest part before its zeros, and of equal padded codes there is one.
_NEAR = "arg_max({0}, length(rtrim(u.a, '0')))"
_SHELL = "sh AS (SELECT DISTINCT table_id, a AS code FROM up WHERE NOT EXISTS (SELECT 1 FROM ix WHERE ix.table_id = up.table_id AND ix.code = up.a))"
_EVERY = "ev AS (SELECT table_id, code, found FROM ix UNION ALL SELECT table_id, code, 'prexc:' || code FROM sh)"
_SHELL_ANC = f"shanc AS (SELECT DISTINCT table_id, code, rpad(substr(code, 1, n), 15, '0') AS a FROM sh, {_CUTS}), shup AS (SELECT * FROM shanc WHERE a <> code AND a <> repeat('0', 15))"
_ROLES = "gen AS (SELECT DISTINCT page, role FROM {amounts}), rr AS (SELECT page, role, row_number() OVER (PARTITION BY page ORDER BY CAST(regexp_extract(role, '([0-9]+)$', 1) AS BIGINT) DESC, role DESC) AS p FROM gen), res AS (SELECT page, role, CASE p WHEN 1 THEN 'Total' WHEN 2 THEN 'CO' WHEN 3 THEN 'MOOE' WHEN 4 THEN 'PS' END AS resolved FROM rr)"
_CLASS = r"""CASE WHEN regexp_full_match(t, '([0-9]{1,2}|[A-Za-z])[.)]') THEN 'marker_candidate' WHEN regexp_full_match(t, '[0-9]{12,}') THEN 'code_candidate' WHEN regexp_full_match(t, '(?i)P(HP)?[0-9][0-9,]*([.][0-9]+)?') OR regexp_full_match(t, '[0-9]{1,3}(,[0-9][0-9][0-9])+([.][0-9]+)?') OR regexp_full_match(t, '[0-9]+([.][0-9]+)?') THEN 'money_candidate' WHEN regexp_matches(t, '[0-9]') AND regexp_matches(t, '[^0-9,.()-]') THEN 'mixed_candidate' ELSE 'text_candidate' END"""
_SPLIT = r"""g AS (SELECT *, row_number() OVER w AS n, x0 - lag(x1) OVER w AS gap, replace(text, ' ', '') AS t, first_value(x0) OVER w AS x_first, lag(replace(text, ' ', '')) OVER w AS t1, lag(replace(text, ' ', ''), 2) OVER w AS t2 FROM {marked} WINDOW w AS (PARTITION BY page, band_id ORDER BY x0, token_id)),
       h AS (SELECT *, sum(CASE WHEN regexp_full_match(t, '(?i)P(HP)?[0-9]*') THEN 1 ELSE 0 END) OVER (PARTITION BY page, band_id ORDER BY x0, token_id) AS run FROM g),
       a AS (SELECT page, band_id, run, string_agg(t, '' ORDER BY x0, token_id) AS amount FROM h GROUP BY 1, 2, 3),
       e AS (SELECT h.*, a.amount, CASE WHEN n = 2 AND regexp_full_match(t1, '([0-9]{1,2}|[A-Za-z])[.)]') THEN length(t1) WHEN n = 3 AND regexp_full_match(t2 || t1, '([0-9]{1,2}|[A-Za-z])[.)]') THEN length(t2 || t1) END AS lead FROM h JOIN a USING (page, band_id, run)),
       k AS (SELECT *, CASE WHEN greatest(gap, x0 - x_first - lead * 5) >= 9 AND lead IS NOT NULL THEN CASE WHEN x0 - x_first - lead * 5 > gap THEN 'marker_compensated_gap' ELSE 'marker_raw_gap' END
                            WHEN n > 1 AND regexp_full_match(t, '(?i)P(HP)?[0-9]*') AND regexp_full_match(amount, '(?i)P(HP)?[0-9][0-9,]*([.][0-9]+)?') THEN 'currency_prefix_boundary'
                            WHEN n = 2 AND regexp_full_match(t1, '[0-9]{12,}') THEN 'program_code_boundary' WHEN gap >= 15 THEN 'gap_spaces' END AS reason FROM e)"""
_CLEANED = r"trim(regexp_replace(label, '\s+', ' ', 'g'))"

ORACLES = {
    # ---- reconciliation and trees
    "parent_total_check": f"WITH {_checks()} SELECT * FROM checks",
    "parent_total_partial_span": f"WITH RECURSIVE {_UP}, {_MAXPAGE}, {_checks('(greatest(l.below, l.own) = 400)', 1, extra='JOIN last l ON l.id = p.id')} SELECT * FROM checks",
    "parent_total_through_shells": f"WITH RECURSIVE {_SHELLS}, {_checks(kids='SELECT r.parent, t.kind, t.excluded, t.code, t.amount FROM reach r JOIN {tree} t ON t.id = r.id WHERE NOT r.synthetic')} SELECT * FROM checks",
    "parent_total_status_counts": f"WITH {_checks()} SELECT status, count(*) AS n_checks FROM checks GROUP BY status",
    "parent_total_diagnostics": f"WITH {_checks()} SELECT count(*) AS n_checks, count(*) FILTER (status IN ('pass', 'mismatch')) AS n_comparable, count(*) FILTER (status IN ('mismatch', 'missing_parent_total', 'incomplete_children')) AS n_review, count(*) FILTER (status = 'pass') AS n_pass FROM checks",
    "parent_total_page_slice": f"WITH {_checks()} SELECT parent_page AS page, count(*) AS n_checks, count(*) FILTER (status IN ('mismatch', 'missing_parent_total', 'incomplete_children')) AS n_review FROM checks GROUP BY 1",
    "tree_depth": f"WITH RECURSIVE {_UP} SELECT t.id, CAST(coalesce(max(u.hops), 0) AS BIGINT) AS depth FROM {{tree}} t LEFT JOIN up u ON u.id = t.id GROUP BY t.id",
    "tree_descendant_max_page": f"WITH RECURSIVE {_UP}, {_MAXPAGE} SELECT id, greatest(below, own) AS max_page FROM last",
    "tree_search_with_ancestors": f"WITH RECURSIVE {_UP}, hits AS (SELECT id FROM {{tree}} WHERE lower(concat_ws(' ', label, code, kind)) LIKE '%urgent%' AND page <= 20) SELECT id, TRUE AS matched FROM hits UNION ALL SELECT DISTINCT u.ancestor, FALSE FROM up u JOIN hits h ON h.id = u.id WHERE u.ancestor NOT IN (SELECT id FROM hits)",
    "tree_visible_rows": f"WITH RECURSIVE {_UP} SELECT t.id FROM {{tree}} t WHERE NOT EXISTS (SELECT 1 FROM up u JOIN {{tree}} a ON a.id = u.ancestor WHERE u.id = t.id AND NOT (a.kind IN ('table_root', 'region') OR (a.kind = 'office' AND a.page % 2 = 0) OR (a.kind = 'program' AND a.page % 3 = 0)))",
    "tree_children_lists": "SELECT parent AS id, string_agg(id, ',' ORDER BY doc_pos) AS children FROM {tree} WHERE parent IS NOT NULL GROUP BY parent",
    "tree_invariants": """WITH t AS (SELECT *, row_number() OVER (ORDER BY doc_pos) - 1 AS row_index FROM {tree}), b AS (SELECT * FROM t WHERE id NOT IN ('n3', 'r1'))
      SELECT 'row_index_not_dense' AS violation, '*' AS id FROM (SELECT count(*) AS n, max(row_index) AS m FROM b) WHERE m <> n - 1
      UNION ALL SELECT 'parent_missing', id FROM b WHERE parent IS NOT NULL AND parent NOT IN (SELECT id FROM b) UNION ALL SELECT 'bbox_without_page', id FROM b WHERE page IS NULL""",
    "shell_expansion": f"WITH RECURSIVE {_SHELLS} SELECT parent, id AS child FROM reach WHERE NOT synthetic",
    "kind_counts": "SELECT kind, count(*) AS n FROM {tree} GROUP BY kind",
    # ---- hierarchy from rows: an entry is open until a later row ranks no higher than it is stored
    "stack_parent_by_rank": """WITH r AS (SELECT *, CASE WHEN expense THEN -1.0 WHEN top_section THEN 0.0 WHEN rank = 0 AND marked THEN 0.5 ELSE rank END AS own FROM {rows}),
      s AS (SELECT *, CASE WHEN top_section AND marked AND rank = 0 AND NOT expense THEN 0.5 ELSE own END AS stored FROM r),
      p AS (SELECT a.table_id, a.doc_pos, a.id, a.stored, min(q.doc_pos) AS closed FROM s a LEFT JOIN s q ON q.table_id = a.table_id AND q.doc_pos > a.doc_pos AND NOT q.attached AND q.own <= a.stored WHERE NOT a.attached GROUP BY ALL),
      f AS (SELECT s.table_id, s.id, arg_max(p.id, p.doc_pos) AS found FROM s JOIN p ON p.table_id = s.table_id AND p.doc_pos < s.doc_pos AND (p.closed IS NULL OR p.closed >= s.doc_pos) AND p.stored < CASE WHEN s.attached THEN 99.0 ELSE s.own END GROUP BY s.table_id, s.id)
      SELECT s.table_id, s.id, CASE WHEN s.expense THEN 'root' ELSE coalesce(f.found, 'root') END AS parent FROM s LEFT JOIN f ON f.table_id = s.table_id AND f.id = s.id""",
    "segment_carry": "WITH p AS (SELECT page, coalesce(page <> lag(page) OVER (ORDER BY page) + 1, FALSE) AS gap_reset FROM {row_pages}) SELECT page, CAST(sum(CASE WHEN gap_reset THEN 1 ELSE 0 END) OVER (ORDER BY page) AS BIGINT) AS segment_id, gap_reset FROM p",
    "gap_clusters": f"WITH {_CLUSTERS} SELECT page, CAST(cluster_no AS BIGINT) AS cluster_no, median(distance) AS centre, count(*) AS n FROM k GROUP BY page, cluster_no",
    "unit_tier_centres": """WITH t AS (SELECT user_id AS page, distance FROM {ticks}), g AS (SELECT *, CASE WHEN lag(distance) OVER (PARTITION BY page ORDER BY distance DESC) - distance > 8 THEN 1 ELSE 0 END AS s FROM t),
      k AS (SELECT *, sum(s) OVER (PARTITION BY page ORDER BY distance DESC RANGE UNBOUNDED PRECEDING) AS c FROM g), m AS (SELECT page, median(CASE WHEN c = 0 THEN distance END) AS f, median(CASE WHEN c > 0 THEN distance END) AS o, max(c) + 1 AS n FROM k GROUP BY page)
      SELECT page, CASE WHEN n > 1 OR f >= 466.5 THEN f END AS region_centre, CASE WHEN n = 1 AND f < 466.5 THEN f ELSE o END AS office_centre, n = 1 AS weak, n > 2 AS extra FROM m""",
    "nearest_centre": "SELECT event_id, CAST(arg_min(i, d * 1000 + i) AS BIGINT) AS level FROM (SELECT event_id, i, round(abs(distance - c) * 100) AS d FROM {ticks}, (SELECT unnest([514.6, 496.5, 480.0, 60.0, 45.0, 30.0, 15.0, 5.0]) AS c, generate_subscripts([514.6, 496.5, 480.0, 60.0, 45.0, 30.0, 15.0, 5.0], 1) - 1 AS i) x) y GROUP BY event_id",
    "rank_ladder": f"""WITH {_CLUSTERS}, cl AS (SELECT page, cluster_no, median(distance) AS centre FROM k GROUP BY page, cluster_no), st AS (SELECT *, lag(centre) OVER w AS below, first_value(centre) OVER w AS low FROM cl WINDOW w AS (PARTITION BY page ORDER BY centre)),
      climb AS (SELECT *, coalesce(sum(greatest(1, CAST(round_even((centre - below) / 18, 0) AS BIGINT))) FILTER (below IS NOT NULL) OVER (PARTITION BY page ORDER BY centre ROWS UNBOUNDED PRECEDING), 0) AS up FROM st),
      lv AS (SELECT unnest([120.0, 100.0, 80.0, 60.0, 45.0, 30.0, 15.0, 0.0]) AS c, generate_subscripts([120.0, 100.0, 80.0, 60.0, 45.0, 30.0, 15.0, 0.0], 1) - 1 AS i)
      SELECT page, CAST(cluster_no AS BIGINT) AS cluster_no, CAST(greatest(0, (SELECT i FROM lv ORDER BY abs(low - c), i LIMIT 1) - up) AS BIGINT) AS rank FROM climb""",
    "centre_assignment": "WITH d AS (SELECT event_id, abs(distance - round(distance / 10) * 10) AS d FROM {ticks}) SELECT event_id, round(d, 3) AS delta, CASE WHEN d <= 1.5 THEN 'high' ELSE 'medium' END AS confidence, d > 4 AS outside FROM d",
    "row_total_cells": "SELECT page, band_id AS row_id, arg_max('Amount ' || CAST(token_id % 8 AS STRING), token_id) AS role, arg_max(text, token_id) AS text, arg_max_null(CASE WHEN token_id % 3 <= 1 THEN try_cast(regexp_replace(text, '[^0-9]', '', 'g') AS BIGINT) END, token_id) AS value, count(*) AS n_amounts FROM {tokens} WHERE token_id % 4 <> 1 GROUP BY 1, 2",
    "continuation_merge": """WITH r AS (SELECT *, supp % 4 = 0 AND qty % 2 = 0 AS goes_on, 'part ' || CAST(part AS STRING) AS label FROM {rows}), g AS (SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY table_id ORDER BY doc_pos) AS g FROM r)
      SELECT table_id, min(doc_pos) AS doc_pos, arg_min(id, doc_pos) AS id, string_agg(label, ' ' ORDER BY doc_pos) AS label, count(*) - 1 AS n_merged FROM g GROUP BY table_id, g""",
    "subtotal_latest_match": """WITH r AS (SELECT table_id, doc_pos, id, supp, CAST(part % 40 AS STRING) || ' item' || CASE qty % 3 WHEN 0 THEN '' WHEN 1 THEN 's' ELSE 'ss' END AS key FROM {rows}),
       s AS (SELECT table_id, doc_pos, id, unnest([key, key || 's', CASE WHEN key LIKE '%s' THEN left(key, length(key) - 1) END]) AS key FROM r WHERE supp % 9 = 0)
       SELECT s.table_id, s.id AS subtotal_id, arg_max(r.id, r.doc_pos) AS parent_id FROM s LEFT JOIN r ON r.table_id = s.table_id AND r.key = s.key AND r.doc_pos < s.doc_pos AND r.supp % 9 > 0 GROUP BY s.table_id, s.id""",
    "median_mad": "WITH m AS (SELECT rank, median(CAST(amount AS DOUBLE)) AS m FROM {rows} GROUP BY rank) SELECT rank, count(*) AS n, any_value(m) AS median, median(abs(amount - m)) AS mad FROM {rows} JOIN m USING (rank) GROUP BY rank",
    "line_fit": "SELECT rank, round(regr_slope(line, qty), 6) AS slope, round(regr_intercept(line, qty), 6) AS intercept FROM {rows} GROUP BY rank",
    "column_drift_pairs": """WITH e AS (SELECT page, CAST(floor(x1 / 30) AS BIGINT) AS column_id, phrase_id, x1, y1 FROM {phrases} WHERE observation = 'money_candidate'),
      d AS (SELECT a.page, a.column_id, median((b.x1 - a.x1) / (b.y1 - a.y1)) AS d FROM e a JOIN e b ON b.page = a.page AND b.column_id = a.column_id AND a.phrase_id < b.phrase_id WHERE abs(b.y1 - a.y1) BETWEEN 8 AND 120 AND abs(b.x1 - a.x1) <= 12 GROUP BY 1, 2)
      SELECT page, column_id, round(CASE WHEN abs(d) <= 0.05 THEN d ELSE 0 END, 6) + 0E0 AS drift FROM (SELECT DISTINCT page, column_id FROM e) k LEFT JOIN d USING (page, column_id)""",
    "baseline_tolerance": "SELECT page, greatest(1.25E0, least(3E0, 0.22E0 * median(y1 + token_id % 5 - y0))) AS tolerance FROM {tokens} GROUP BY page",
    "token_gap": f"""WITH {_SPLIT}, l AS (SELECT *, lag(token_id) OVER (PARTITION BY page, band_id ORDER BY x0, token_id) AS left_token_id FROM k)
       SELECT page, band_id, CAST(row_number() OVER (PARTITION BY page ORDER BY band_id, x0, token_id) - 1 AS BIGINT) AS gap_id, left_token_id, token_id AS right_token_id, round(gap, 3) AS gap_pt, round(gap / 5, 3) AS spaces, reason IS NOT NULL AS split, reason FROM l WHERE left_token_id IS NOT NULL""",
    "phrase_materialize": rf"""WITH {_SPLIT}, o AS (SELECT *, sum(CASE WHEN reason IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY page, band_id ORDER BY x0, token_id) AS ordinal FROM k),
       p AS (SELECT page, band_id, ordinal, regexp_replace(regexp_replace(string_agg(text, ' ' ORDER BY x0, token_id), ' ([.,):;%])', '\1', 'g'), '\( ', '(', 'g') AS text, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n_tokens FROM o GROUP BY 1, 2, 3),
       q AS (SELECT *, replace(text, ' ', '') AS t FROM p)
       SELECT page, band_id, CAST(row_number() OVER (PARTITION BY page ORDER BY band_id, ordinal) - 1 AS BIGINT) AS phrase_id, text, x0, y0, x1, y1, n_tokens, {_CLASS} AS observation FROM q""",
    "money_anchor_window": "WITH m AS (SELECT page, phrase_id, x1, max(x1) OVER (PARTITION BY page) AS r FROM {phrases} WHERE observation = 'money_candidate' AND length(replace(text, ',', '')) >= 4) SELECT page, phrase_id, x1 FROM m WHERE x1 >= r - 0.38E0 * 720E0",
    "column_summary": f"WITH {_SUMMARY} SELECT * FROM s",
    "reference_anchor": f"WITH {_SUMMARY}, w AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY recurring DESC, right_x DESC) AS k FROM s) SELECT page, right_x AS reference_x, CASE WHEN recurring THEN 'recurring' ELSE 'singleton' END AS support FROM w WHERE k = 1",
    "label_amount_pairing": "WITH a AS (SELECT page, band_id, min(x0) AS f, string_agg(CAST(phrase_id AS STRING), ',' ORDER BY phrase_id) AS amount_ids FROM {phrases} WHERE observation = 'money_candidate' GROUP BY 1, 2), l AS (SELECT p.page, p.band_id, p.phrase_id, a.amount_ids, row_number() OVER (PARTITION BY p.page, p.band_id ORDER BY p.x0, p.phrase_id) AS k FROM {phrases} p JOIN a ON a.page = p.page AND a.band_id = p.band_id WHERE p.observation <> 'money_candidate' AND p.x1 <= a.f) SELECT page, band_id, phrase_id AS label_id, amount_ids FROM l WHERE k = 1",
    "separator_candidates": "WITH j AS (SELECT a.page, a.band_id, a.phrase_id AS amount_id, l.phrase_id AS label_id, a.x0, l.x1, row_number() OVER (PARTITION BY a.page, a.phrase_id ORDER BY l.x1 DESC, l.phrase_id DESC) AS k FROM {phrases} a JOIN {phrases} l ON l.page = a.page AND l.band_id = a.band_id AND l.x1 <= a.x0 WHERE a.observation = 'money_candidate' AND l.observation <> 'money_candidate') SELECT page, band_id, amount_id, label_id, round((x1 + x0) / 2, 2) AS x, round(x0 - x1, 2) AS gap FROM j WHERE k = 1",
    "alignment_fits": f"""WITH m AS ({_MONEY}), j AS (SELECT m.page, m.column_id, (m.x0 + m.x1) / 2 AS ax, m.y1 AS ay, (p.x0 + p.x1) / 2 AS px, p.y1 AS py, row_number() OVER (PARTITION BY m.page, m.phrase_id ORDER BY p.x0, p.phrase_id) AS k FROM m JOIN {{phrases}} p ON p.page = m.page AND p.band_id = m.band_id AND p.observation IN ('text_candidate', 'mixed_candidate') AND p.x1 < m.x0),
      s AS (SELECT page, column_id, (ay - py) / (ax - px) AS slope FROM j WHERE k = 1 AND ax - px >= 40), c AS (SELECT page, column_id, median(slope) AS med, count(*) AS n FROM s GROUP BY 1, 2), f AS (SELECT page, column_id, any_value(n) AS n, any_value(med) AS med, median(abs(slope - med)) AS mad FROM s JOIN c USING (page, column_id) GROUP BY 1, 2)
      SELECT page, column_id, coalesce(n, 0) AS n_pairs, round(coalesce(med, 0E0), 6) AS slope, round(coalesce(mad, 0E0), 6) AS slope_mad, coalesce(n, 0) < 3 AS review FROM (SELECT DISTINCT page, column_id FROM m) k LEFT JOIN f USING (page, column_id)""",
    "page_drifts": """WITH e AS (SELECT page, phrase_id, x1, (y0 + y1) / 2 AS y FROM {phrases} WHERE observation = 'money_candidate'), d AS (SELECT a.page, median((b.x1 - a.x1) / (b.y - a.y)) AS d FROM e a JOIN e b ON b.page = a.page AND a.phrase_id < b.phrase_id WHERE abs(b.y - a.y) BETWEEN 8 AND 120 AND abs(b.x1 - a.x1) <= 12 GROUP BY 1)
      SELECT page, round(CASE WHEN abs(d) <= 0.05 THEN d ELSE 0 END, 6) + 0E0 AS drift FROM (SELECT DISTINCT page FROM e) k LEFT JOIN d USING (page)""",
    "anchored_columns": """WITH p AS (SELECT *, 0.015625E0 * (page % 3) AS drift, CAST(floor(x1 / 60) AS BIGINT) AS column_id FROM {phrases} WHERE observation = 'money_candidate'), c AS (SELECT *, x0 - drift * ((y0 + y1) / 2 - 432) AS l, x1 - drift * ((y0 + y1) / 2 - 432) AS r FROM p),
      m AS (SELECT page, column_id, median(r) AS med, median(x1) AS raw, min(l) AS l, min(y0) AS top, max(y1) AS bottom, count(*) AS n, any_value(drift) AS drift FROM c GROUP BY 1, 2), d AS (SELECT page, column_id, median(abs(r - med)) AS mad FROM c JOIN (SELECT page, column_id, med FROM m) USING (page, column_id) GROUP BY 1, 2)
      SELECT page, column_id, n AS n_phrases, round(med, 3) AS right_x, round(mad, 3) AS right_mad, round(raw, 3) AS raw_right_x, round(l, 3) AS amount_left_x, top, bottom, round(med + drift * (top - 432), 2) AS right_top, round(med + drift * (bottom - 432), 2) AS right_bottom, round(l + drift * (top - 432), 2) AS left_top, round(l + drift * (bottom - 432), 2) AS left_bottom,
        round(least(1E0, n / 3) * greatest(0E0, 1 - mad / 32), 3) AS context_confidence, n >= 3 AS recurring FROM m JOIN d USING (page, column_id)""",
    "relative_anchors": """WITH p AS (SELECT *, 0.015625E0 * (page % 3) * ((y0 + y1) / 2 - 432) AS shift FROM {phrases}) SELECT page, phrase_id, CASE WHEN observation = 'money_candidate' THEN 'right' ELSE 'left' END AS edge, round(CASE WHEN observation = 'money_candidate' THEN x1 ELSE x0 END - shift, 3) AS corrected_x,
        CASE WHEN page % 5 > 0 THEN round(700E0 - (CASE WHEN observation = 'money_candidate' THEN x1 ELSE x0 END - shift), 3) END AS distance FROM p""",
    "orphan_amounts": "WITH a AS (SELECT page, band_id, min(x0) AS f FROM {phrases} WHERE observation = 'money_candidate' GROUP BY 1, 2) SELECT p.page, p.phrase_id FROM {phrases} p JOIN a ON a.page = p.page AND a.band_id = p.band_id WHERE p.observation = 'money_candidate' AND NOT EXISTS (SELECT 1 FROM {phrases} l WHERE l.page = p.page AND l.band_id = p.band_id AND l.observation <> 'money_candidate' AND l.x1 <= a.f)",
    "unassigned_tokens": "SELECT page, token_id FROM {tokens} WHERE token_id % 16 = 1 OR y0 < 20",
    # ---- sections
    "layout_span_lookup": "SELECT page, CASE WHEN page BETWEEN 13 AND 108 THEN 'by_ou' WHEN page BETWEEN 100 AND 690 THEN 'pap' ELSE 'unclassified' END AS table_type, CASE WHEN page BETWEEN 13 AND 108 THEN 'wraps_up' WHEN page BETWEEN 100 AND 690 THEN 'wraps_down' ELSE 'review' END AS wrap_direction FROM {all_pages}",
    "band_range_clip": "SELECT DISTINCT page, band_id FROM {tokens} WHERE page BETWEEN 13 AND 60 AND (page <> 13 OR band_id >= 40) AND (page <> 60 OR band_id <= 90)",
    "gutter_exclusion": "SELECT page, phrase_id FROM {phrases} WHERE y1 <= 45",
    "column_interval_join": f"WITH {_COLUMNS} {_IN_COLUMN}",
    "row_boundaries_up": f"WITH {_BOUNDS} SELECT b.page, CAST(b.row_id AS BIGINT) AS row_id, p.band_id AS upper, b.band_id AS lower, b.label_id AS anchor_id FROM b LEFT JOIN b p ON p.page = b.page AND p.row_id = b.row_id - 1",
    "row_range_join_up": f"WITH {_BOUNDS} SELECT p.page, p.phrase_id, CAST(b.row_id AS BIGINT) AS row_id FROM {{phrases}} p JOIN b ON b.page = p.page LEFT JOIN b u ON u.page = b.page AND u.row_id = b.row_id - 1 WHERE p.band_id <= b.band_id AND (u.row_id IS NULL OR p.band_id > u.band_id)",
    "row_range_join_down": f"WITH {_BOUNDS} {_DOWN}",
    "cell_grid": f"""WITH {_COLUMNS}, {_BOUNDS}, ic AS ({_IN_COLUMN}), ir AS ({_DOWN}), h AS (SELECT ir.page, ir.row_id, ic.column_id, p.phrase_id, p.band_id, p.x0, p.text, p.observation FROM ir JOIN ic ON ic.page = ir.page AND ic.phrase_id = ir.phrase_id JOIN {{phrases}} p ON p.page = ir.page AND p.phrase_id = ir.phrase_id)
      SELECT b.page, CAST(b.row_id AS BIGINT) AS row_id, CAST(c.column_id AS BIGINT) AS column_id, c.role, coalesce(string_agg(CAST(h.phrase_id AS STRING), ',' ORDER BY h.band_id, h.x0, h.phrase_id), '') AS phrase_ids, coalesce(string_agg(h.text, ' ' ORDER BY h.band_id, h.x0, h.phrase_id), '') AS text, count(h.phrase_id) = 0 AS empty
      FROM b JOIN cols c ON c.page = b.page LEFT JOIN h ON h.page = b.page AND h.row_id = b.row_id AND h.column_id = c.column_id AND (h.observation = 'money_candidate') = (c.role <> 'Labels') GROUP BY 1, 2, 3, 4""",
    "header_sections": "WITH l AS (SELECT page, band_id, CASE WHEN band_id < 2 THEN 'title' ELSE 'columns' END AS role, string_agg(text, ' ' ORDER BY x0, phrase_id) AS line FROM {phrases} WHERE band_id < 6 GROUP BY 1, 2, 3) SELECT page, role, string_agg(line, chr(10) ORDER BY band_id) AS text, count(*) AS n_lines FROM l GROUP BY page, role",
    "cardinality_findings": """WITH m AS (SELECT page, band_id AS row_id, CASE WHEN x0 < 300 THEN 0 ELSE 1 END AS column_id, observation FROM {phrases}), c AS (SELECT page, row_id, column_id, count(*) FILTER (observation = 'text_candidate') AS t, count(*) FILTER (observation = 'money_candidate') AS m FROM m GROUP BY 1, 2, 3)
      SELECT page, 'multiple_main_text_candidates_in_row' AS code, row_id, CAST(NULL AS BIGINT) AS column_id FROM c GROUP BY page, row_id HAVING sum(t) > 1
      UNION ALL SELECT page, 'multiple_main_text_candidates_in_cell', row_id, CAST(column_id AS BIGINT) FROM c WHERE column_id = 0 AND t > 1 UNION ALL SELECT page, 'multiple_money_candidates_in_cell', row_id, CAST(column_id AS BIGINT) FROM c WHERE column_id = 1 AND m > 1 UNION ALL SELECT page, 'main_text_candidate_outside_label_cell', row_id, CAST(column_id AS BIGINT) FROM c WHERE column_id = 1 AND t > 0""",
    "flag_objects": """SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY seq) - 1 AS BIGINT) AS flag_id, code, coalesce(severity, 'review') AS severity, CASE WHEN cell_id IS NOT NULL THEN 'cell_section' WHEN row_id IS NOT NULL THEN 'row_section' WHEN column_id IS NOT NULL THEN 'column_section' WHEN band_id IS NOT NULL THEN 'band' ELSE 'page' END AS object_type, coalesce(cell_id, row_id, column_id, band_id) AS object_id,
      CASE code WHEN 'multiple_money_candidates_in_cell' THEN 'Amount cell contains more than one money candidate.' WHEN 'no_main_text_anchor' THEN 'No main label anchor was available for the label column.' WHEN 'main_text_candidate_outside_label_cell' THEN 'Main label candidate was assigned outside the label column.' ELSE code END AS message FROM {findings}""",
    "best_overlap_region": """WITH r AS (SELECT page, phrase_id AS region_id, phrase_id % 3 AS priority, x0 AS a0, y0 AS b0, x0 + 100 AS a1, y0 + 30 AS b1 FROM {phrases}), j AS (SELECT p.page, p.phrase_id, r.region_id, r.priority, greatest(0, least(x1, a1) - greatest(x0, a0)) * greatest(0, least(y1, b1) - greatest(y0, b0)) AS area, (x0 + x1) / 2 BETWEEN a0 AND a1 AND (y0 + y1) / 2 BETWEEN b0 AND b1 AS c FROM {phrases} p JOIN r ON r.page = p.page),
      k AS (SELECT *, row_number() OVER (PARTITION BY page, phrase_id ORDER BY CASE WHEN area > 0 THEN area ELSE 1 END DESC, priority, region_id) AS k FROM j WHERE area > 0 OR c) SELECT page, phrase_id AS line_id, region_id FROM k WHERE k = 1""",
    "majority_region": "WITH c AS (SELECT page, band_id, CAST(floor(x0 / 240) AS BIGINT) AS region_id, count(*) AS n, min(token_id) AS f FROM {tokens} WHERE token_id % 7 > 0 GROUP BY 1, 2, 3), k AS (SELECT *, row_number() OVER (PARTITION BY page, band_id ORDER BY n DESC, f) AS k FROM c) SELECT page, band_id AS line_id, region_id FROM k WHERE k = 1",
    "grid_rows": "WITH v AS (SELECT page, x0 AS v FROM {tokens}), d AS (SELECT page, v, count(*) AS n FROM v GROUP BY 1, 2), s AS (SELECT *, CASE WHEN v - lag(v) OVER (PARTITION BY page ORDER BY v) > 18 THEN 1 ELSE 0 END AS s FROM d), k AS (SELECT *, sum(s) OVER (PARTITION BY page ORDER BY v) AS line_no FROM s) SELECT page, CAST(line_no AS BIGINT) AS line_no, round(sum(v * n) / sum(n), 4) AS position, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY 1, 2",
    "polygon_corners": "SELECT phrase_id, round(720E0 * (y0 * 10 + x0 * 1000) / (720000E0 - 80) - 0, 4) AS x, round(y0 + 8E0 / 720 * (720E0 * (y0 * 10 + x0 * 1000) / (720000E0 - 80)), 4) AS y FROM {phrases}",
    # ---- text
    "observation_classify": f"SELECT token_id, {_CLASS} AS observation, CASE WHEN NOT regexp_full_match(t, '[0-9]{{12,}}') AND regexp_full_match(t, '[0-9]+([.][0-9]+)?') THEN 0.45E0 WHEN {_CLASS} IN ('money_candidate', 'code_candidate', 'marker_candidate') THEN 1E0 ELSE 0E0 END AS confidence FROM (SELECT token_id, replace(text, ' ', '') AS t FROM {{marked}}) m",
    "amount_parse": "SELECT token_id, try_cast(regexp_replace(text, '[^0-9]', '', 'g') AS BIGINT) AS amount FROM {marked}",
    "label_normalize": rf"SELECT id, trim(regexp_replace(regexp_replace(trim(regexp_replace(lower(label), '\(\s*s\s*\)', ' ', 'g')), '^[a-z]\.\d*\s+', ''), '[^a-z0-9]+', ' ', 'g')) AS label, {_CLEANED} AS cleaned FROM {{labels}}",
    "kind_classify": "SELECT id, CASE WHEN id % 6 = 2 THEN 'region' WHEN id % 6 = 4 THEN 'office' WHEN id % 6 = 5 AND rank <= 3 THEN 'program' WHEN rank >= 7 THEN 'project' WHEN rank >= 5 THEN 'intermediate' ELSE 'group' END AS kind FROM {labels}",
    "unit_kind_classify": "SELECT id, CASE WHEN length(code) = 15 AND substr(code, 7) = '000000000' THEN 'program' WHEN length(code) = 15 THEN 'activity' WHEN doc_pos % 2 = 1 THEN CASE WHEN doc_pos % 3 = 0 THEN 'region' ELSE 'tier1_uncoded' END ELSE 'office' END AS kind FROM {coded}",
    "label_predicates": "SELECT id, id % 6 = 3 AS subtotal, FALSE AS total, FALSE AS funding, id % 6 = 0 AS station_cue FROM {labels}",
    "slug": "SELECT id, trim(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM {labels}",
    "marker_extract": "SELECT id, CASE WHEN id % 3 = 0 THEN CASE WHEN id % 4 = 0 THEN 'a)' ELSE '1.' END WHEN id % 6 = 5 THEN 'b.' END AS marker FROM {labels}",
    "coordinate_order": "SELECT event_id, distance >= 100 AND FALSE AS swapped_a, distance <= 35 AS swapped_b, CASE WHEN distance >= 0 AND distance < 60 THEN round((CASE WHEN event_id % 2 = 0 THEN -1 ELSE 1 END) * (14 + distance / 60 + 30E0 / 3600), 6) END AS degrees FROM {ticks}",
    "overlap_confidence": "SELECT token_id, round(greatest(0E0, least(y1, 106) - greatest(y0, 100)) / 6, 4) AS overlap, CASE WHEN length(text) >= 2 THEN 5E0 END AS char_width FROM {tokens}",
    "size_labels": "SELECT o_orderkey, CASE WHEN o_orderkey * 397 < 1024 THEN printf('%d B', o_orderkey * 397) WHEN o_orderkey * 397 < 1048576 THEN printf('%.1f KB', o_orderkey * 397 / 1024) ELSE printf('%.1f MB', o_orderkey * 397 / 1048576) END AS size FROM orders",
    "label_anatomy_stats": "SELECT count(*) FILTER (id % 6 < 2) AS n_stripped, count(*) FILTER (id % 6 = 0) AS n_chainage, count(*) FILTER (id % 6 = 1) AS n_gps FROM {labels}",
    "title_description": rf"""SELECT id, CASE WHEN d THEN {_CLEANED} ELSE {_CLEANED} || ' ' || CASE WHEN id % 2 = 0 THEN 'This aims to widen roads' ELSE 'K12 goes on' END END AS title, CASE WHEN d THEN 'This aims to widen roads' END AS description FROM (SELECT id, label, id % 3 = 0 AND id % 2 = 0 AND id % 6 <> 0 AS d FROM {{labels}}) t""",
    # ---- codes
    "code_split": "SELECT id, substr(code, 1, 1) AS cost_structure, substr(code, 2, 2) AS outcome, substr(code, 4, 2) AS program, substr(code, 6, 1) AS subprogram, substr(code, 7, 1) AS identifier, substr(code, 8, 5) AS order_no, substr(code, 13, 3) AS suffix, CASE WHEN code IS NULL THEN NULL WHEN substr(code, 7) = '000000000' THEN 'program' ELSE 'activity' END AS kind, coalesce(substr(code, 7, 1) IN ('2', '3'), FALSE) AS is_project FROM {coded}",
    "code_ancestors": f"WITH {_ANC} SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY length(rtrim(a, '0')), a) - 1 AS BIGINT) AS depth, a AS ancestor FROM up",
    "code_longest_prefix_parent": f"WITH {_ANC}, {_INDEX}, n AS (SELECT u.id, {_NEAR.format('ix.found')} AS found FROM up u JOIN ix ON ix.table_id = u.table_id AND ix.code = u.a GROUP BY u.id) SELECT c.table_id, c.id, coalesce(n.found, c.parent) AS code_parent FROM {{coded}} c LEFT JOIN n ON n.id = c.id",
    "code_shell_synthesis": f"""WITH {_ANC}, {_INDEX}, {_SHELL}, {_EVERY}, {_SHELL_ANC}, p AS (SELECT u.table_id, u.code, {_NEAR.format('ev.found')} AS found FROM shup u JOIN ev ON ev.table_id = u.table_id AND ev.code = u.a GROUP BY 1, 2),
      z AS (SELECT sh.*, length(rtrim(code, '0')) AS k FROM sh)
      SELECT z.table_id, 'prexc:' || z.code AS id, z.code, CASE WHEN k <= 1 THEN 'prexc_cost' WHEN k <= 3 THEN 'prexc_oo' WHEN k <= 5 THEN 'prexc_program' WHEN k <= 6 THEN 'prexc_subprogram' WHEN k <= 7 THEN 'prexc_identifier' ELSE 'prexc_shell' END AS kind,
        CASE WHEN k <= 1 THEN CASE substr(z.code, 1, 1) WHEN '1' THEN 'General Administration and Support' WHEN '2' THEN 'Support to Operations' WHEN '3' THEN 'Operations' END WHEN k <= 3 THEN 'Organizational Outcome ' || substr(z.code, 2, 2) WHEN k <= 5 THEN 'Program ' || substr(z.code, 4, 2) WHEN k <= 6 THEN 'Sub-program ' || substr(z.code, 6, 1) WHEN k <= 7 THEN 'Identifier ' || substr(z.code, 7, 1) ELSE 'PREXC ' || z.code END AS label,
        coalesce(p.found, 'root') AS parent FROM z LEFT JOIN p ON p.table_id = z.table_id AND p.code = z.code""",
    "code_dual_hierarchy": f"""WITH {_ANC}, {_INDEX}, {_SHELL}, {_EVERY}, n AS (SELECT u.id, {_NEAR.format('ix.found')} AS found FROM up u JOIN ix ON ix.table_id = u.table_id AND ix.code = u.a GROUP BY u.id), e AS (SELECT u.id, {_NEAR.format('ev.found')} AS found FROM up u JOIN ev ON ev.table_id = u.table_id AND ev.code = u.a GROUP BY u.id)
      SELECT c.table_id, c.id, c.parent AS parent_pdf, coalesce(n.found, c.parent) AS parent_prexc, coalesce(e.found, c.parent) AS parent FROM {{coded}} c LEFT JOIN n ON n.id = c.id LEFT JOIN e ON e.id = c.id""",
    "code_rewire_stats": f"""WITH {_ANC}, {_INDEX}, {_SHELL}, {_EVERY}, e AS (SELECT u.id, {_NEAR.format('ev.found')} AS found FROM up u JOIN ev ON ev.table_id = u.table_id AND ev.code = u.a GROUP BY u.id) SELECT c.table_id, count(*) AS n_nodes, count(*) FILTER (c.code IS NOT NULL AND coalesce(e.found, c.parent) <> c.parent) AS n_rewired FROM {{coded}} c LEFT JOIN e ON e.id = c.id GROUP BY 1""",
    # ---- export
    "role_resolution": f"WITH {_ROLES} SELECT * FROM res",
    "amount_pivot": f"WITH {_ROLES}, a AS (SELECT id, resolved, value FROM {{amounts}} JOIN res USING (page, role) WHERE resolved IS NOT NULL) SELECT id, max(value) FILTER (resolved = 'PS') AS ps, max(value) FILTER (resolved = 'MOOE') AS mooe, max(value) FILTER (resolved = 'CO') AS co, max(value) FILTER (resolved = 'Total') AS total FROM a GROUP BY id",
    "export_rows": "SELECT CAST(1 AS BIGINT) AS table_id, CAST(row_number() OVER (ORDER BY doc_pos) - 1 AS BIGINT) AS row_index, id, kind, page, length(kind) AS tier_pdf, label, code, parent FROM {tree} WHERE NOT synthetic",
    "column_vocabulary": "WITH r AS (SELECT DISTINCT CASE value % 3 WHEN 0 THEN 'Total' WHEN 1 THEN 'MOOE' ELSE role END AS role FROM {amounts}) SELECT CAST(row_number() OVER (ORDER BY CASE role WHEN 'PS' THEN 1 WHEN 'MOOE' THEN 2 WHEN 'CO' THEN 3 WHEN 'Total' THEN 9999 ELSE 100 + CAST(substr(role, 8) AS BIGINT) END, role) - 1 AS BIGINT) AS position, role FROM r",
    "page_span": "SELECT table_id, min(page) AS first_page, max(page) AS last_page, count(*) AS n_nodes FROM {rows} GROUP BY table_id",
    "table_of_page": "WITH s AS (SELECT table_id, min(page) AS f, max(page) AS l FROM {rows} GROUP BY 1) SELECT page, table_id FROM {all_pages}, s WHERE page BETWEEN f AND l",
    "flag_page_filter": "SELECT page FROM {findings} GROUP BY page HAVING count(*) FILTER (code IN ('no_main_text_anchor', 'multiple_money_candidates_in_cell')) > 0 AND count(*) FILTER (code = 'main_text_candidate_outside_label_cell' AND page % 3 = 0) = 0",
    "box_hit_test": "WITH j AS (SELECT p.phrase_id AS point_id, b.phrase_id AS box_id, row_number() OVER (PARTITION BY p.phrase_id ORDER BY abs((b.y0 + b.y1) / 2 - (p.y0 + 3)), b.y1 - b.y0, (b.x1 - b.x0) * (b.y1 - b.y0), b.phrase_id) AS k FROM {phrases} p JOIN {phrases} b ON b.page = p.page AND p.x0 + 1 BETWEEN b.x0 AND b.x1 AND p.y0 + 3 BETWEEN b.y0 AND b.y1) SELECT point_id, box_id FROM j WHERE k = 1",
    "natural_sort": "WITH p AS (SELECT p_partkey AS row_index, CASE WHEN p_partkey % 7 > 0 THEN p_brand END AS brand FROM part) SELECT row_index, brand, CAST(row_number() OVER (ORDER BY brand IS NULL DESC, CAST(regexp_extract(brand, '([0-9]+)', 1) AS BIGINT) DESC, row_index) - 1 AS BIGINT) AS place FROM p",
    "tree_lines": """SELECT CAST(1 AS BIGINT) AS table_id, n AS row_index, '{{"row_index":' || n || ',"id":"' || id || '","kind":"' || kind || '"}}' AS json FROM (SELECT *, CAST(row_number() OVER (ORDER BY doc_pos) - 1 AS BIGINT) AS n FROM {tree} WHERE NOT synthetic) t""".replace("{{", "{").replace("}}", "}"),
    # ---- sources
    "lenient_page_lists": "WITH s AS (SELECT id, id % 9 AS a, id % 13 AS b, id % 5 + 1 AS c FROM {labels}), p AS (SELECT id, unnest(CASE WHEN a >= 1 AND b >= a THEN range(a, b + 1) ELSE []::BIGINT[] END || [CAST(3 AS BIGINT), c]) AS p FROM s) SELECT id, string_agg(CAST(p AS STRING), ',' ORDER BY p) AS pages FROM (SELECT DISTINCT id, p FROM p) d GROUP BY id",
    "page_spec_filter": "SELECT page FROM {all_pages} WHERE page BETWEEN 1 AND 3 OR page BETWEEN 5 AND 7 OR page BETWEEN 20 AND 40",
    "recognised_tokens": """WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY line) - 1 AS line_id, CAST(part % 300 AS DOUBLE) AS x FROM {lines}), t AS (SELECT l_orderkey AS page, line_id, 0 AS w, CASE WHEN line % 2 = 0 THEN 'a' ELSE 't' END AS text, x FROM l UNION ALL SELECT l_orderkey, line_id, 1, CAST(qty AS STRING), x + 60 FROM l WHERE line % 2 = 0)
      SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY line_id, w) - 1 AS BIGINT) AS token_id, CAST(line_id AS BIGINT) AS line_id, text, round(x * 0.36E0, 2) AS x0, round((x + 50) * 0.36E0, 2) AS x1 FROM t""",
    "page_union": "SELECT page FROM {all_pages} WHERE page % 2 = 0 OR page % 3 = 0",
    "index_upsert": "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'new' ELSE p_brand END AS p_brand FROM part",
    "storage_estimate": "SELECT CAST(722 * (110000 + 25000 + 12000) + 1000 AS BIGINT) AS n_bytes",
    "flag_index": "SELECT page, count(*) AS n_flags FROM {findings} WHERE code <> 'other_code' GROUP BY page",
    "stage_qa_rollup": "SELECT '002.' || CAST(page % 4 AS STRING) AS stage, count(DISTINCT page) AS n_pages, CASE WHEN any_value(page % 4) = 2 THEN count(DISTINCT page) ELSE 0 END AS n_fail, count(*) AS n_flags, any_value(page % 4) <> 2 AS pass FROM {findings} GROUP BY 1",
    "json_props_projection": "SELECT event_id, CAST(props::JSON->>'$.k' AS BIGINT) AS k FROM events",
    "reconcile_union_rollup": """WITH a AS (SELECT 'C' AS branch, c_nationkey AS k, concat_ws('_', l_returnflag, l_linestatus, c_mktsegment) AS fund, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL
      UNION ALL SELECT 'S', s_nationkey, concat_ws('_', l_returnflag, l_linestatus), sum(CAST(round(l_extendedprice * 100) AS BIGINT)) FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
      SELECT branch, n_name AS nation, fund, replace(fund, '_', '2') AS sort_key, CAST(cents AS BIGINT) AS cents FROM a LEFT JOIN nation ON n_nationkey = k""",
    # ---- row views and regions
    "left_of_label": "WITH l AS (SELECT page, band_id, x0 AS left_x FROM {phrases} WHERE phrase_id % 8 = 1) SELECT p.page, p.band_id AS row_id, p.phrase_id FROM {phrases} p JOIN l ON l.page = p.page AND l.band_id = p.band_id WHERE (p.x0 + p.x1) / 2 < l.left_x",
    "row_views": """WITH c AS (SELECT page, band_id AS row_id, phrase_id, CASE WHEN phrase_id % 4 = 1 THEN 'Labels' ELSE 'Amount ' || CAST(phrase_id % 8 AS STRING) END AS role, CASE WHEN phrase_id % 3 = 0 THEN '' ELSE text END AS text, x0 FROM {phrases}),
      l AS (SELECT page, row_id, arg_min(text, phrase_id) AS label FROM c WHERE role = 'Labels' GROUP BY 1, 2), a AS (SELECT page, row_id, arg_max(role, phrase_id) AS role, arg_max_null(try_cast(regexp_replace(text, '[^0-9]', '', 'g') AS BIGINT), phrase_id) AS total, count(DISTINCT role) AS n FROM c WHERE role <> 'Labels' AND text <> '' GROUP BY 1, 2),
      k AS (SELECT page, band_id AS row_id, arg_min(text, x0) AS code FROM {phrases} WHERE phrase_id % 8 = 6 GROUP BY 1, 2)
      SELECT r.page, r.row_id, coalesce(l.label, '') AS label, a.role, a.total, coalesce(a.n, 0) AS n_amounts, k.code, r.row_id * 2E0 AS distance FROM (SELECT DISTINCT page, row_id FROM c) r LEFT JOIN l USING (page, row_id) LEFT JOIN a USING (page, row_id) LEFT JOIN k USING (page, row_id) WHERE coalesce(l.label, '') <> '' OR a.n > 0""",
    "embedded_headers": "SELECT page, CAST(floor(band_id / 4) AS BIGINT) AS row_id, phrase_id, CAST(row_number() OVER (PARTITION BY page, CAST(floor(band_id / 4) AS BIGINT) ORDER BY band_id, phrase_id) - 1 AS BIGINT) AS seq, text FROM {phrases} WHERE x0 >= 540 AND observation <> 'money_candidate'",
    "label_line_metrics": """WITH l AS (SELECT page, CAST(floor(band_id / 2) AS BIGINT) AS row_id, band_id, min(x0) AS x0, max(x1) AS x1, list(token_id) AS ids FROM {tokens} WHERE token_id % 4 < 2 GROUP BY 1, 2, 3), n AS (SELECT *, count(*) OVER (PARTITION BY page, row_id) AS n FROM l),
      g AS (SELECT page, band_id, token_id AS r, lag(token_id) OVER w AS l, round(x0 - lag(x1) OVER w, 2) AS gap, round((x0 - lag(x1) OVER w) / 5, 2) AS spaces FROM {tokens} WINDOW w AS (PARTITION BY page, band_id ORDER BY x0, token_id)),
      m AS (SELECT n.page, n.band_id, g.gap, g.spaces, row_number() OVER (PARTITION BY n.page, n.band_id ORDER BY g.gap DESC, g.r DESC) AS k FROM n JOIN g ON g.page = n.page AND g.band_id = n.band_id WHERE n.n >= 2 AND g.l IS NOT NULL AND list_contains(n.ids, g.l) AND NOT list_contains(n.ids, g.r))
      SELECT n.page, n.row_id, n.band_id, round((n.x1 - n.x0) / 800, 6) AS fill, coalesce(m.gap, 0E0) AS run_gap_pt, coalesce(m.spaces, 0E0) AS run_gap_spaces, round(800 - n.x1, 3) AS trail_gap_pt FROM n LEFT JOIN m ON m.page = n.page AND m.band_id = n.band_id AND m.k = 1 WHERE n.n >= 2""",
    "seed_role_lookup": "WITH c AS (SELECT page, CAST(floor(x1 / 90) AS BIGINT) AS column_id, min(x0) AS l FROM {phrases} GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY l, column_id) - 1 AS k FROM c) SELECT page, column_id, CASE WHEN page = 13 AND column_id = 8 THEN 'Total' WHEN page = 13 AND column_id = 6 THEN 'CO' WHEN k = 0 THEN 'Labels' ELSE 'Amount ' || CAST(k AS STRING) END AS role FROM r",
    "centre_displacement": f"""WITH {_CLUSTERS}, cl AS (SELECT page, cluster_no, median(distance) AS centre FROM k GROUP BY 1, 2), j AS (SELECT cl.*, c, row_number() OVER (PARTITION BY page, cluster_no ORDER BY abs(centre - c), c DESC) AS n FROM cl, (SELECT unnest([120E0, 100E0, 80E0, 60E0, 45E0, 30E0, 15E0, 0E0]) AS c) x) SELECT page, CAST(cluster_no AS BIGINT) AS cluster_no, round(centre, 3) AS centre, c AS profile, round(abs(centre - c), 3) AS displacement FROM j WHERE n = 1 AND abs(centre - c) > 4""",
    "open_levels_at_end": "WITH r AS (SELECT table_id, doc_pos, rank FROM {rows} WHERE NOT attached) SELECT table_id, count(*) AS n_open FROM r WHERE NOT EXISTS (SELECT 1 FROM r q WHERE q.table_id = r.table_id AND q.doc_pos > r.doc_pos AND q.rank <= r.rank) GROUP BY table_id",
    "type_gate_failures": "SELECT page, 'expected pap, found ' || CASE WHEN page BETWEEN 13 AND 108 THEN 'by_ou' ELSE 'unclassified' END AS message FROM {all_pages} WHERE NOT page BETWEEN 109 AND 690",
    "pages_off_span": "SELECT page FROM {all_pages} WHERE page < 13 OR page > 108",
    "tree_page_slice": "WITH n AS (SELECT page, count(*) AS n FROM {tree} WHERE page IS NOT NULL GROUP BY 1), f AS (SELECT page, count(*) AS f FROM {findings} GROUP BY 1) SELECT coalesce(n.page, f.page) AS page, coalesce(n, 0) AS n_nodes, coalesce(f, 0) AS n_flags FROM n FULL OUTER JOIN f ON f.page = n.page",
    "centre_statistics": """WITH r AS (SELECT user_id, CAST(floor(distance / 25) AS BIGINT) AS level, distance FROM {ticks}), m AS (SELECT level, median(distance) AS m FROM r GROUP BY 1)
      SELECT level, count(*) AS n, count(DISTINCT user_id) AS n_pages, min(distance) AS least, max(distance) AS greatest, round(quantile_cont(distance, 0.05), 6) AS p05, round(quantile_cont(distance, 0.95), 6) AS p95, round(median(abs(distance - m)), 6) AS mad, round(max(abs(distance - level * 25)), 6) AS furthest FROM r JOIN m USING (level) GROUP BY level""",
    "page_confidence": "SELECT page, round(avg((token_id % 64) / 64) FILTER (token_id % 3 > 0), 4) AS confidence FROM {tokens} GROUP BY page",
    "repaired_claims": "SELECT page, CASE WHEN phrase_id % 24 = 2 AND phrase_id % 7 > 0 THEN phrase_id + 8 ELSE phrase_id - 1 END AS label_id, phrase_id AS amount_id FROM {phrases} WHERE phrase_id % 4 = 2 AND (phrase_id % 5 > 0 OR (phrase_id % 24 = 2 AND phrase_id % 7 > 0))",
    "layout_region_filter": "WITH b AS (SELECT page, CASE WHEN phrase_id % 5 = 0 THEN 'header' ELSE 'table' END AS label, round(phrase_id % 100 / 100, 4) AS score, round(x0 / 2, 2) AS x0, round(y0 / 2, 2) AS y0, round(x1 / 2, 2) AS x1, round(y1 / 2, 2) AS y1 FROM {phrases} WHERE phrase_id % 100 >= 40) SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY y0, x0, label, score) - 1 AS BIGINT) AS region_id, label, score, x0, y0, x1, y1, label = 'header' AS chrome FROM b",
    "money_or_year": "SELECT token_id, CASE token_id % 4 WHEN 2 THEN NOT (length(text) = 5 AND try_cast(replace(text, ',', '') AS INT) BETWEEN 1900 AND 2100) ELSE FALSE END AS is_money FROM {tokens}",
    "cell_text_fill": """WITH c AS (SELECT page, phrase_id AS cell_id, x0, y0, x0 + 90 AS x1, y0 + 40 AS y1 FROM {phrases}), j AS (SELECT c.page, c.cell_id, p.y0, p.x0, p.text, p.phrase_id FROM c JOIN {phrases} p ON p.page = c.page
        WHERE ((p.x0 + p.x1) / 2 BETWEEN c.x0 AND c.x1 AND (p.y0 + p.y1) / 2 BETWEEN c.y0 AND c.y1) OR greatest(0, least(c.x1, p.x1) - greatest(c.x0, p.x0)) * greatest(0, least(c.y1, p.y1) - greatest(c.y0, p.y0)) >= 0.05E0 * 3600),
      f AS (SELECT *, lag(text) OVER (PARTITION BY page, cell_id ORDER BY y0, x0, text, phrase_id) AS b FROM j) SELECT page, cell_id, string_agg(text, ' ' ORDER BY y0, x0, text, phrase_id) AS text FROM f WHERE b IS NULL OR b <> text GROUP BY 1, 2""",
    "grid_quality": "WITH g AS (SELECT page, y0 AS r, CAST(floor(x0 / 90) AS BIGINT) AS c FROM {tokens}), n AS (SELECT page, count(DISTINCT r) AS n_rows, count(DISTINCT c) AS n_columns FROM g GROUP BY 1), u AS (SELECT page, count(*) AS n FROM (SELECT DISTINCT page, r, c FROM g) d GROUP BY 1) SELECT page, n_rows, n_columns, round(n / (n_rows * n_columns), 3) AS fill, n_rows >= 3 AND n_columns >= 2 AND n / (n_rows * n_columns) >= 0.15 AS ok FROM n JOIN u USING (page)",
    "zone_schema": """WITH z AS (SELECT page, CASE WHEN page % 11 = 0 THEN 'text' WHEN page % 13 = 0 THEN 'figure' ELSE 'table' END AS label, page % 4 AS r, CASE WHEN page % 4 < 2 THEN page % 6 ELSE 0 END AS m FROM {row_pages}),
      o AS (SELECT page, CASE WHEN r >= 2 THEN 'lattice' WHEN page % 9 = 0 AND m <= 2 THEN 'amount_anchored' WHEN m >= 2 THEN 'lattice' WHEN m = 1 THEN 'amount_anchored' WHEN page % 17 = 0 THEN 'years' WHEN label <> 'table' THEN 'prose' ELSE 'passthrough' END AS mode,
        CASE WHEN r >= 2 OR (page % 9 = 0 AND m <= 2) THEN 0.95 WHEN m >= 2 THEN 0.78 WHEN m = 1 THEN 0.7 WHEN page % 17 = 0 THEN 0.65 WHEN label = 'text' THEN 0.8 WHEN label <> 'table' THEN 0.6 ELSE 0.35 END AS confidence FROM z),
      w AS (SELECT a.*, (SELECT arg_max(b.mode, b.page) FROM o b WHERE b.page < a.page AND b.mode <> 'passthrough' AND (SELECT count(*) FROM o c WHERE c.page >= b.page AND c.page < a.page) = a.page - b.page) AS carry FROM o a),
      v AS (SELECT page, mode = 'passthrough' AND carry IN ('lattice', 'amount_anchored') AS t, mode, carry, CAST(confidence AS DOUBLE) AS confidence FROM w)
      SELECT page, 0 AS zone_id, CASE WHEN t THEN carry ELSE mode END AS mode, CASE WHEN t THEN 0.55E0 ELSE confidence END AS confidence, CASE WHEN t THEN 'review' WHEN confidence >= 0.8 THEN 'accept' WHEN confidence >= 0.5 THEN 'review' ELSE 'reject' END AS status FROM v""",
    "header_roles": "SELECT id, CASE id % 4 WHEN 0 THEN 'PS' WHEN 1 THEN 'CO' WHEN 2 THEN 'MOOE' END AS role FROM {labels}",
    "csv_rows": """WITH n AS (SELECT *, CAST(row_number() OVER (ORDER BY doc_pos) - 1 AS BIGINT) AS row_index FROM {tree} WHERE NOT synthetic), v AS (SELECT 'c' || CAST(CAST(floor(value / 64) AS BIGINT) AS STRING) AS id, value % 2 AS odd, max(value) AS value FROM {amounts} GROUP BY 1, 2),
       c AS (SELECT n.*, n.parent AS pdf, CASE WHEN kind = 'program' THEN 'root' ELSE n.parent END AS prexc FROM n), x AS (SELECT c.*, f.kind IS NULL AS lost, g.id AS grand, h.kind IS NULL AS lost_grand FROM c LEFT JOIN n f ON f.id = c.pdf LEFT JOIN n g ON g.id = c.pdf LEFT JOIN n h ON h.id = g.parent)
       SELECT row_index, x.id, kind, page, CAST(length(kind) AS BIGINT) AS tier_pdf, label, code, pdf AS parent_id_pdf, prexc AS parent_id_prexc,
         CAST(CASE kind WHEN 'region' THEN 1 WHEN 'office' THEN 2 WHEN 'program' THEN CASE WHEN lost THEN 0 ELSE 3 END ELSE CASE WHEN lost THEN 0 WHEN lost_grand THEN 1 ELSE 4 END END AS BIGINT) AS depth_pdf,
         CAST(CASE kind WHEN 'region' THEN 1 WHEN 'office' THEN 2 WHEN 'program' THEN 1 ELSE CASE WHEN lost THEN 0 ELSE 2 END END AS BIGINT) AS depth_prexc, CASE WHEN length(code) = 15 THEN substr(code, 7, 1) END AS prexc_identifier,
         p.value AS ps, CAST(NULL AS BIGINT) AS mooe, CAST(NULL AS BIGINT) AS co, t.value + 1 AS total FROM x LEFT JOIN v p ON p.id = x.id AND p.odd = 0 LEFT JOIN v t ON t.id = x.id AND t.odd = 1 WHERE kind <> 'table_root'""",
    "station_chips": "SELECT id, 'K ' || CAST(rank AS STRING) || CASE WHEN id % 2 = 0 THEN ' – end' ELSE '' END AS chip FROM {labels}",
    "flag_messages": "SELECT page, seq, CASE seq % 3 WHEN 0 THEN 'info' ELSE 'review' END AS severity, CASE seq % 3 WHEN 0 THEN 'Continuation fragment row was merged into the previous row.' WHEN 1 THEN 'Page distance fit used fewer than two supported clusters.' ELSE CASE code WHEN 'multiple_money_candidates_in_cell' THEN 'Inherited from stage 002.20: ambiguous amount cell.' WHEN 'main_text_candidate_outside_label_cell' THEN 'Inherited from stage 002.20: label candidate outside label column.' ELSE code END END AS message FROM {findings}",
    "label_anatomy": rf"SELECT CAST(id AS STRING) AS id, CASE id % 6 WHEN 0 THEN regexp_replace({_CLEANED}, ' - K.*$', '') WHEN 1 THEN regexp_replace({_CLEANED}, ' \(14.*$', '') ELSE {_CLEANED} END AS label, CASE WHEN id % 6 < 2 THEN {_CLEANED} END AS label_ocr, CAST(CASE WHEN id % 6 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_chainages, CAST(CASE WHEN id % 6 = 1 THEN 1 ELSE 0 END AS BIGINT) AS n_coordinates FROM {{labels}}",
    "plan_csv_rows": r"""WITH n AS (SELECT *, CAST(row_number() OVER (ORDER BY doc_pos) - 1 AS BIGINT) AS row_index FROM {tree} WHERE NOT synthetic), l AS (SELECT 'c' || CAST(id AS STRING) AS id, id % 6 AS m, label FROM {labels})
       SELECT row_index, n.id, n.kind, n.page, CAST(length(kind) AS BIGINT) AS tier_pdf, n.label, n.code, n.parent AS parent_id, n.amount,
         CASE WHEN m = 0 THEN '[{"kind": "K", "from": "' || regexp_extract(l.label, 'K([0-9]+) \+ ([0-9]+) - K', 1) || '+' || regexp_extract(l.label, 'K([0-9]+) \+ ([0-9]+) - K', 2) || '", "to": "' || regexp_extract(l.label, '- K([0-9]+) \+ ([0-9]+)$', 1) || '+' || regexp_extract(l.label, '- K([0-9]+) \+ ([0-9]+)$', 2) || '"}]' END AS chainages,
         CASE WHEN m = 1 THEN round(CAST(regexp_extract(l.label, '\((14[.][0-9]+)', 1) AS DOUBLE), 6) END AS lat, CASE WHEN m = 1 THEN round(CAST(regexp_extract(l.label, '(120[.][0-9]+)\)', 1) AS DOUBLE), 6) END AS lon
       FROM n LEFT JOIN l ON l.id = n.id WHERE kind <> 'table_root'""",
    "tree_expand_ancestors": f"WITH RECURSIVE {_UP} SELECT DISTINCT u.ancestor AS id FROM up u JOIN {{tree}} t ON t.id = u.id WHERE t.page = 7 AND t.kind = 'activity'",
    "tree_row_list": """WITH t AS (SELECT *, CASE WHEN kind = 'program' THEN 'root' ELSE parent END AS up FROM {tree})
       SELECT id, doc_pos, CAST(CASE kind WHEN 'table_root' THEN 0 WHEN 'region' THEN 1 WHEN 'program' THEN 1 ELSE 2 END AS BIGINT) AS depth, id IN (SELECT up FROM t WHERE up IS NOT NULL) AS has_children FROM t""",
    "header_cues": "SELECT id, id % 4 = 0 AS amount_header, id % 4 = 1 AS year, id % 4 = 2 AS unit FROM {labels}",
    "amount_column_clusters": _medians("x1", "x1, y1", 7.5, "observation = 'money_candidate'"),
    "label_indent_clusters": _medians("x0", "x0, y0", 5.0, "observation <> 'money_candidate'"),
    "page_extracts": "SELECT page, 'page' AS label, string_agg(CAST(token_id AS STRING), ',' ORDER BY token_id) AS token_ids, (SELECT string_agg(CAST(band_id AS STRING), ',' ORDER BY band_id) FROM (SELECT DISTINCT page AS p, band_id FROM {tokens}) b WHERE b.p = t.page) AS line_ids, count(*) AS n_tokens, count(DISTINCT band_id) AS n_lines, round(avg((token_id % 64) / 64E0), 6) AS mean_confidence FROM {tokens} t GROUP BY page",
    "zone_texts": "WITH l AS (SELECT page, band_id, string_agg(text, ' ' ORDER BY x0, token_id) AS text FROM {tokens} GROUP BY 1, 2) SELECT page, band_id % 2 AS zone_id, string_agg(text, ' ' ORDER BY band_id) AS text FROM l GROUP BY 1, 2",
    "label_previews": "SELECT id, left(label || ' ' || label, 48) AS preview FROM {labels}",
    # Row by row of a table: the open stack (with each entry's parent) and the programmes by prefix so far.
    "unit_stack_parents": """WITH RECURSIVE r AS (SELECT table_id, id, row_number() OVER (PARTITION BY table_id ORDER BY doc_pos) AS n, CAST(floor(page / 40) AS BIGINT) AS seg, '31010' || CAST(supp % 9 AS STRING) AS prefix,
         CASE WHEN doc_pos % 19 = 0 THEN 'section' WHEN doc_pos % 23 = 0 THEN 'subtotal' WHEN doc_pos % 29 = 0 THEN 'funding' WHEN rank = 0 THEN 'program' WHEN rank < 3 THEN 'activity' WHEN rank < 5 THEN 'region' ELSE 'office' END AS kind FROM {rows}),
       s AS (SELECT table_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS STRING) AS id, CAST(NULL AS BIGINT) AS seg, [{'tier': 0, 'id': 'root', 'coded': FALSE, 'up': 'root'}] AS stack, CAST(MAP([], []) AS MAP(STRING, STRING)) AS programs, CAST(NULL AS STRING) AS parent, CAST(NULL AS STRING) AS flag, CAST(NULL AS STRING) AS match FROM (SELECT DISTINCT table_id FROM r) t
         UNION ALL SELECT table_id, n, id, seg,
           CASE kind WHEN 'section' THEN [{'tier': 0, 'id': id, 'coded': FALSE, 'up': 'root'}] WHEN 'subtotal' THEN opened WHEN 'funding' THEN kept
             WHEN 'region' THEN list_append(CASE WHEN replaced THEN list_slice(kept, 1, len(kept) - 1) ELSE kept END, {'tier': 1, 'id': id, 'coded': FALSE, 'up': parent}) WHEN 'office' THEN list_append(kept, {'tier': 2, 'id': id, 'coded': FALSE, 'up': parent})
             ELSE list_append(kept, {'tier': 1, 'id': id, 'coded': TRUE, 'up': parent}) END,
           CASE WHEN kind = 'program' THEN map_concat(programs, MAP([prefix], [id])) ELSE programs END, parent,
           nullif(concat_ws(',', CASE WHEN gap THEN 'carry_gap_reset' END, CASE WHEN kind = 'subtotal' THEN 'subtotal_parent_unmatched' END, CASE WHEN kind = 'activity' AND program IS NULL THEN 'activity_without_program_parent' END), ''), CASE WHEN kind = 'subtotal' THEN 'open_section' END
         FROM (SELECT *, kind = 'region' AND kept[-1].tier = 1 AND NOT kept[-1].coded AS replaced,
                 CASE kind WHEN 'section' THEN 'root' WHEN 'subtotal' THEN opened[1].id WHEN 'activity' THEN coalesce(program, kept[-1].id) WHEN 'region' THEN CASE WHEN kept[-1].tier = 1 AND NOT kept[-1].coded THEN kept[-1].up ELSE kept[-1].id END ELSE kept[-1].id END AS parent
               FROM (SELECT *, CASE WHEN kind = 'program' OR (kind = 'activity' AND program IS NULL) THEN [opened[1]]
                         WHEN kind = 'activity' THEN CASE WHEN place IS NULL THEN [opened[1]] ELSE list_slice(opened, 1, place) END ELSE list_filter(opened, lambda e, i: i = 1 OR e.tier < 2) END AS kept
                     FROM (SELECT *, list_position(list_transform(opened, lambda e: e.id), program) AS place
                           FROM (SELECT r.table_id, r.n, r.id, r.seg, r.kind, r.prefix, s.programs, s.seg IS NOT NULL AND s.seg <> r.seg AS gap, CASE WHEN s.seg IS NOT NULL AND s.seg <> r.seg THEN [{'tier': 0, 'id': 'root', 'coded': FALSE, 'up': 'root'}] ELSE s.stack END AS opened,
                                   CASE WHEN r.kind = 'activity' THEN s.programs[r.prefix] END AS program FROM s JOIN r ON r.table_id = s.table_id AND r.n = s.n + 1) a) b) c) d)
       SELECT table_id, id, parent, flag, match FROM s WHERE n > 0""",
}
