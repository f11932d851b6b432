"""SQL for DuckDB that gives the rows of those training-data queries that SQL can express."""

#: A source's stream is its documents in order of a hash; what a target takes of it is a number of whole turns
#: and a first part. Levels: in order of cap by weight, the first source that the common level doesn't fill.
MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null:' || coalesce(text, ''))) AS shuffle
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, 2.0::DOUBLE * source_size AS cap FROM sources
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, n) AS k FROM weighed
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ordered
), first_open AS (
  SELECT k AS open_k, level AS open_level FROM levels WHERE level * weight <= cap ORDER BY k LIMIT 1
), goals AS (
  SELECT source, source_size, CASE WHEN k >= open_k THEN open_level * weight ELSE cap END AS target FROM levels LEFT JOIN first_open ON TRUE
), streamed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, floor(g.target)::BIGINT AS goal,
         (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffle, s.size ROWS UNBOUNDED PRECEDING) - s.size)::BIGINT AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE goal // source_size * size + greatest(0, least(size, goal % source_size - start)) END::BIGINT AS taken
FROM streamed
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER alike AS keep_id, count(*) OVER alike AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER alike AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW alike AS (PARTITION BY coalesce(text, ''))
"""

#: All pairs that share a shingle, counted; groups by reachability.
NEAR_COPIES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS shingle FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE k * 1.8 >= 0.8 * (x.n + y.n) - 1e-6
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.c)
SELECT d.doc_id, (SELECT min(r.c) FROM r WHERE r.id = d.doc_id) AS class_id, (SELECT count(*) FROM e WHERE e.a = d.doc_id) AS n_links FROM d
"""


def license_scan(templates, base, least_match: float = 0.6) -> str:
    """Every place of every document is tried; the words are the templates' own."""
    words = lambda phrase: "[" + ", ".join(f"'{w}'" for w in phrase.split()) + "]"
    rows = []
    for t in templates:
        all_words, key = t.words.split(), t.key.split()
        at = next(i for i in range(len(all_words)) if all_words[i : i + len(key)] == key)
        rows.append(f"('{t.label}', {words(t.words)}, {words(t.key)}, {at})")
    phrases = ", ".join(f"({words(p)}, '{label}')" for p, label in base.items())
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), b AS (SELECT doc_id, i - 1 AS start, label FROM p JOIN (VALUES {phrases}) AS f(phrase, label) ON w[i] = phrase[1] AND w[i:i + len(phrase) - 1] = phrase
), t AS (SELECT * FROM (VALUES {', '.join(rows)}) AS f(label, words, key, place)
), m AS (
  SELECT doc_id, label, list_sum(list_transform(range(1, len(words) + 1), lambda k: CASE WHEN i - place + k - 1 >= 1 AND w[i - place + k - 1] = words[k] THEN 1 ELSE 0 END)) / len(words) AS share
  FROM p JOIN t ON w[i] = key[1] AND w[i:i + len(key) - 1] = key
), own AS (SELECT doc_id, label, share FROM m WHERE share >= {least_match}
), labelled AS (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM own)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (SELECT count(*) FROM b WHERE b.doc_id = d.doc_id) AS n_base, (SELECT min(start) FROM b WHERE b.doc_id = d.doc_id) AS first_word,
       (SELECT max(start) FROM b WHERE b.doc_id = d.doc_id) AS last_word, coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM b WHERE b.doc_id = d.doc_id), '') AS base_labels,
       coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM labelled x WHERE x.doc_id = d.doc_id), '') AS labels,
       greatest(coalesce((SELECT max(share) FROM own WHERE own.doc_id = d.doc_id), 0), CASE WHEN EXISTS (SELECT 1 FROM b WHERE b.doc_id = d.doc_id) THEN 0.5 ELSE 0 END)::DOUBLE AS score
FROM d
"""
