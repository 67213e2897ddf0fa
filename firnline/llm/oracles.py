"""Equivalent SQL (DuckDB) of the text queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op8_quality"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), g AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS times FROM (
    SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
    FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))
), r AS (
  SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS pos FROM g WHERE times > 1) GROUP BY rid
), c AS (
  SELECT doc_id, len(ws) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(ls) AS n_lines, length(text) - length(translate(text, '!?', '')) AS n_shouts
  FROM w LEFT JOIN r USING (rid)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 100 > n_words * 10 OR n_shouts * 100 > n_words * 30
    OR n_dup_lines * 100 > n_lines * 40 OR word_chars * 10 < n_words * 20 OR word_chars * 10 > n_words * 140) AS kept
FROM f
"""

ORACLE["op12_line_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), c AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT rid) >= 3
), m AS (
  SELECT rid, k.doc_id, line, pos, coalesce(top IS NOT NULL AND (k.doc_id IS NULL OR k.doc_id < top), false) AS gone
  FROM k LEFT JOIN c USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""

ORACLE["op13_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), w AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 10
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), n AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term
), tot AS (
  SELECT lang, source, sum(n)::HUGEINT AS tot FROM n GROUP BY lang, source
), p AS (
  SELECT g.lang, g.source, term, coalesce(n.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 2)) // (coalesce(tot, 0) + 2 * v) AS p
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term) LEFT JOIN tot USING (lang, source)
), lt AS (
  SELECT lang, sum(tot) AS tot FROM tot GROUP BY lang
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (any_value(tot) + 2 * any_value(v)) AS q
  FROM n JOIN lt USING (lang) JOIN v USING (lang) GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), res AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM res
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
