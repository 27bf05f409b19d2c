"""DuckDB texts of the queries that SQL expresses in full."""

from __future__ import annotations

CHECKS: dict[str, str] = {}

CHECKS["op11_exact"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(plain) AS text_sha256
FROM t WINDOW w AS (PARTITION BY plain ORDER BY chars DESC, doc_id)"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

CHECKS["op12_search"] = f"""
WITH word AS (SELECT doc_id, {_TERMS} AS term FROM documents),
  size AS (SELECT doc_id, count(*) AS n FROM word GROUP BY doc_id),
  whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM size),
  held AS (SELECT doc_id, term, count(*) AS tf FROM word GROUP BY ALL),
  spread AS (SELECT term, count(*) AS df FROM held GROUP BY term),
  asked AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
  score AS (
    SELECT item_id, doc_id, sum(
      floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
        * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN spread USING (term) JOIN size USING (doc_id) CROSS JOIN whole
    GROUP BY ALL HAVING score > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS "rank", doc_id, score
FROM score QUALIFY "rank" <= 10"""

_ITEM_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

CHECKS["op1_decontaminate"] = f"""
WITH doc AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
  item AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
  pattern AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s:s + 9], ' ') AS p
    FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(s) WHERE len(w) > 0),
  run AS (
    SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS p
    FROM doc, (SELECT DISTINCT size FROM pattern), unnest(range(1, len(w) - size + 2)) t(s) WHERE len(w) >= size),
  hit AS (SELECT DISTINCT doc_id, s, size, item_id FROM run JOIN pattern USING (size, p)),
  word AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM (SELECT DISTINCT doc_id, s, size FROM hit)) GROUP BY doc_id),
  owner AS (
    SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(owner.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(word.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN owner USING (doc_id)"""

_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), [])"

CHECKS["op4_neardup"] = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
  shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[s:s + 2], ' ') AS x
    FROM doc, unnest(range(1, greatest(len(w) - 2, 1) + 1)) t(s) WHERE len(w) > 0),
  size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
  common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY ALL),
  link AS (
    SELECT a, b FROM common c JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c.n >= 85 * (p.n + q.n - c.n)),
  edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
  reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON r.other = e.a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id"""

# Runs of three lines with text, and single lines of 25 words, count from their second place on.
CHECKS["op8_linedup"] = r"""
WITH split AS (SELECT doc_id, coalesce(string_split(text, chr(10)), []) AS lines FROM documents),
  line AS (
    SELECT doc_id, i, lines[i] AS raw, trim(lines[i], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS x
    FROM split, unnest(range(1, len(lines) + 1)) t(i)),
  filled AS (
    SELECT *, lead(x, 1) OVER w AS x2, lead(x, 2) OVER w AS x3, lead(i, 1) OVER w AS i2, lead(i, 2) OVER w AS i3
    FROM line WHERE x <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
  run AS (
    SELECT doc_id, i, [i, i2, i3] AS held, concat_ws(chr(10), '3', x, x2, x3) AS key FROM filled WHERE x3 IS NOT NULL
    UNION ALL SELECT doc_id, i, [i], concat_ws(chr(10), '1', x) FROM filled
    WHERE len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 25),
  again AS (SELECT doc_id, held FROM run QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1),
  gone AS (SELECT DISTINCT doc_id, unnest(held) AS i FROM again),
  kept AS (
    SELECT doc_id, count(gone.i) AS n, string_agg(raw, chr(10) ORDER BY line.i) FILTER (gone.i IS NULL) AS text
    FROM line LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(lines)::BIGINT AS n_lines, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""
