"""DuckDB SQL for the queries that SQL can express."""

# The offset and the order by hash repeat the operator's own md5 rules.
OP6 = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS w FROM s),
c AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         CAST(coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS capped,
         sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM w),
l AS (SELECT max((total - 3.0 * capped) / rest) AS level FROM c WHERE (total - 3.0 * capped) / rest * w <= 3.0 * source_size),
t AS (SELECT source, source_size, least(coalesce(level * w, 3.0 * source_size), 3.0 * source_size) AS target FROM c CROSS JOIN l),
r AS (
  SELECT doc_id, source, size, CAST(row_number() OVER (PARTITION BY source ORDER BY size, h, doc_id) - 1 AS DOUBLE) AS k FROM d),
j AS (
  SELECT r.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix' || coalesce('=' || r.source, 'null')), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0 AS u
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CAST(floor((k + 1.0) * rate + u) - floor(k * rate + u) AS BIGINT) AS copies FROM j)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM e
"""

OP2 = """
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
b AS (
  SELECT row_id, doc_id, source, text, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
           - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines
  FROM d),
g AS (
  SELECT row_id, i, array_to_string(words[i:i+4], ' ') AS gram
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)),
again AS (SELECT *, count(*) OVER (PARTITION BY row_id, gram) AS n FROM g),
r AS (
  SELECT row_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT row_id, unnest(range(i, i + 5)) AS place FROM again WHERE n > 1) GROUP BY row_id),
l AS (
  SELECT row_id, source, text, line, len(regexp_extract_all(line, '[^ ]+')) AS words
  FROM (SELECT row_id, source, text, trim(regexp_replace(lower(unnest(lines)), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line FROM d)
  WHERE line <> ''),
h AS (SELECT source, count(DISTINCT text) AS host_docs FROM d GROUP BY source),
f AS (
  SELECT n.source, n.line
  FROM (SELECT source, line, count(DISTINCT text) AS n_docs FROM l GROUP BY source, line) n
  JOIN h ON n.source IS NOT DISTINCT FROM h.source
  WHERE n_docs > 30 OR (n_docs > 10 AND 100 * n_docs > host_docs)),
x AS (
  SELECT row_id, CAST(sum(words) AS BIGINT) AS removed_words
  FROM l JOIN f ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line GROUP BY row_id),
o AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS base_failed,
         coalesce(removed_words, 0) AS removed_words
  FROM b LEFT JOIN r USING (row_id) LEFT JOIN x USING (row_id))
SELECT *, NOT base_failed AND removed_words <= 0.5 * n_words AS kept FROM o
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{TERM}') AS terms
  FROM documents),
sizes AS (SELECT row_id, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
facts AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
q AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{TERM}')) AS term
  FROM (SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id, text FROM benchmark))),
t AS (
  SELECT row_id, term, count(*) AS tf
  FROM (SELECT row_id, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY row_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM t CROSS JOIN facts GROUP BY term),
m AS (SELECT row_id, doc_id, 50 + (50 * n * docs) // total AS m FROM sizes CROSS JOIN facts),
s AS (
  SELECT q.item, q.item_id, m.row_id, m.doc_id, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * m.m))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m ON t.row_id = m.row_id
  GROUP BY q.item, q.item_id, m.row_id, m.doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""

ORACLE: dict[str, str] = {"op2_quality": OP2, "op6_mixing": OP6, "op11_lexical": OP11}
