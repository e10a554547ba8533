"""DuckDB SQL for the corpus queries that SQL can express."""

from tabulyst.llm import licenses

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATE = rf"""
WITH words_d AS (
  SELECT row_number() OVER () AS k, doc_id,
         coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
words_b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
win_b AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM words_b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM win_b),
win_d AS (
  SELECT k, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT k, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM words_d, lengths WHERE len(w) >= n)),
found AS (SELECT d.k, d.i, d.n, b.item_id FROM win_d d JOIN win_b b ON b.n = d.n AND b.win = d.win),
hit AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY k),
named AS (SELECT k, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM found GROUP BY k)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words_d d LEFT JOIN hit h USING (k) LEFT JOIN named m USING (k)
"""

JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS k, doc_id,
         coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
sh AS (
  SELECT DISTINCT k, array_to_string(list_slice(w, i, i + least(4, len(w)) - 1), ' ') AS s
  FROM (SELECT k, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
size AS (SELECT k, count(*) AS n FROM sh GROUP BY k),
overlap AS (SELECT a.k AS x, b.k AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.k < b.k GROUP BY ALL),
link AS (
  SELECT x, y FROM overlap JOIN size nx ON nx.k = x JOIN size ny ON ny.k = y
  WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(k, r) AS (
  SELECT k, k FROM w UNION SELECT reach.k, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.r)
SELECT w.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, least.component_id
FROM w LEFT JOIN size USING (k)
JOIN (SELECT reach.k, min(o.doc_id) AS component_id FROM reach JOIN w o ON o.k = reach.r GROUP BY reach.k) least USING (k)
"""

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _found(kind: str, rank: int, pattern: str, least: int, group: int, more: str = "") -> str:
    return rf"""
  SELECT k, owner, '{kind}' AS kind, {rank} AS rank, value, p + length(before) - length(whole) AS start, p + length(before) AS "end" FROM (
    SELECT *, sum(length(before) + length(whole)) OVER (PARTITION BY k ORDER BY i) - length(before) AS p FROM (
      SELECT k, owner, unnest(generate_series(1, len(regexp_extract_all(t, '{pattern}', 0)))) AS i,
             unnest(string_split_regex(t, '{pattern}')[1:len(regexp_extract_all(t, '{pattern}', 0))]) AS before,
             unnest(regexp_extract_all(t, '{pattern}', 0)) AS whole, unnest(regexp_extract_all(t, '{pattern}', {group})) AS value
      FROM d WHERE regexp_matches(t, '{pattern}')))
  WHERE length(value) >= {least}{more}"""


SECRETS = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner FROM documents),
m AS ({_found('assign', 1, _ASSIGN, 8, 2)} UNION ALL {_found('access', 2, 'AKIA[A-Z0-9]+', 16, 0)}
  UNION ALL {_found('hex', 3, '[0-9a-f]+', 32, 0)}
  UNION ALL {_found('mixed', 4, '[A-Za-z0-9_-]{24,}', 24, 0, " AND regexp_matches(value, '[0-9].*[0-9].*[0-9]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]')")}),
held AS (SELECT value, count(DISTINCT owner) AS n FROM m GROUP BY value),
v AS (SELECT m.*, n <= 3 AS live FROM m JOIN held USING (value)),
s AS (
  SELECT * FROM v WHERE kind <> 'mixed'
  UNION ALL
  SELECT * FROM v a WHERE kind = 'mixed' AND live AND NOT EXISTS (
    SELECT 1 FROM v b WHERE b.kind <> 'mixed' AND b.k = a.k AND a.start < b."end" AND b.start < a."end")),
g AS (
  SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT), ',' ORDER BY start, rank) FILTER (kind <> 'mixed') AS base,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT), ',' ORDER BY start, rank) AS spans
  FROM s GROUP BY k)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       CAST(coalesce(n_live, 0) AS BIGINT) AS n_live, CAST(coalesce(n_copied, 0) AS BIGINT) AS n_copied
FROM d LEFT JOIN g USING (k)
"""

_WORDS = rf"""regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, unnest({_WORDS}) AS t FROM documents WHERE text IS NOT NULL),
n AS (SELECT k, doc_id, count(*) AS n FROM d GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
b AS (SELECT i, item_id, t, count(*) AS c FROM (
  SELECT i, item_id, unnest({_WORDS}) AS t FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark WHERE text IS NOT NULL)) GROUP BY ALL),
tf AS (SELECT k, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM b) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY t, docs),
impact AS (
  SELECT k, doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)) AS impact
  FROM tf JOIN n USING (k), total),
s AS (SELECT i, item_id, k, doc_id, CAST(sum(c * w * impact) AS BIGINT) AS score FROM b JOIN w USING (t) JOIN impact USING (t) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""

#: CRC-32 of a word's bytes, bit by bit: a byte is fed where its eight steps begin.
_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(generate_series(0, strlen(f) - 1),
    lambda i: [('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)))"""

RESAMPLE = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
fd AS (SELECT k, unnest(w) AS f FROM d),
fb AS (SELECT unnest({_WORDS}) AS f FROM benchmark),
crc AS (SELECT f, xor({_CRC}, 4294967295) % 10000 AS bucket FROM (SELECT f FROM fd UNION SELECT f FROM fb)),
s AS (SELECT bucket, count(*) AS s FROM fd JOIN crc USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM fb JOIN crc USING (f) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM fd) AS ss, (SELECT count(*) FROM fb) AS tt),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000)) / ((s + 1)::DOUBLE * (tt + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), sums),
weight AS (SELECT k, CAST(sum(gain) AS BIGINT) AS weight FROM fd JOIN crc USING (f) JOIN gain USING (bucket) GROUP BY k),
scored AS (
  SELECT k, doc_id, len(w) AS n, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weight USING (k)),
ranked AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n) AS r FROM scored WHERE n >= 20)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, weight, score,
       CASE WHEN r <= (10 * (SELECT count(*) FROM ranked)) // 100 THEN CAST(r AS BIGINT) END AS rank
FROM scored LEFT JOIN ranked USING (k)
"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


_PHRASES = licenses.phrases_of()

LICENSES = rf"""
WITH phrase(p, n, label) AS (VALUES {_values((i, len(x.split()), dict(licenses.BASE).get(x, '')) for i, x in enumerate(_PHRASES))}),
phrase_word(p, place, word) AS (VALUES {_values((i, j, w) for i, x in enumerate(_PHRASES) for j, w in enumerate(x.split()))}),
template(m, label) AS (VALUES {_values((i, x[0]) for i, x in enumerate(licenses.TEMPLATES))}),
template_word(m, place, word) AS (VALUES {_values((i, j, w) for i, x in enumerate(licenses.TEMPLATES) for j, w in enumerate(x[1].split()))}),
mandatory(m, p) AS (VALUES {_values((i, _PHRASES.index(p)) for i, x in enumerate(licenses.TEMPLATES) for p in x[2])}),
d AS (SELECT row_number() OVER () AS k, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
spot AS (SELECT k, unnest(w) AS word, unnest(generate_series(0, len(w) - 1)) AS pos FROM d),
met AS (
  SELECT k, p, start FROM (SELECT k, p, pos - place AS start, count(*) AS c FROM spot JOIN phrase_word USING (word) GROUP BY ALL) JOIN phrase USING (p)
  WHERE c = n),
based AS (
  SELECT k, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM met JOIN phrase USING (p) WHERE label <> '' GROUP BY k),
idf AS (
  SELECT word, CAST(floor(1000 * ln(((SELECT count(*) FROM d WHERE len(w) > 0) + 1)::DOUBLE / (count(DISTINCT k) + 1))) AS BIGINT) + 1 AS idf
  FROM spot WHERE word IN (SELECT word FROM template_word) GROUP BY word),
by_word AS (SELECT DISTINCT m, word, coalesce(idf, 0) AS idf FROM template_word LEFT JOIN idf USING (word)),
whole AS (
  SELECT m, sum(idf) AS whole FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY idf DESC, word) AS r FROM by_word) WHERE r <= {licenses.LOOKED_UP} GROUP BY m),
looked AS (
  SELECT k, m, word, idf FROM (
    SELECT *, row_number() OVER (PARTITION BY k, m ORDER BY idf DESC, word) AS r FROM (SELECT DISTINCT k, word FROM spot) JOIN by_word USING (word))
  WHERE r <= {licenses.LOOKED_UP}),
stands AS (
  SELECT k, m, pos - place AS start, word, any_value(idf) AS idf
  FROM spot JOIN looked USING (k, word) JOIN template_word USING (m, word) GROUP BY ALL),
best AS (
  SELECT k, m, max(idf) AS idf FROM (SELECT k, m, start, sum(idf) AS idf, count(*) AS n FROM stands GROUP BY ALL) WHERE n >= {licenses.LEAST_WORDS} GROUP BY ALL),
share AS (SELECT k, m, least(1.0::DOUBLE, idf::DOUBLE / whole::DOUBLE) AS share FROM best JOIN whole USING (m) WHERE whole > 0),
found AS (
  SELECT k, m, share FROM share WHERE share * 100 >= {licenses.LEAST_SHARE}
  AND NOT EXISTS (SELECT 1 FROM mandatory WHERE mandatory.m = share.m AND NOT EXISTS (SELECT 1 FROM met WHERE met.k = share.k AND met.p = mandatory.p))),
scored AS (SELECT k, max(share) AS score FROM found GROUP BY k),
named AS (
  SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
    SELECT k, label FROM found JOIN template USING (m) UNION ALL SELECT k, label FROM met JOIN phrase USING (p) WHERE label <> '') GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN based USING (k) LEFT JOIN named USING (k) LEFT JOIN scored USING (k)
"""
