"""DuckDB SQL for the queries of this package that SQL can express.

Written from the contracts with plain joins, windows and recursion, not from
the Spark plans. Classifiers, tokenisers and keyed surrogates have none.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Smallest id that each id reaches over the relation links(a, b), both ways.
REACH = """
reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"""

JACCARD = rf"""
WITH RECURSIVE split AS (SELECT doc_id, {WORDS} AS ws FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM split WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n, string_agg(g, '|' ORDER BY g) AS all_grams FROM grams GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT s.a, s.b FROM shared s JOIN sizes p ON p.doc_id = s.a JOIN sizes q ON q.doc_id = s.b
          WHERE 5 * s.n >= 4 * (p.n + q.n - s.n)),
{REACH},
components AS (SELECT a, min(b) AS component FROM reach GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a),
classes AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY all_grams) AS class_id FROM sizes)
SELECT d.doc_id, coalesce(k.class_id, d.doc_id) AS class_id, coalesce(g.n, 0) AS n_links,
       least(coalesce(c.component, d.doc_id), d.doc_id) AS component_id,
       d.doc_id = least(coalesce(c.component, d.doc_id), d.doc_id) AS kept
FROM documents d LEFT JOIN classes k ON k.doc_id = d.doc_id LEFT JOIN degrees g ON g.a = d.doc_id
LEFT JOIN components c ON c.a = d.doc_id"""

REPETITION = rf"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
grams AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM split CROSS JOIN (VALUES (5), (6), (8), (10)) AS k(n) WHERE len(ws) >= n)),
again AS (SELECT doc_id, n, i FROM (SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, g) AS c FROM grams) WHERE c > 1),
inside AS (SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS p FROM again),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS w FROM split),
cover AS (SELECT s.doc_id, s.n, count(*) AS n_inside, sum(length(w.w)) AS chars
          FROM inside s JOIN words w ON w.doc_id = s.doc_id AND w.p = s.p GROUP BY 1, 2),
lines AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS p, unnest(ls) AS line FROM (SELECT doc_id, string_split(t, chr(10)) AS ls FROM split)),
repeats AS (
  SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS chars
  FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY p) AS k FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) WHERE k > 1 GROUP BY doc_id),
totals AS (SELECT doc_id, sum(length(w)) AS chars FROM words GROUP BY doc_id),
facts AS (
  SELECT s.doc_id, CAST(len(s.ws) AS BIGINT) AS n_words, CAST(coalesce(t.chars, 0) AS BIGINT) AS word_chars,
         CAST(length(s.t) - length(regexp_replace(s.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c8.n_inside, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(r.chars, 0) AS BIGINT) AS dup_line_chars, CAST(coalesce(c5.chars, 0) AS BIGINT) AS dup_5gram_chars,
         CAST(coalesce(c6.chars, 0) AS BIGINT) AS dup_6gram_chars, CAST(coalesce(c8.chars, 0) AS BIGINT) AS dup_8gram_chars,
         CAST(coalesce(c10.chars, 0) AS BIGINT) AS dup_10gram_chars
  FROM split s LEFT JOIN totals t ON t.doc_id = s.doc_id LEFT JOIN repeats r ON r.doc_id = s.doc_id
  LEFT JOIN cover c5 ON c5.doc_id = s.doc_id AND c5.n = 5 LEFT JOIN cover c6 ON c6.doc_id = s.doc_id AND c6.n = 6
  LEFT JOIN cover c8 ON c8.doc_id = s.doc_id AND c8.n = 8 LEFT JOIN cover c10 ON c10.doc_id = s.doc_id AND c10.n = 10),
based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM facts)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= 18 * word_chars AND 100 * dup_5gram_chars <= 32 * word_chars
       AND 100 * dup_6gram_chars <= 30 * word_chars AND 100 * dup_8gram_chars <= 28 * word_chars
       AND 100 * dup_10gram_chars <= 20 * word_chars AS kept
FROM based"""

_REST = "regexp_replace({u}, '^(?s:.*?)://', '')"


def _host(u: str) -> str:
    return (f"CASE WHEN {u} IS NULL OR instr({u}, '://') = 0 THEN '' ELSE translate(regexp_extract({_REST.format(u=u)}, '^[^/?#]*', 0), "
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END")


def _path(u: str) -> str:
    return f"CASE WHEN {u} IS NULL OR instr({u}, '://') = 0 THEN '' ELSE regexp_extract({_REST.format(u=u)}, '^[^/?#]*([^?#]*)', 1) END"


def _address(u: str) -> str:
    query = f"regexp_extract({_REST.format(u=u)}, '^[^?#]*(\\?[^#]*)?', 1)"
    return (f"CASE WHEN {_host(u)} <> '' THEN ({_host(u)}) || (CASE WHEN ({_path(u)}) = '' THEN '/' ELSE ({_path(u)}) END) || coalesce({query}, '') END")


REDIRECTS = rf"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                     ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages
         WHERE url IS NOT NULL AND regexp_matches(html, '(?is)<(?:link\b[^>]*canonical|meta\b[^>]*refresh)')),
named AS (
  SELECT url, replace(CASE
    WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?[^"''>]*\bcanonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?\s*refresh\b') THEN regexp_extract(tag, '(?is);\s*url\s*=\s*["'']?\s*([^"''\s>]+)', 1)
    END, '&amp;', '&') AS link FROM tags),
based AS (SELECT url, link, regexp_extract(url, '^((?s:.*?))://', 1) AS scheme, {_host('url')} AS host, {_path('url')} AS path FROM named WHERE link IS NOT NULL AND link <> ''),
edges AS (
  SELECT url, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link WHEN link LIKE '//%' THEN scheme || ':' || link
    WHEN link LIKE '/%' THEN scheme || '://' || host || link WHEN regexp_matches(link, '^[?#]') THEN scheme || '://' || host || path || link
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE scheme || '://' || host || '/' || regexp_replace(regexp_replace(path, '[^/]*$', ''), '^/', '') || link END AS target FROM based),
ends AS (SELECT DISTINCT {_address('url')} AS s, {_address('target')} AS t FROM edges WHERE target IS NOT NULL),
links AS (SELECT s AS a, t AS b FROM ends WHERE s <> t UNION SELECT t, s FROM ends WHERE s <> t),
{REACH},
-- Every rule that fits an address that some address reaches.
fitting AS (SELECT r.a, r.b, u.verdict, u.h || u.p AS rule, row_number() OVER (PARTITION BY r.a, r.b ORDER BY length(u.h || u.p) DESC, u.verdict) AS k
            FROM reach r JOIN rules u ON (split_part(r.b, '/', 1) = u.h OR split_part(r.b, '/', 1) LIKE '%.' || u.h)
            AND starts_with(regexp_extract(r.b, '^[^/]*([^?]*)', 1), u.p)),
grouped AS (SELECT a, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' ELSE 'block' END AS verdict FROM fitting WHERE k = 1 GROUP BY a),
judged AS (SELECT page_id, {_host('url')} AS host, {_path('url')} AS path, {_address('url')} AS address,
                  row_number() OVER () AS row_id FROM pages),
own AS (SELECT j.row_id, u.verdict, u.h || u.p AS rule, row_number() OVER (PARTITION BY j.row_id ORDER BY length(u.h || u.p) DESC, u.verdict) AS k
        FROM judged j JOIN rules u ON (j.host = u.h OR j.host LIKE '%.' || u.h) AND starts_with(j.path, u.p))
SELECT j.page_id, j.host, j.path, o.rule, coalesce(o.verdict, g.verdict, 'allow') AS verdict
FROM judged j LEFT JOIN own o ON o.row_id = j.row_id AND o.k = 1 LEFT JOIN grouped g ON g.a = j.address"""

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
         md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), '') || '-' || md5(coalesce(text, ''))) AS k FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM sized GROUP BY source),
weighted AS (SELECT *, CASE sid % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, CAST(2 * source_size AS DOUBLE) AS cap FROM sources),
levels AS (
  SELECT *, cap / weight AS ratio,
         (CAST(1.5 AS DOUBLE) * (SELECT sum(source_size) FROM sources)
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
first_level AS (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, sid LIMIT 1),
targets AS (SELECT sid, source, source_size, least(cap, weight * coalesce((SELECT level FROM first_level), 0)) AS target FROM weighted),
placed AS (
  SELECT row_number() OVER () AS row_id, t.sid, s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
         least(CAST(round(t.target) AS BIGINT), 2 * t.source_size) AS goal
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
goals AS (SELECT sid, source_size, least(CAST(round(target) AS BIGINT), 2 * source_size) AS goal FROM targets WHERE source_size > 0),
needs AS (SELECT *, (source_size + 1023) // 1024 AS blocks, goal % source_size AS rest,
                 goal // source_size * ((source_size + 1023) // 1024) + (goal % source_size + 1023) // 1024 AS need FROM goals),
upto AS (SELECT *, CAST(sum(need) OVER (ORDER BY sid) AS BIGINT) AS high, (SELECT CAST(sum(need) AS BIGINT) FROM needs) AS total FROM needs WHERE need > 0),
shares AS (SELECT *, CAST(high - need AS DOUBLE) / CAST(total AS DOUBLE) AS lo, CASE WHEN high = total THEN 1.0::DOUBLE ELSE CAST(high AS DOUBLE) / CAST(total AS DOUBLE) END AS hi FROM upto),
points AS (SELECT slot, x - floor(x) AS u FROM (
  SELECT slot, (CAST(slot AS DOUBLE) + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE AS x
  FROM (SELECT unnest(range(0, coalesce((SELECT max(total) FROM shares), 0))) AS slot))),
drawn AS (SELECT p.slot, h.sid, row_number() OVER (PARTITION BY h.sid ORDER BY p.slot) - 1 AS rank FROM points p JOIN shares h ON p.u >= h.lo AND p.u < h.hi),
missed AS (SELECT h.sid, unnest(range(coalesce(g.n, 0), h.need)) AS rank FROM shares h LEFT JOIN (SELECT sid, count(*) AS n FROM drawn GROUP BY sid) g ON g.sid = h.sid),
turns AS (SELECT slot, sid, rank FROM drawn
          UNION ALL SELECT (SELECT max(total) FROM shares) + row_number() OVER (ORDER BY rank, sid) - 1, sid, rank FROM missed),
slots AS (SELECT t.slot, t.sid, t.rank % h.blocks AS block,
                 CASE WHEN t.rank = h.need - 1 AND h.rest > 0 THEN h.rest - (h.rest - 1) // 1024 * 1024 ELSE 1024 END AS use
          FROM turns t JOIN shares h ON h.sid = t.sid WHERE t.rank < h.need),
gives AS (SELECT d.row_id, s.slot, least(d.pos + d.size, s.block * 1024 + s.use) - greatest(d.pos, s.block * 1024) AS words
          FROM placed d JOIN slots s ON s.sid = d.sid AND s.block BETWEEN d.pos // 1024 AND (d.pos + d.size - 1) // 1024 WHERE d.size > 0),
mixed AS (SELECT row_id, sum(words) AS taken, min(slot) AS first_slot, count(*) AS n_slots FROM gives WHERE words > 0 GROUP BY row_id)
SELECT d.doc_id, d.size, d.source_size, d.target, CAST(coalesce(m.taken, 0) AS BIGINT) AS taken,
       CAST(m.first_slot AS BIGINT) AS first_slot, CAST(coalesce(m.n_slots, 0) AS BIGINT) AS n_slots
FROM placed d LEFT JOIN mixed m ON m.row_id = d.row_id"""

VECTORS = f"""
WITH RECURSIVE clean AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM clean x JOIN clean y ON x.vec_id <> y.vec_id
          WHERE x.norm > 0 AND y.norm > 0 AND list_cosine_similarity(x.e, y.e) >= 0.9),
{REACH},
components AS (SELECT a, min(b) AS component FROM reach GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, least(coalesce(c.component, v.vec_id), v.vec_id) AS component_id,
       v.vec_id = least(coalesce(c.component, v.vec_id), v.vec_id) AS kept
FROM embeddings v LEFT JOIN degrees d ON d.a = v.vec_id LEFT JOIN components c ON c.a = v.vec_id"""

def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit (reflected polynomial 0xEDB88320)."""
    eight = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))), "
            f"lambda c, b: {eight}), 4294967295)")


PERIODIC = rf"""
WITH split AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws, CAST(doc_id AS VARCHAR) AS t FROM documents),
hashed AS (SELECT *, CAST(len(ws) AS BIGINT) AS n, CASE WHEN t IS NULL THEN 1 ELSE {_crc32('t')} END AS h FROM split),
tailed AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a FROM hashed),
cut AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM tailed),
made AS (
  SELECT r, doc_id, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[1 + a + (i - a) % p] END) ELSE ws END AS ws FROM cut),
words AS (SELECT r, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM made),
-- A word that its text holds fewer than four times lies in no run.
often AS (SELECT r, i, w, i - row_number() OVER (PARTITION BY r ORDER BY i) AS s
          FROM (SELECT *, count(*) OVER (PARTITION BY r, w) AS c FROM words) WHERE c >= 4),
again AS (SELECT r, i, w, s, count(*) OVER (PARTITION BY r, s) AS m
          FROM (SELECT *, count(*) OVER (PARTITION BY r, s, w) AS c FROM often) WHERE c >= 4),
pairs AS (SELECT x.r, y.i - x.i AS q, x.i FROM again x JOIN again y ON x.r = y.r AND x.s = y.s AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.m),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS s FROM pairs),
stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, s),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
top AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY length DESC, start, period) AS k FROM runs),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT w.r, string_agg(w.w, ' ' ORDER BY w.i) AS text FROM words w ANTI JOIN dropped d ON d.r = w.r AND d.i = w.i GROUP BY w.r)
SELECT m.doc_id, coalesce(l.n_runs, 0) AS n_runs, CAST(t.start AS BIGINT) AS start, CAST(t.length AS BIGINT) AS length, CAST(t.period AS BIGINT) AS period,
       CAST(1000 * t.length // t.period AS BIGINT) AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256,
       sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM made m LEFT JOIN listed l ON l.r = m.r LEFT JOIN top t ON t.r = m.r AND t.k = 1 LEFT JOIN kept k ON k.r = m.r"""

ORACLES = {"op2_jaccard_join": JACCARD, "op3_repetition": REPETITION, "op6_redirects": REDIRECTS, "op7_mix": MIX, "op8_projections": VECTORS,
           "op11_periodic_runs": PERIODIC}
