"""DuckDB SQL for the operators that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(ws) - 3, 2)),
        lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 85 * (na.n_shingles + nb.n_shingles - c)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT a, b FROM g UNION SELECT r.doc_id, g.b FROM r JOIN g ON g.a = r.other)
SELECT n.doc_id, n.n_shingles, least(n.doc_id, coalesce(m.lo, n.doc_id)) AS component_id,
       least(n.doc_id, coalesce(m.lo, n.doc_id)) = n.doc_id AS kept
FROM n LEFT JOIN (SELECT doc_id, min(other) AS lo FROM r GROUP BY 1) m USING (doc_id)
"""

_OP7 = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
t AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM w),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM t),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE c >= 2) GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
d AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
       CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
       CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines
  FROM w LEFT JOIN d USING (doc_id) LEFT JOIN r USING (doc_id)
  LEFT JOIN (SELECT doc_id, count(*) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1) l USING (doc_id)),
b AS (SELECT *, n_words < 50 AS r0, 100 * n_repeat_words > 50 * n_words AS r1, word_chars < 3 * n_words AS r2,
       word_chars > 12 * n_words AS r3, 10 * n_symbols > n_words AS r4, 2 * n_dup_lines > n_lines AS r5 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
       CAST(r0 AS BIGINT) + 2 * CAST(r1 AS BIGINT) + 4 * CAST(r2 AS BIGINT) + 8 * CAST(r3 AS BIGINT)
         + 16 * CAST(r4 AS BIGINT) + 32 * CAST(r5 AS BIGINT) AS failed_rules,
       r0 OR r1 AS base_failed, NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5) AS kept
FROM b
"""

_OP8 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h FROM p),
g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h, n) ELSE page_id END AS top FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM g
"""

_OP9 = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
v AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
f AS (SELECT h, min(doc_id) AS lo FROM v GROUP BY 1),
s AS (SELECT doc_id, list(i ORDER BY i) AS starts FROM v JOIN f USING (h) WHERE lo < doc_id GROUP BY 1),
c AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j
      FROM (SELECT doc_id, unnest(starts) AS i FROM s)) GROUP BY 1),
k AS (SELECT w.doc_id, i, ws[i] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) w),
x AS (SELECT k.doc_id, count(*) AS n, sha256(string_agg(word, ' ' ORDER BY k.i)) AS h FROM k
      LEFT JOIN (SELECT doc_id, unnest(gone) AS i, true AS out FROM c) g ON g.doc_id = k.doc_id AND g.i = k.i
      WHERE g.out IS NULL GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(x.n, 0) AS BIGINT) AS n_removed,
       coalesce(x.h, sha256('')) AS kept_sha256
FROM w LEFT JOIN x USING (doc_id)
"""

_OP12 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
d AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS one, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS two,
       CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
              OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
            WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
c AS (SELECT *, least(one, two) AS a, greatest(one, two) AS b FROM d),
p AS (SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

QUERIES = {"op1_minhash": _OP1, "op7_quality_rules": _OP7, "op8_warc": _OP8, "op9_substring_dedup": _OP9, "op12_infill": _OP12}
