"""SQL for the queries that DuckDB can express; the others are tested against brute force."""

from __future__ import annotations

from . import mixing

#: Pairs by a join on shingles, components by closure. Fit for the sizes the comparison runs at.
_COMPONENTS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 2, 2))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
links AS (
  SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL)
  JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= @needed * (nx.n + ny.n - c)),
reach AS (SELECT x, x AS r FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.r)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id@more
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT x, min(r) AS component_id FROM reach GROUP BY 1) c ON c.x = d.doc_id
"""
NEAR_DUPLICATES = _COMPONENTS.replace("@needed", "80").replace("@more", ", coalesce(c.component_id, d.doc_id) = d.doc_id AS kept")
JACCARD_JOIN = _COMPONENTS.replace("@needed", "85").replace("@more", "")

#: One level of the reduction tree, which is all there is while no source has more documents than a chunk.
MIX = rf"""
WITH RECURSIVE sz AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
w AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, {mixing.CAP} * source_size AS lim FROM (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sz GROUP BY 1)),
r AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(lim) OVER before, 0) AS DOUBLE) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS rate,
    row_number() OVER (ORDER BY CAST(lim AS DOUBLE) / weight, place) AS turn
  FROM w WINDOW before AS (ORDER BY CAST(lim AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, round(least(CAST(lim AS DOUBLE), coalesce((SELECT arg_min(rate, turn) FROM r WHERE rate * weight <= lim), 0) * weight), 6) AS target FROM r),
d AS (
  SELECT *, share - whole AS p FROM (SELECT *, floor(share) AS whole FROM (
    SELECT sz.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS share FROM sz JOIN t ON t.source IS NOT DISTINCT FROM sz.source))),
it AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY u, doc_id) AS k, count(*) OVER (PARTITION BY source) AS n FROM (
    SELECT *, CAST(CAST('0x' || substr(md5('{mixing.SEED}:0:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || size), 1, 12) AS UBIGINT) AS DOUBLE) / 281474976710656.0 AS u
    FROM d WHERE size > 0 AND p > 1e-12)),
fold AS (
  SELECT source, k, n, u, doc_id, size, p, CAST(NULL AS BIGINT) AS done, CAST(NULL AS DOUBLE) AS done_p FROM it WHERE k = 1
  UNION ALL
  SELECT source, k, n, bu, CASE WHEN a_done THEN b ELSE a END, CASE WHEN a_done THEN sb ELSE sa END,
    CASE WHEN a_done THEN greatest(0.0, least(1.0, CASE WHEN rise THEN pb - up * sa / sb ELSE pb + down * sa / sb END)) ELSE greatest(0.0, least(1.0, CASE WHEN rise THEN pa + up ELSE pa - down END)) END,
    CASE WHEN a_done THEN a ELSE b END, CASE WHEN a_done = rise THEN 1.0 ELSE 0.0 END
  FROM (SELECT *, CASE WHEN rise THEN up = 1 - pa ELSE down = pa END AS a_done FROM (SELECT *, au * (up + down) < down AS rise FROM (
    SELECT f.source, i.k, i.n, f.u AS au, i.u AS bu, f.doc_id AS a, i.doc_id AS b, CAST(f.size AS DOUBLE) AS sa, CAST(i.size AS DOUBLE) AS sb, f.p AS pa, i.p AS pb,
      least(1 - f.p, i.p * i.size / f.size) AS up, least(f.p, (1 - i.p) * i.size / f.size) AS down
    FROM fold f JOIN it i ON i.source IS NOT DISTINCT FROM f.source AND i.k = f.k + 1)))),
settled AS (SELECT done AS doc_id, done_p AS p FROM fold WHERE done IS NOT NULL UNION ALL SELECT doc_id, CASE WHEN p >= 0.5 THEN 1.0 ELSE 0.0 END FROM fold WHERE k = n)
SELECT d.doc_id, d.size, d.source_size, d.target, CAST(d.size * c AS BIGINT) AS taken, CAST(c AS BIGINT) AS copies FROM (
  SELECT d.*, CASE WHEN d.size = 0 THEN 1 ELSE whole + CASE WHEN s.p >= 0.5 THEN 1 ELSE 0 END END AS c FROM d LEFT JOIN settled s ON s.doc_id = d.doc_id) d
"""

#: Units as lists, cut and put together by name.
FILL_IN_MIDDLE = r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
h AS (SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS UBIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS UBIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS UBIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS UBIGINT) AS h4 FROM u),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
  CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS a, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS b FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
