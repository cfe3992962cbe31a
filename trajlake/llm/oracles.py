"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE32 = " || ".join(f"substr('{_UPPER}234567', CAST((v[{i}] >> {s}) & 31 AS INTEGER) + 1, 1)" for i in range(1, 9) for s in (15, 10, 5, 0))

WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
v AS (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS first, [CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT) FOR i IN range(0, 8)] AS v FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM v"""

NEAR = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
near AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, near.b FROM reach JOIN near ON reach.r = near.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM s JOIN reach USING (doc_id) GROUP BY doc_id, s"""

REPEATS = rf"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
p AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM d)),
hit AS (SELECT doc_id, i FROM p WHERE k IN (SELECT k FROM p GROUP BY k HAVING count(*) > 1)),
isle AS (SELECT doc_id, i, sum(CASE WHEN i - before > 400 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit)),
span AS (SELECT doc_id, g, min(i) AS a, max(i) + 400 AS b FROM isle GROUP BY doc_id, g),
cut AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS beg FROM span),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * beg + 1, 2 * (a - beg)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h, sum(b - a) AS removed, count(*) AS spans FROM cut JOIN d USING (doc_id) GROUP BY doc_id),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
q AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 50], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 49)) AS i FROM w)),
found AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM q WHERE k IN (SELECT k FROM q GROUP BY k HAVING count(DISTINCT doc_id) > 1)),
passages AS (SELECT doc_id, count_if(before IS NULL OR i - before > 51) AS n_passages FROM found GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256, CAST(coalesce(n_passages, 0) AS BIGINT) AS n_passages FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN passages USING (doc_id)"""

_KINDS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))"""),
    ("access", "AKIA[A-Z0-9]{16,}"),
    ("hex", "[0-9a-f]{24,}"),
    ("token", "[A-Za-z0-9+/_=-]{20,}"),
]
_FOUND = " UNION ALL ".join(
    f"SELECT doc_id, source, {k} AS kind, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS s, {f'''regexp_extract_all(t, '{p}', 2)''' if k == 0 else f'''regexp_extract_all(t, '{p}')'''} AS v FROM d"
    for k, (_, p) in enumerate(_KINDS)
)
SECRETS = f"""WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents), f AS ({_FOUND}),
e AS (SELECT doc_id, source, kind, i, length(s[i]) AS skipped, length(m[i]) AS size, v[i] AS v FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM f WHERE len(m) > 0)),
q AS (SELECT *, CAST(sum(skipped + size) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop FROM e),
c AS (SELECT *, stop - size AS start FROM q WHERE CASE kind WHEN 0 THEN length(v) >= 6 WHEN 3 THEN regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]') ELSE true END),
o AS (SELECT v, count(DISTINCT source) AS owners FROM c GROUP BY v),
j AS (SELECT c.*, owners, kind < 3 OR (owners <= 1 AND NOT EXISTS (SELECT 1 FROM c b WHERE b.doc_id = c.doc_id AND b.kind < 3 AND b.start < c.stop AND b.stop > c.start)) AS kept FROM c JOIN o USING (v)),
x AS (SELECT *, ['assign', 'access', 'hex', 'token'][kind + 1] || ':' || start || ':' || stop AS span FROM j WHERE kept),
g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
  string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans,
  count(*) FILTER (WHERE kind < 3 AND owners <= 1) AS n_owned, count(*) FILTER (WHERE kind < 3 AND owners >= 3) AS n_copied FROM x GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_owned, 0) AS n_owned, coalesce(n_copied, 0) AS n_copied FROM d LEFT JOIN g USING (doc_id)"""
