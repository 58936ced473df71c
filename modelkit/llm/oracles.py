"""SQL statements for the queries that SQL can express."""

from __future__ import annotations

_ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_RULES = (
    ("assign", _ASSIGN, 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 0),
    ("prefixed", r"\b(gh[opsu]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})", 0, 0),
)


def _secret_rule(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT doc_id, n, '{kind}' AS kind, {rank} AS rank, b AS s, b + length(m) AS e FROM (
      SELECT doc_id, n, unnest(ms) AS m, unnest(vs) AS v, unnest(bs) AS b FROM (
        SELECT doc_id, n, ms, vs, list_transform(range(1, len(ms) + 1),
          lambda i: list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)) AS bs
        FROM (SELECT doc_id, n, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS vs,
                     regexp_split_to_array(t, '{pattern}') AS gs FROM d))) WHERE length(v) >= {least}"""


_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLES: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, {_WORDS}), []) AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s FROM w, unnest(range(1, len(ws) - 48)) t (i)),
firsts AS (SELECT s, min(doc_id) AS d FROM windows GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (s) WHERE d < doc_id),
kept AS (SELECT doc_id, string_agg(ws[p], ' ' ORDER BY p) AS text, count(*) AS n
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op5_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}), []) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3
    THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN ways e ON e.a = r.root)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY 1""",
    "op6_secret_scan": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS n, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_secret_rule(i, *rule) for i, rule in enumerate(_RULES))}),
told AS (SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank) AS spans,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank) FILTER (rank < 3) AS base FROM spans GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN told USING (n)""",
    "op10_warc_revisits": r"""
WITH p AS (SELECT page_id, url, html, md5(coalesce(html, '')) AS tag, 'day ' || (page_id // 24) AS modified,
  regexp_replace(trim(url), '#.*$', '') AS bare FROM pages),
k AS (SELECT *, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(?:\?(.*))?$' AS parts FROM p),
q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(?:\?(.*))?$', 4), '&'),
  lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)='))) AS kept FROM k),
c AS (SELECT *, CASE WHEN regexp_matches(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(?:\?(.*))?$') THEN
  regexp_replace(lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)), '^https$', 'http') || '://'
  || regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)', 2)), '^([^@]*@)?(www\.)?', ''), ':(80|443)$', '')
  || regexp_replace(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)', 3), '/+$', '')
  || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END ELSE bare END AS canonical FROM q),
caps AS (
  SELECT page_id * 8 AS capture_id, canonical, page_id * 3600 AS ts, 200 AS status, tag AS etag, modified, html AS body,
    NULL AS ask, 'content-length=' || length(html) AS size FROM c
  UNION ALL SELECT page_id * 8 + 1, canonical, page_id * 3600 + 86400, 304, tag, NULL, NULL, 'v1', NULL FROM c
  UNION ALL SELECT page_id * 8 + 2, canonical, page_id * 3600 + 40 * 86400, 304, NULL, modified, NULL, 'v2', NULL FROM c
  UNION ALL SELECT page_id * 8 + 3, canonical, page_id * 3600 + 43200, 304, md5(tag || 'x'), NULL, NULL, 'v3', NULL FROM c WHERE page_id % 3 = 0
  UNION ALL SELECT page_id * 8 + 4, canonical, page_id * 3600 - 3600, 304, NULL, NULL, NULL, 'v4', NULL FROM c WHERE page_id % 5 = 0),
latest AS (SELECT r.capture_id, max((f.ts, f.capture_id)) AS m FROM caps r JOIN caps f
  ON f.canonical = r.canonical AND f.status = 200 AND (f.ts, f.capture_id) < (r.ts, r.capture_id) WHERE r.status = 304 GROUP BY 1),
j AS (SELECT r.*, f.capture_id AS fid, f.etag AS fetag, f.modified AS fmod, f.body AS fbody, f.size AS fsize,
  CASE WHEN r.status = 200 THEN 'full' WHEN f.capture_id IS NULL THEN 'orphan'
    WHEN (r.etag IS NOT NULL AND r.etag = f.etag) OR (r.etag IS NULL AND (r.modified IS NULL OR r.modified = f.modified)) THEN 'resolved'
    ELSE 'changed' END AS outcome
  FROM caps r LEFT JOIN latest l USING (capture_id) LEFT JOIN caps f ON f.capture_id = l.m[2])
SELECT capture_id, canonical, ts, status::BIGINT AS status,
  CASE outcome WHEN 'full' THEN capture_id WHEN 'resolved' THEN fid END AS source_id, outcome,
  CASE WHEN outcome = 'full' THEN size || ';content-type=text/html;date=first;etag=' || etag || ';last-modified=' || modified
    WHEN outcome = 'resolved' THEN fsize || ';content-type=text/html;date=' || CASE ask WHEN 'v1' THEN 'second' WHEN 'v4' THEN 'before' ELSE 'first' END
      || ';etag=' || CASE WHEN ask = 'v1' THEN 'W/' || etag ELSE fetag END || CASE WHEN ask = 'v2' THEN ';expires=later' ELSE '' END || ';last-modified=' || fmod
    WHEN ask = 'v1' THEN 'content-length=0;date=second;etag=W/' || etag
    WHEN ask = 'v2' THEN 'expires=later;last-modified=' || modified
    WHEN ask = 'v3' THEN 'etag=' || etag ELSE 'date=before' END AS headers,
  sha256(CASE outcome WHEN 'full' THEN body WHEN 'resolved' THEN fbody END) AS body_sha256 FROM j""",
}

# Alternatives of the pattern that cuts texts into units for the fill-in-the-middle query.
_UNITS = r"'[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'"
_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"


def _terms(table: str, key: str) -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, unnest(regexp_extract_all({lower}, {_TERMS})) AS term FROM {table}"


def _draw(i: int) -> str:
    return f"CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), {8 * i + 1}, 8) AS UBIGINT) AS h{i + 1}"


ORACLES["op11_ranked_search"] = f"""
WITH d AS ({_terms("documents", "doc_id")}), tfs AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf) AS n FROM tfs GROUP BY 1), total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
ms AS (SELECT doc_id, 75 + (25 * n::BIGINT * docs) // terms AS m FROM sizes, total),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, total GROUP BY 1),
q AS (SELECT item_id, term, count(*) AS times FROM ({_terms("benchmark", "item_id")}) GROUP BY ALL),
scored AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN weights USING (term) JOIN tfs USING (term) JOIN ms USING (doc_id) GROUP BY 1, 2),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= 20"""

ORACLES["op12_fill_in_middle"] = f"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_UNITS}) AS us, {", ".join(map(_draw, range(4)))} FROM documents),
cuts AS (SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b,
  CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
parts AS (SELECT *, array_to_string(us[1:a], '') AS p, array_to_string(us[a + 1:b], '') AS m, array_to_string(us[b + 1:], '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""
