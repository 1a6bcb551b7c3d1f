"""Independent DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP7 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, list_slice(ws, i, i + 4) AS five
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, i + unnest([0, 1, 2, 3, 4]) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS caps,
         len(list_filter(generate_series(2, len(ws)), lambda i: ws[i] = ws[i - 1])) AS stutter
  FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines
            OR 10 * caps > 6 * word_chars OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * stutter > n_words) AS kept
FROM b
"""

OP1 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN ws ELSE list_slice(ws, i, i + 4) END AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
          FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
      WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles,
       least(d.doc_id, coalesce(min(reach.y), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id
"""


def _beta_level(name: str, keys: str, parent: str, on: str) -> str:
    """CTEs of one shrinkage level: prior from the parent, strength by moments, posterior."""
    return f"""
{name}_n AS (SELECT {keys}, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY {keys}),
{name}_p AS (SELECT c.*, p.mean AS prior FROM {name}_n c JOIN {parent} p USING ({on})),
{name}_s AS (
  SELECT CASE WHEN count(*) = 0 OR sum(n) <= count(*) THEN 1.0
         ELSE 1 / least(0.99, greatest(0.0001,
              (sum(n * pow(bad / n - prior, 2) / (prior * (1 - prior))) - count(*)) / (sum(n) - count(*)))) - 1 END AS k
  FROM {name}_p WHERE n > 0),
{name} AS (
  SELECT t.*, prior * k + bad AS a, (1 - prior) * k + n - bad AS b,
         (prior * k + bad) / (k + n) AS mean FROM {name}_p t, {name}_s)"""


OP4 = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
lab AS (SELECT doc_id AS page_id, max((quality = 0)::INT) AS bad FROM labels
        WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
hosts AS (
  SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix,
         count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad
  FROM p LEFT JOIN lab USING (page_id) GROUP BY ALL),
root AS (SELECT DISTINCT suffix, (SELECT (sum(bad) + 0.5) / (sum(n) + 1) FROM hosts) AS mean FROM hosts),""" \
    + _beta_level("sfx", "suffix", "root", "suffix") + "," \
    + _beta_level("dom", "suffix, domain", "sfx", "suffix") + "," \
    + _beta_level("hst", "domain, host", "dom", "domain") + r""",
verdicts AS (SELECT host, mean - 1.645 * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))) > 0.3 AS blocked FROM hst),
rules(h, pre, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (
  SELECT page_id, arg_max(h || pre, length(h || pre)) AS rule, arg_max(v, length(h || pre)) AS v
  FROM p JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(v, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN verdicts USING (host) LEFT JOIN fit USING (page_id)
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
win AS (SELECT doc_id, i, list_slice(ws, i, i + 34) AS g
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY g) > 1),
cut AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, i + unnest(generate_series(0, 34)) AS p FROM twice)),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM d) w
  LEFT JOIN cut ON cut.doc_id = w.doc_id AND cut.p = w.p WHERE cut.p IS NULL GROUP BY w.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = """
WITH good AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id % 100 = 0 AND q.r <> c.r)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

OP10 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP11 = r"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(generate_series(0, len(ls) - 1)) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, coalesce(k.doc_id <> keeper, false) AS gone FROM k LEFT JOIN often USING (key)),
runs AS (
  SELECT doc_id, string_agg(start || '+' || n, ' ' ORDER BY start) AS keep
  FROM (SELECT doc_id, min(pos) AS start, count(*) AS n
        FROM (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM j WHERE NOT gone)
        GROUP BY doc_id, island) GROUP BY doc_id)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256,
       coalesce(any_value(keep), '') AS keep
FROM j LEFT JOIN runs USING (doc_id) GROUP BY doc_id
"""

ORACLE: dict[str, str] = {
    "op11_line_dedup": OP11,
    "op1_jaccard_join": OP1,
    "op4_url_reputation": OP4,
    "op9_exact_topk": OP9,
    "op10_warc": OP10,
    "op5_substring_dedup": OP5,
    "op7_quality_rules": OP7,
}
