"""DuckDB SQL of the queries that SQL can express, without the operators'
indexes: every row is compared with every rule, line, window or vector."""

from __future__ import annotations

from tessera.llm import line_quality, secret_links, url_rules

SPACE = r"[\x20\x09-\x0D]+"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lower_ascii(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e LEFT JOIN counts ON counts.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id
"""

OP3 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
first AS (SELECT k, min(doc_id) AS owner FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win JOIN first USING (k) WHERE owner < doc_id),
each AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM d),
kept AS (
  SELECT e.doc_id, string_agg(x, ' ' ORDER BY e.i) AS t FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i
  WHERE g.i IS NULL GROUP BY e.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def _op6() -> str:
    fits = "\n".join(
        f"  UNION ALL SELECT page_id, {_quoted(r)}, {_quoted(v)} FROM p WHERE (host = {_quoted(r.partition('/')[0])} OR "
        f"ends_with(host, {_quoted('.' + r.partition('/')[0])})) AND starts_with(path, {_quoted('/' + r.partition('/')[2])})"
        for v, r in url_rules.HOST_RULES)

    def hits(verdict: str) -> str:
        return " + ".join(["0", *(f"CAST(regexp_matches(u, {_quoted(url_rules.pattern_regex(p))}) AS INTEGER)"
                                  for v, p in url_rules.PATTERN_RULES if v == verdict)])

    return f"""
WITH p AS (
  SELECT page_id, {lower_ascii("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, {lower_ascii("coalesce(url, '')")} AS u
  FROM pages),
fits(page_id, rule, verdict) AS (
  SELECT NULL, NULL, NULL WHERE false
{fits}),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY page_id)
SELECT p.page_id, host, path, rule,
       coalesce(best.verdict, CASE WHEN ({hits('block')}) > 0 AND ({hits('allow')}) = 0 THEN 'block' ELSE 'allow' END) AS verdict,
       CAST({hits('block')} AS BIGINT) AS n_blocking
FROM p LEFT JOIN best USING (page_id)
"""


def _op7(scope: int = 300) -> str:
    word = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    patterns = dict(secret_links.PATTERNS)
    patterns["assign"] = patterns["assign"].replace("(?i:password|passwd|secret|token|api_?key)", word)
    checks = {"assign": f"length(regexp_extract(m, {_quoted(patterns['assign'])}, 2)) >= {secret_links.ASSIGN_VALUE}",
              "key": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')"}
    found = "\n  UNION ALL ".join(
        f"SELECT doc_id, {n} AS kind, unnest(range(1, len(ms) + 1)) AS k, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS g FROM "
        f"(SELECT doc_id, regexp_extract_all(t, {_quoted(patterns[k])}) AS ms, regexp_split_to_array(t, {_quoted(patterns[k])}) AS gaps FROM d) "
        f"WHERE len(ms) > 0" for n, k in enumerate(secret_links.KINDS))
    good = " ".join(f"WHEN {secret_links.KINDS.index(k)} THEN {c}" for k, c in checks.items())
    names = ", ".join(map(_quoted, secret_links.KINDS))
    role = {r: ", ".join(str(n) for n, k in enumerate(secret_links.KINDS) if secret_links.ROLE[k] == r) for r in ("identifier", "secret", "endpoint")}
    near = ",\n".join(
        f"coalesce(least(s - max(CASE WHEN kind IN ({x}) THEN e END) OVER b, min(CASE WHEN kind IN ({x}) THEN s END) OVER a - e) <= {scope}, false) AS near_{r}"
        for r, x in role.items())
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (
  SELECT doc_id, kind, m, sum(length(g) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY k ROWS UNBOUNDED PRECEDING) AS e FROM found),
parts AS (
  SELECT doc_id, kind, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed
  WHERE CASE kind {good} ELSE true END),
marked AS (
  SELECT *, coalesce(max(CASE WHEN kind < 3 THEN e END) OVER b > s, false) OR coalesce(min(CASE WHEN kind < 3 THEN s END) OVER a < e, false) AS inside
  FROM parts
  WINDOW b AS (PARTITION BY doc_id ORDER BY s, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         a AS (PARTITION BY doc_id ORDER BY s, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
linked AS (
  SELECT doc_id, kind, s, e, {near}
  FROM marked WHERE kind < 3 OR NOT inside
  WINDOW b AS (PARTITION BY doc_id ORDER BY s, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         a AS (PARTITION BY doc_id ORDER BY s, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
told AS (
  SELECT *, ([{names}])[kind + 1] || ':' || s || ':' || e AS t FROM linked
  WHERE kind < 3 OR (kind = 3 AND near_secret) OR (kind = 4 AND (near_identifier OR near_endpoint))
     OR (kind = 5 AND near_identifier AND near_secret)),
texts AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
         string_agg(t, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(t, ',' ORDER BY s, kind) AS spans
  FROM told GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN texts USING (doc_id)
"""


OP9 = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, w[i:i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
inside AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
  SELECT win.doc_id, unnest([i, i + 1, i + 2]) AS j FROM win JOIN twice ON twice.doc_id = win.doc_id AND twice.k = win.k) GROUP BY doc_id),
m AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         list_transform(lines, lambda x: trim(regexp_replace(regexp_replace(lower(x), '[0-9]+', '0', 'g'), '{SPACE}', ' ', 'g'))) AS keys,
         list_transform(lines, lambda x: len(list_filter(regexp_split_to_array(x, '{SPACE}'), lambda y: y <> ''))) AS sizes
  FROM d),
each AS (SELECT doc_id, source, list_sort(list_distinct(keys)) AS sig, unnest(keys) AS k, unnest(sizes) AS n FROM m),
held AS (SELECT DISTINCT source, sig, k, n FROM each),
shared AS (
  SELECT source, k FROM held WHERE n >= {line_quality.NOTICES["min_line"]} GROUP BY source, k HAVING count(*) >= {line_quality.NOTICES["min_docs"]}),
witness AS (
  SELECT h.source, h.sig FROM held h LEFT JOIN shared s ON s.k = h.k AND s.source IS NOT DISTINCT FROM h.source
  GROUP BY h.source, h.sig
  HAVING coalesce(sum(n) FILTER (s.k IS NOT NULL), 0) <= {line_quality.NOTICES["max_shared"]} * sum(n)),
busy AS (
  SELECT h.source, h.k FROM held h JOIN witness t ON t.sig = h.sig AND t.source IS NOT DISTINCT FROM h.source
  JOIN shared s ON s.k = h.k AND s.source IS NOT DISTINCT FROM h.source
  GROUP BY h.source, h.k HAVING count(*) >= {line_quality.NOTICES["min_docs"]}),
gone AS (
  SELECT doc_id, count(*) AS n_lines, CAST(sum(n) AS BIGINT) AS n FROM each e JOIN busy b ON b.k = e.k AND b.source IS NOT DISTINCT FROM e.source GROUP BY doc_id),
r AS (
  SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(inside.n, 0) AS n_repeat_words,
         n_words < {line_quality.MIN_WORDS} OR 100 * coalesce(inside.n, 0) > {line_quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         coalesce(gone.n_lines, 0) AS n_removed_lines, coalesce(gone.n, 0) AS n_removed_words
  FROM m LEFT JOIN inside ON inside.doc_id = m.doc_id LEFT JOIN gone ON gone.doc_id = m.doc_id)
SELECT *, NOT base_failed AND n_words - n_removed_words >= 0.3 * n_words AS kept FROM r
"""

OP13 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS x FROM d),
keyed AS (
  SELECT doc_id, i, x, {lower_ascii("regexp_replace(regexp_replace(x, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')")} AS k FROM each),
busy AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
left_over AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last <> doc_id) AS n_dropped,
         string_agg(x, chr(10) ORDER BY i) FILTER (last IS NULL OR last = doc_id) AS t
  FROM keyed LEFT JOIN busy USING (k) GROUP BY doc_id)
SELECT doc_id, n_lines, n_dropped, sha256(coalesce(t, '')) AS kept_sha256 FROM left_over
"""

ORACLES = {
    "op1_embedding_dedup": OP1,
    "op3_substring_dedup": OP3,
    "op6_url_filter": _op6(),
    "op7_secret_scan": _op7(),
    "op9_line_quality": OP9,
    "op13_line_dedup": OP13,
}
