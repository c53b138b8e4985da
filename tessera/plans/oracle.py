"""DuckDB SQL oracles for the driver queries (same column names as the Spark plans).

DuckDB 2.0 wants ``lambda x: ...`` for list lambdas.  Counts are cast to
``BIGINT``/``INTEGER`` to match the Spark types; averages are rounded.
"""

from __future__ import annotations

from tessera import fixed_values as fv
from tessera.stopwords import spanish_standard


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ROOTS_VALUES = ", ".join(f"({_sql_str(c)}, {_sql_str(n)})" for c, n in fv.ROOT_CATEGORIES)

NATION_TREE = (
    "chr(65 + n_regionkey) || lpad(CAST(n_nationkey % 7 AS VARCHAR), 2, '0') || '.' || "
    "lpad(CAST(n_nationkey AS VARCHAR), 3, '0')"
)

# Thesaurus CTEs over nation: descriptor, descriptor_tree, tree_name.
DESCRIPTOR_TREE_SIMPLE = f"""
  SELECT CAST(n_nationkey AS VARCHAR) AS ui, {NATION_TREE} AS tree_number,
         CAST(n_nationkey AS BIGINT) AS ord FROM nation"""

DESCRIPTOR_TREE_MULTI = DESCRIPTOR_TREE_SIMPLE + """
  UNION ALL
  SELECT CAST(n_nationkey AS VARCHAR), chr(65 + n_regionkey) || lpad(CAST(n_nationkey % 7 AS VARCHAR), 2, '0'),
         CAST(n_nationkey AS BIGINT) FROM nation WHERE n_regionkey <= 2
  UNION ALL
  SELECT CAST(n_nationkey AS VARCHAR), 'Q' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || '.' ||
         lpad(CAST(n_nationkey AS VARCHAR), 3, '0'),
         CAST(n_nationkey AS BIGINT) FROM nation WHERE n_regionkey = 4"""

THESAURUS_TEMPLATE = f"""
roots(code, name) AS (VALUES {ROOTS_VALUES}),
descriptor AS (SELECT CAST(n_nationkey AS VARCHAR) AS ui, n_name AS name FROM nation),
descriptor_tree AS (@DTREE@),
prefixes AS (
  SELECT DISTINCT array_to_string(list_slice(string_split(tree_number, '.'), 1, i), '.') AS code
  FROM descriptor_tree,
       LATERAL (SELECT unnest(range(1, len(string_split(tree_number, '.')) + 1)) AS i)),
exact AS (
  SELECT t.tree_number AS code, arg_min(d.name, t.ord) AS name
  FROM descriptor_tree t JOIN descriptor d USING (ui)
  WHERE d.name IS NOT NULL AND d.name <> ''
  GROUP BY t.tree_number),
tree_name AS (
  SELECT code, name, false AS exact FROM roots
  UNION ALL
  SELECT p.code,
         coalesce(e.name, coalesce(r.name, 'Category_' || substr(p.code, 1, 1)) || ' (' || p.code || ')'),
         e.name IS NOT NULL
  FROM prefixes p LEFT JOIN exact e USING (code)
       LEFT JOIN roots r ON r.code = substr(p.code, 1, 1)
  WHERE p.code NOT IN (SELECT code FROM roots)),
ui_cats AS (
  SELECT DISTINCT c.ui, c.level, c.code, coalesce(n.name, 'Unknown_' || c.code) AS name
  FROM (SELECT ui, 1 AS level, substr(split_part(tree_number, '.', 1), 1, 1) AS code FROM descriptor_tree
        UNION ALL
        SELECT ui, 2 AS level, split_part(tree_number, '.', 1) AS code FROM descriptor_tree) c
  LEFT JOIN tree_name n USING (code)
  WHERE c.code <> '')
"""
THESAURUS_CTES = THESAURUS_TEMPLATE.replace("@DTREE@", DESCRIPTOR_TREE_SIMPLE)

LABEL_ORDERS_CTES = THESAURUS_CTES + """,
majors AS (
  SELECT l.l_orderkey AS pmid, CAST(s.s_nationkey AS VARCHAR) AS ui
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE l.l_returnflag = 'R'),
per_article AS (
  SELECT m.pmid,
         CAST(count(DISTINCT m.ui) AS INTEGER) AS major_subjects_count,
         string_agg(DISTINCT CASE WHEN c.level = 1 THEN c.code END, ',' ORDER BY CASE WHEN c.level = 1 THEN c.code END) AS level1_codes,
         string_agg(DISTINCT CASE WHEN c.level = 2 THEN c.code END, ',' ORDER BY CASE WHEN c.level = 2 THEN c.code END) AS level2_codes
  FROM majors m LEFT JOIN ui_cats c USING (ui)
  GROUP BY m.pmid),
code_names AS (SELECT DISTINCT code, name FROM ui_cats),
labelled AS (
  SELECT o.o_orderkey AS pmid, o.o_orderpriority AS title, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         '' AS spanish_abstract,
         coalesce(p.level1_codes, '') AS level1_codes,
         coalesce(p.level2_codes, '') AS level2_codes,
         coalesce(p.major_subjects_count, 0) AS major_subjects_count
  FROM orders o LEFT JOIN per_article p ON p.pmid = o.o_orderkey),
named AS (
  SELECT l.*,
    coalesce((SELECT string_agg(cn.name, '; ' ORDER BY cn.code) FROM code_names cn
              WHERE list_contains(string_split(l.level1_codes, ','), cn.code)), '') AS level1_names,
    coalesce((SELECT string_agg(cn.name, '; ' ORDER BY cn.code) FROM code_names cn
              WHERE list_contains(string_split(l.level2_codes, ','), cn.code)), '') AS level2_names
  FROM labelled l)
"""

Q05 = "WITH " + LABEL_ORDERS_CTES + """
SELECT pmid, title, year, spanish_abstract, level1_codes, level1_names, level2_codes, level2_names,
       major_subjects_count, level1_names AS level1_categories_str, level2_names AS level2_categories_str
FROM named
"""

ORACLES = {
    "q05_label_articles": Q05,
}

WORDS = "list_filter(regexp_split_to_array(coalesce({c}, ''), '\\s+'), lambda x: x <> '')"
WORD_COUNT = "len(" + WORDS + ")"
HAS_CONTENT = "coalesce(length(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')) > 0, false)"


def _hits(col: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains(lower({col}), {_sql_str(w)}) AS INTEGER)" for w in words) + ")"


ES_WORDS = ["de", "que", "los", "las", "para"]
EN_WORDS = ["the", "of", "and", "that", "with"]

Q01 = f"""
SELECT doc_id, CAST({WORD_COUNT.format(c='text')} AS BIGINT) AS word_count
FROM documents
WHERE {HAS_CONTENT.format(c='text')} AND {WORD_COUNT.format(c='text')} >= {fv.MIN_ABSTRACT_WORDS}
"""

Q02 = f"""
SELECT doc_id,
  CASE WHEN text IS NULL OR text = '' THEN 'unknown'
       WHEN {_hits('text', ES_WORDS)} > {_hits('text', EN_WORDS)} AND {_hits('text', ES_WORDS)} >= 2 THEN 'spanish'
       WHEN {_hits('text', EN_WORDS)} > {_hits('text', ES_WORDS)} AND {_hits('text', EN_WORDS)} >= 2 THEN 'english'
       ELSE 'mixed_or_unknown' END AS abstract_language
FROM documents
"""

Q03 = """
SELECT count(*) AS total_articles,
       CAST(min(year(o_orderdate)) AS INTEGER) AS year_earliest,
       CAST(max(year(o_orderdate)) AS INTEGER) AS year_latest,
       round(avg(o_totalprice), 2) AS avg_abstract_length,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS structured_abstracts
FROM orders
"""

Q04 = """
SELECT 'language' AS stat, lang AS key, count(*) AS n FROM documents GROUP BY lang
UNION ALL
(SELECT 'year', CAST(year(o_orderdate) AS VARCHAR), count(*) AS n FROM orders
 GROUP BY year(o_orderdate) ORDER BY n DESC, year(o_orderdate) LIMIT 10)
UNION ALL
(SELECT 'journal', coalesce(o_orderpriority, 'Unknown') AS j, count(*) AS n FROM orders
 GROUP BY j ORDER BY n DESC, j LIMIT 20)
"""

Q06 = "WITH " + LABEL_ORDERS_CTES + """,
cov AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE length(level1_names) > 0) AS with_cat,
         count(*) FILTER (WHERE length(spanish_abstract) > 0) AS with_tr
  FROM named),
freq AS (
  SELECT c AS category, count(*) AS n
  FROM (SELECT unnest(string_split(level1_names, '; ')) AS c FROM named WHERE length(level1_names) > 0)
  GROUP BY c)
SELECT 'total_articles' AS metric, CAST(NULL AS VARCHAR) AS key, CAST(total AS DOUBLE) AS value FROM cov
UNION ALL SELECT 'articles_with_categories', NULL, with_cat FROM cov
UNION ALL SELECT 'articles_with_translation', NULL, with_tr FROM cov
UNION ALL SELECT 'coverage_percentage', NULL, round(with_cat * 100.0 / total, 4) FROM cov
UNION ALL SELECT 'translation_percentage', NULL, round(with_tr * 100.0 / total, 4) FROM cov
UNION ALL SELECT 'articles_without_categories', NULL, total - with_cat FROM cov
UNION ALL SELECT 'without_categories_percentage', NULL, round((total - with_cat) * 100.0 / total, 4) FROM cov
UNION ALL SELECT 'unique_level1_categories', NULL, count(*) FROM freq
UNION ALL (SELECT 'top_category', category, n FROM freq ORDER BY n DESC, category LIMIT 10)
"""

Q09 = f"""
WITH searched AS (
  SELECT doc_id FROM documents WHERE lang = 'en'
  UNION ALL SELECT doc_id FROM labels
  UNION ALL SELECT doc_id FROM documents WHERE n_chars > 5000),
found AS (SELECT DISTINCT doc_id FROM searched),
rows AS (
  SELECT f.doc_id,
         coalesce({HAS_CONTENT.format(c='d.text')}, false) AS ok_abstract,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id) AS ok_terms,
         coalesce({WORD_COUNT.format(c='d.text')} >= {fv.MIN_ABSTRACT_WORDS} AND d.doc_id IS NOT NULL, false) AS ok_len
  FROM found f LEFT JOIN documents d USING (doc_id))
SELECT (SELECT count(*) FROM searched) AS searched,
       count(*) AS found,
       count(*) FILTER (WHERE NOT ok_abstract) AS dropped_no_abstract,
       count(*) FILTER (WHERE ok_abstract AND NOT ok_terms) AS dropped_no_terms,
       count(*) FILTER (WHERE ok_abstract AND ok_terms AND NOT ok_len) AS dropped_too_short,
       count(*) FILTER (WHERE ok_abstract AND ok_terms AND ok_len) AS final
FROM rows
"""

ORACLES.update({
    "q01_quality_filter": Q01,
    "q02_language_detect": Q02,
    "q03_corpus_profile": Q03,
    "q04_top_groups": Q04,
    "q06_coverage_stats": Q06,
    "q09_stage_counters": Q09,
})

Q07 = "WITH " + THESAURUS_TEMPLATE.replace("@DTREE@", DESCRIPTOR_TREE_MULTI) + """
SELECT code, name, exact FROM tree_name
"""

Q08 = """
WITH o AS (SELECT o_orderkey AS id, o_orderdate, o_custkey, o_orderpriority FROM orders),
tagged AS (
  SELECT id, 'date_range' AS strategy, 0 AS rank FROM o WHERE year(o_orderdate) BETWEEN 1995 AND 1997
  UNION ALL
  SELECT id, 'journals', 1 FROM o WHERE o_custkey IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
  UNION ALL
  SELECT id, 'subjects', 2 FROM o WHERE o_orderpriority = '1-URGENT')
SELECT id AS pmid, arg_min(strategy, rank) AS strategy, CAST(min(rank) AS INTEGER) AS rank
FROM tagged GROUP BY id
"""

Q27 = """
SELECT o_orderkey AS pmid, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders
WHERE year(o_orderdate) BETWEEN 1994 AND 1996
  AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_custkey IN (
    SELECT c_custkey FROM customer WHERE c_nationkey IN (
      SELECT n_nationkey FROM nation WHERE n_regionkey IN (
        SELECT r_regionkey FROM region WHERE r_name IN ('EUROPE', 'ASIA'))))
"""

ORACLES.update({
    "q07_prefix_closure": Q07,
    "q08_union_strategies": Q08,
    "q27_membership_filters": Q27,
})

STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _strip(c: str) -> str:
    return STRIP.format(c=c)


# J1 oracle: the unwrap loops run literally, one level per recursion step.
Q10 = f"""
WITH RECURSIVE titles AS (
  SELECT p_partkey, 0 AS variant, p_name AS title FROM part
  UNION ALL SELECT p_partkey, 1, '[' || p_name || '].' FROM part
  UNION ALL SELECT p_partkey, 2, '  [[ ' || p_name || ' ] ]..  ' FROM part
  UNION ALL SELECT p_partkey, 3, '([' || p_name || '])' FROM part
  UNION ALL SELECT p_partkey, 4, '(' || p_name || ') and (' || p_brand || ')' FROM part),
start AS (
  SELECT p_partkey, variant, title,
         {_strip("regexp_replace(" + _strip('title') + ", '\\.+$', '')")} AS s
  FROM titles),
brackets(p_partkey, variant, s, done) AS (
  SELECT p_partkey, variant, s, false FROM start
  UNION ALL
  SELECT p_partkey, variant,
         CASE WHEN starts_with(s, '[') AND ends_with(s, ']') THEN {_strip('substr(s, 2, length(s) - 2)')} ELSE s END,
         NOT (starts_with(s, '[') AND ends_with(s, ']'))
  FROM brackets WHERE NOT done),
parens(p_partkey, variant, s, done) AS (
  SELECT p_partkey, variant, s, false FROM brackets WHERE done
  UNION ALL
  SELECT p_partkey, variant,
         CASE WHEN starts_with(s, '(') AND ends_with(s, ')') THEN {_strip('substr(s, 2, length(s) - 2)')} ELSE s END,
         NOT (starts_with(s, '(') AND ends_with(s, ')'))
  FROM parens WHERE NOT done)
SELECT t.p_partkey, t.variant, t.title,
       CASE WHEN t.title IS NULL OR t.title = '' THEN t.title
            ELSE {_strip("regexp_replace(" + _strip("regexp_replace(p.s, '\\.+$', '')") + ", '\\s+', ' ', 'g')")} END
       AS cleaned_title
FROM titles t JOIN parens p ON p.p_partkey = t.p_partkey AND p.variant = t.variant AND p.done
"""

SENTENCES = ("list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), "
             "lambda s: " + STRIP.format(c="s") + "), lambda s: s <> '')")

Q11 = f"""
SELECT doc_id, CAST(len({SENTENCES}) AS BIGINT) AS n_sentences, array_to_string({SENTENCES}, ' ') AS rejoined
FROM documents
"""


def _stopword_list_sql() -> str:
    words = dict.fromkeys([*spanish_standard(), *fv.EXTRA_SPANISH_STOPWORDS])
    return "[" + ", ".join(_sql_str(w) for w in words) + "]"


CLEAN = ("regexp_replace(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), "
         "'\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')")
TOKENS = "list_filter(string_split(" + CLEAN + ", ' '), lambda t: t <> '')"


def _processed(c: str) -> str:
    return ("array_to_string(list_filter(" + TOKENS.format(c=c) + ", lambda t: length(t) >= 2 AND "
            "regexp_matches(t, '[a-zA-ZáéíóúüñÁÉÍÓÚÜÑ]') AND NOT list_contains(" + _stopword_list_sql() + ", t)), ' ')")


def _q12() -> str:
    return f"""
SELECT doc_id, {CLEAN.format(c='text')} AS cleaned, {_processed('text')} AS text_processed
FROM documents
"""


def _q13() -> str:
    return f"""
WITH p AS (SELECT text, {_processed('text')} AS text_processed FROM documents)
SELECT 'text' AS column, count(text) AS non_empty_before, round(avg(length(text)), 4) AS avg_length_before,
       count(*) FILTER (WHERE text_processed <> '') AS non_empty_after,
       round(avg(length(text_processed)), 4) AS avg_length_after
FROM p
"""


Q30 = f"""
WITH toks AS (SELECT doc_id, {TOKENS.format(c='text')} AS tokens FROM documents),
rows AS (SELECT doc_id, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS token FROM toks),
vocab AS (SELECT DISTINCT token FROM rows),
lemmas AS (
  SELECT v.token, substr(v.token, 1, length(v.token) - 1) AS lemma FROM vocab v
  WHERE ends_with(v.token, 's') AND length(v.token) >= 4
    AND substr(v.token, 1, length(v.token) - 1) IN (SELECT token FROM vocab)),
normed AS (
  SELECT r.doc_id, r.pos, coalesce(l.lemma, r.token) AS norm FROM rows r LEFT JOIN lemmas l USING (token))
SELECT d.doc_id, coalesce(string_agg(n.norm, ' ' ORDER BY n.pos), '') AS normalised
FROM documents d LEFT JOIN normed n USING (doc_id)
GROUP BY d.doc_id
"""

ORACLES.update({
    "q10_clean_title": Q10,
    "q11_sentence_split": Q11,
    "q12_clean_text": _q12(),
    "q13_text_profile": _q13(),
    "q30_normalise_vocab": Q30,
})

BIO_CTES = """
toks AS (
  SELECT CAST(user_id AS VARCHAR) AS file, event_type AS token,
         CASE WHEN value < 1 THEN 'I-' WHEN event_type = 'signup' THEN 'B-A' WHEN event_type = 'view' THEN 'I-A'
              WHEN event_type = 'click' THEN 'I-B' WHEN event_type = 'purchase' THEN 'O'
              WHEN event_type = 'error' THEN 'ERR' ELSE event_type END AS label,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS ord
  FROM events),
prevs AS (SELECT *, lag(label) OVER (PARTITION BY file ORDER BY ord) AS prev FROM toks),
flags AS (
  SELECT *, label <> 'O' AND NOT (starts_with(label, 'B-') OR starts_with(label, 'I-')) AS r1,
         substr(label, 3) AS t,
         starts_with(prev, 'B-') OR starts_with(prev, 'I-') AS prev_bi
  FROM prevs),
errs AS (
  SELECT file, ord AS line_number, token, label, 1 AS rule, 'INVALID_LABEL_FORMAT' AS error_type,
         'label ''' || label || ''' does not follow the BIO scheme' AS description, 'O' AS suggested_fix
  FROM flags WHERE r1
  UNION ALL
  SELECT file, ord, token, label, 2, 'ORPHAN_I_TAG', 'I-' || t || ' without a preceding B-' || t || ' (first line)', 'B-' || t
  FROM flags WHERE NOT r1 AND starts_with(label, 'I-') AND prev IS NULL
  UNION ALL
  SELECT file, ord, token, label, 3, 'ORPHAN_I_TAG', 'I-' || t || ' without a preceding B-' || t || ' (after O)', 'B-' || t
  FROM flags WHERE NOT r1 AND starts_with(label, 'I-') AND prev = 'O'
  UNION ALL
  SELECT file, ord, token, label, 4, 'ENTITY_TYPE_MISMATCH', 'I-' || t || ' after ' || prev, 'B-' || t
  FROM flags WHERE NOT r1 AND starts_with(label, 'I-') AND prev_bi AND substr(prev, 3) <> t
  UNION ALL
  SELECT file, ord, token, label, 5, 'EMPTY_ENTITY_TYPE', 'label ''' || label || ''' has no entity type', 'O'
  FROM flags WHERE NOT r1 AND (starts_with(label, 'B-') OR starts_with(label, 'I-')) AND t = '')
"""

Q18 = "WITH " + BIO_CTES + """
SELECT file, line_number, token, label, rule, error_type, description, suggested_fix FROM errs
"""

Q19 = "WITH " + BIO_CTES + """,
lines AS (SELECT file, count(*) AS total_lines, count(*) FILTER (WHERE starts_with(label, 'B-')) AS total_entities
          FROM toks GROUP BY file),
ec AS (SELECT file, substr(label, 3) AS et, count(*) AS n FROM toks WHERE starts_with(label, 'B-') GROUP BY file, et),
ecs AS (SELECT file, string_agg(et || ':' || CAST(n AS VARCHAR), ',' ORDER BY et) AS entity_counts FROM ec GROUP BY file),
ne AS (SELECT file, count(*) AS total_errors FROM errs GROUP BY file)
SELECT l.file, l.total_lines, coalesce(ne.total_errors, 0) AS total_errors,
       coalesce(ne.total_errors, 0) = 0 AS is_valid, l.total_entities,
       coalesce(ecs.entity_counts, '') AS entity_counts
FROM lines l LEFT JOIN ne USING (file) LEFT JOIN ecs USING (file)
"""

Q20 = "WITH " + BIO_CTES + """,
fixes AS (SELECT file, line_number AS ord, arg_max(suggested_fix, rule) AS fix FROM errs GROUP BY file, line_number)
SELECT t.file, t.ord, t.token, t.label, coalesce(f.fix, t.label) AS fixed_label
FROM toks t LEFT JOIN fixes f USING (file, ord)
"""

Q21 = "WITH " + BIO_CTES + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY line_number, rule) AS rank,
                  count(*) OVER (PARTITION BY file) AS file_errors FROM errs)
SELECT file, line_number, rule, error_type, CAST(rank AS INTEGER) AS rank, file_errors,
       greatest(file_errors - 10, 0) AS more
FROM ranked WHERE rank <= 10
"""

ORACLES.update({
    "q18_bio_errors": Q18,
    "q19_bio_stats": Q19,
    "q20_bio_repair": Q20,
    "q21_bio_top_errors": Q21,
})

Q28 = """
WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) AS file, event_id, event_type AS token, value,
         CASE WHEN value < 1 THEN 'I-' WHEN event_type = 'signup' THEN 'B-A' WHEN event_type = 'view' THEN 'I-A'
              WHEN event_type = 'click' THEN 'I-B' WHEN event_type = 'purchase' THEN 'O'
              WHEN event_type = 'error' THEN 'ERR' ELSE event_type END AS label,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS line_no
  FROM events),
lines AS (
  SELECT file, line_no,
    CASE WHEN token IN ('signup', 'view') THEN label || chr(9) || 'x' || chr(9) || 'y' || chr(9) || token
         WHEN token = 'click' THEN token || chr(9) || label
         WHEN token = 'purchase' AND value < 10 THEN chr(9) || token || chr(9) || label
         WHEN token = 'purchase' THEN token || chr(9) || label || chr(9) || 'extra'
         WHEN value < 5 THEN '   '
         ELSE token END AS line
  FROM ev),
parsed AS (
  SELECT file, line_no, string_split(s, chr(9)) AS parts
  FROM (SELECT file, line_no, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS s FROM lines)
  WHERE s <> '' AND contains(s, chr(9)))
SELECT file,
       CAST(row_number() OVER (PARTITION BY file ORDER BY line_no) AS INTEGER) AS ord,
       CASE WHEN len(parts) >= 4 THEN parts[4] ELSE parts[1] END AS token,
       CASE WHEN len(parts) >= 4 THEN parts[1] ELSE parts[2] END AS label,
       CAST(line_no AS INTEGER) AS line_no
FROM parsed WHERE len(parts) >= 2
"""

ORACLES.update({"q28_bio_tokens_parse": Q28})


def _lang_case(col: str) -> str:
    es, en = _hits(col, ES_WORDS), _hits(col, EN_WORDS)
    return (f"CASE WHEN {col} IS NULL OR {col} = '' THEN 'unknown' "
            f"WHEN {es} > {en} AND {es} >= 2 THEN 'spanish' WHEN {en} > {es} AND {en} >= 2 THEN 'english' "
            "ELSE 'mixed_or_unknown' END")


def _clean_title_sql(src: str) -> str:
    """One-level bracket/parenthesis unwrap (enough for these titles, which
    carry at most one ``[...]`` wrap)."""
    s0 = _strip("regexp_replace(" + _strip(src) + ", '\\.+$', '')")
    b = (f"CASE WHEN starts_with({s0}, '[') AND ends_with({s0}, ']') "
         f"THEN {_strip(f'substr({s0}, 2, length({s0}) - 2)')} ELSE {s0} END")
    p = (f"CASE WHEN starts_with({b}, '(') AND ends_with({b}, ')') "
         f"THEN {_strip(f'substr({b}, 2, length({b}) - 2)')} ELSE {b} END")
    return _strip("regexp_replace(" + _strip(f"regexp_replace({p}, '\\.+$', '')") + ", '\\s+', ' ', 'g')")


QUEUE_CTES = f"""
arts AS (
  SELECT doc_id, text,
         CASE WHEN lang = 'fr' THEN '[' || split_part(text, chr(10), 1) || '].' ELSE split_part(text, chr(10), 1) END AS title,
         {_lang_case('text')} AS abstract_language,
         {HAS_CONTENT.format(c='text')} AS has_content
  FROM documents),
queue AS (
  SELECT doc_id, 'abstract' AS kind, text AS source_text, CAST(NULL AS VARCHAR) AS original_title
  FROM arts
  WHERE abstract_language IN ('english', 'mixed_or_unknown') AND has_content
    AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
  UNION ALL
  SELECT doc_id, 'title', ct, ot FROM (
    SELECT doc_id, {_clean_title_sql('title')} AS ct, {_strip('title')} AS ot FROM arts
    WHERE {HAS_CONTENT.format(c='title')}
      AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))
  WHERE length(ct) > 0)
"""

Q14 = "WITH " + QUEUE_CTES + "SELECT * FROM queue"

Q15 = "WITH " + QUEUE_CTES + f""",
abs_items AS (SELECT doc_id, {SENTENCES.replace('coalesce(text', 'coalesce(source_text')} AS sents FROM queue WHERE kind = 'abstract')
SELECT doc_id, 'abstract' AS kind,
       CASE WHEN list_bool_or(list_transform(sents, lambda s: contains(s, '@'))) THEN ''
            ELSE array_to_string(list_transform(sents, lambda s: '[es] ' || s), ' ') END AS text,
       NOT coalesce(list_bool_or(list_transform(sents, lambda s: contains(s, '@'))), false) AS success,
       CASE WHEN list_bool_or(list_transform(sents, lambda s: contains(s, '@'))) THEN 'ValueError: untranslatable item' END AS error
FROM abs_items
UNION ALL
SELECT doc_id, 'title', CASE WHEN contains(source_text, '@') THEN '' ELSE '[es] ' || source_text END,
       NOT contains(source_text, '@'),
       CASE WHEN contains(source_text, '@') THEN 'ValueError: untranslatable item' END
FROM queue WHERE kind = 'title'
"""

ORACLES.update({"q14_translate_queue": Q14, "q15_translate_apply": Q15})

# The labelled orders fall in the five roots of regions 0-4 (letters A-E).
Q16_CLASSES = [n for c, n in fv.ROOT_CATEGORIES if c in "ABCDE"]


def _q16() -> str:
    from tessera.operators.splits import category_column_name

    cols = ",\n       ".join(
        f"CAST(list_contains(cats, {_sql_str(c)}) AS INTEGER) AS {category_column_name(c)}" for c in sorted(Q16_CLASSES))
    return "WITH " + LABEL_ORDERS_CTES + f""",
rows AS (
  SELECT pmid, list_transform(string_split(level1_names, ';'), lambda x: {_strip('x')}) AS cats
  FROM named WHERE length(level1_names) > 0)
SELECT pmid,
       {cols},
       CAST(len(cats) AS INTEGER) AS n_labels
FROM rows
"""


Q17 = """
WITH d AS (SELECT doc_id, lang || '; ' || source AS categories FROM documents),
b AS (SELECT doc_id, categories,
             CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '#42'), 1, 8))::BIGINT % 10000 AS INTEGER) AS bucket
      FROM d)
SELECT doc_id, regexp_replace(split_part(categories, ';', 1), '^\\s+|\\s+$', '', 'g') AS single_category, bucket,
       CASE WHEN bucket < 2000 THEN 'test' WHEN bucket < 3600 THEN 'val' ELSE 'train' END AS split
FROM b
"""

ORACLES.update({"q16_multilabel_matrix": _q16(), "q17_split_assign": Q17})

TOKEN_RE = "'[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]'"
CUTS = "('.', ',', ';', '!', '?')"


def chunk_ctes(source_sql: str, m: int) -> str:
    """K9 oracle: per-position chunk end from a window, then the chain of
    chunk starts followed with a recursive CTE (start 0, next = end + 1)."""
    return f"""
src AS ({source_sql}),
toks AS (SELECT file, regexp_extract_all(text, {TOKEN_RE}) AS t FROM src),
lens AS (SELECT file, len(t) AS n FROM toks),
pos AS (SELECT file, unnest(generate_series(0, len(t) - 1)) AS i, unnest(t) AS tok FROM toks WHERE len(t) > 0),
cand AS (
  SELECT file, i AS s,
         min(CASE WHEN tok IN {CUTS} THEN i END)
           OVER (PARTITION BY file ORDER BY i ROWS BETWEEN {m - 1} FOLLOWING AND {m + 98} FOLLOWING) AS p
  FROM pos),
ends AS (
  SELECT c.file, c.s,
         CASE WHEN c.s + {m - 1} >= l.n - 1 THEN l.n - 1 WHEN c.p IS NOT NULL THEN c.p
              WHEN c.s + {m + 49} <= l.n - 1 THEN c.s + {m + 49} ELSE l.n - 1 END AS e
  FROM cand c JOIN lens l USING (file)),
chain(file, idx, s, e) AS (
  SELECT file, 0, 0, e FROM ends WHERE s = 0 AND file IN (SELECT file FROM lens WHERE n > {m})
  UNION ALL
  SELECT ch.file, ch.idx + 1, en.s, en.e FROM chain ch JOIN ends en ON en.file = ch.file AND en.s = ch.e + 1),
chunks AS (
  SELECT file, idx, s, e FROM chain
  UNION ALL SELECT file, 0, 0, n - 1 FROM lens WHERE n <= {m}),
chunks_t AS (
  SELECT c.file, CAST(c.idx AS INTEGER) AS chunk_index,
         CAST(count(*) OVER (PARTITION BY c.file) AS INTEGER) AS total_chunks,
         CAST(c.s AS INTEGER) AS start, CAST(c.e AS INTEGER) AS "end",
         t.t[c.s + 1:c.e + 1] AS toks, t.t AS all_t
  FROM chunks c JOIN toks t USING (file))
"""


Q23 = "WITH RECURSIVE " + chunk_ctes("SELECT CAST(doc_id AS VARCHAR) AS file, text FROM documents", 200) + """
SELECT file AS source_file, chunk_index, total_chunks, start, "end",
       CAST(len(toks) AS INTEGER) AS n_tokens, toks[1] AS first_token, toks[len(toks)] AS last_token
FROM chunks_t
"""


def _q22() -> str:
    from tessera.operators.chunking import DEFAULT_PART_NOTE, DEFAULT_PROMPT_TEMPLATE

    head, tail = DEFAULT_PROMPT_TEMPLATE.split("%s%s")
    note_a, rest = DEFAULT_PART_NOTE.split("%d", 1)
    note_b, note_c = rest.split("%d", 1)
    lines = ("array_to_string(list_transform(toks, lambda w: w || chr(9) || "
             "CASE WHEN regexp_matches(w, '^\\p{Lu}') THEN 'B-CAP' ELSE 'O' END), chr(10))")
    note = (f"CASE WHEN total_chunks > 1 THEN {_sql_str(note_a)} || CAST(chunk_index + 1 AS VARCHAR) || "
            f"{_sql_str(note_b)} || CAST(total_chunks AS VARCHAR) || {_sql_str(note_c)} ELSE '' END")
    src = "SELECT printf('c%05d_t%03d', conv_id, turn) AS file, text FROM conversations"
    return "WITH RECURSIVE " + chunk_ctes(src, 50) + f"""
SELECT file || '__chunk_' || CAST(chunk_index AS VARCHAR) AS custom_id,
       CAST((row_number() OVER (ORDER BY file, chunk_index) - 1) // 100 AS INTEGER) AS batch_no,
       'POST' AS method, '/v1/chat/completions' AS url, 'translator-model' AS model, 2 AS n_messages,
       {_sql_str(head)} || {lines} || {note} || {_sql_str(tail)} AS prompt,
       total_chunks,
       CAST(floor(length({_sql_str(head)} || {lines} || {note} || {_sql_str(tail)}) / 4) AS BIGINT) AS est_tokens
FROM chunks_t
"""


RESULTS_CTE = """
res AS (
  SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || '__chunk_' || CAST(turn AS VARCHAR) AS custom_id,
         CASE WHEN role = 'system' THEN 500 ELSE 200 END AS status_code,
         replace(text, ' ', chr(9)) AS content
  FROM conversations)
"""

Q24 = "WITH " + RESULTS_CTE + """,
ok AS (
  SELECT conv_id, turn,
         list_filter(list_transform(list_filter(list_transform(regexp_split_to_array(content, '\\r\\n|\\r|\\n'),
                       lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '' AND contains(s, chr(9))),
                     lambda s: string_split(s, chr(9))), lambda p: len(p) >= 2) AS parts
  FROM res WHERE status_code = 200),
flat AS (SELECT conv_id, turn, unnest(generate_series(1, len(parts))) AS k, unnest(parts) AS p FROM ok)
SELECT o.conv_id,
       (SELECT string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FROM ok o2 WHERE o2.conv_id = o.conv_id) AS chunk_indexes,
       CAST((SELECT count(*) FROM flat f WHERE f.conv_id = o.conv_id) AS INTEGER) AS n_tokens,
       coalesce((SELECT string_agg(p[1] || chr(9) || p[2], chr(10) ORDER BY turn, k) FROM flat f WHERE f.conv_id = o.conv_id), '') AS text
FROM (SELECT DISTINCT conv_id FROM ok) o
"""

Q25 = "WITH " + RESULTS_CTE + """
SELECT custom_id, conv_id, CAST(turn AS INTEGER) AS turn FROM res WHERE status_code <> 200
"""

ORACLES.update({"q22_request_lines": _q22(), "q23_chunk_documents": Q23, "q24_reassemble": Q24, "q25_retry_set": Q25})

MEMBERS_CTE = """
a AS (SELECT DISTINCT printf('doc_%06d.nersuite', doc_id) AS name FROM documents),
b AS (SELECT DISTINCT printf('doc_%06d.nersuite', doc_id) AS name FROM labels),
m AS (SELECT coalesce(a.name, b.name) AS name, a.name IS NOT NULL AS in_a, b.name IS NOT NULL AS in_b
      FROM a FULL OUTER JOIN b ON a.name = b.name)
"""

Q26 = "WITH " + MEMBERS_CTE + """
SELECT count(*) FILTER (WHERE in_a) AS size_a, count(*) FILTER (WHERE in_b) AS size_b,
       count(*) FILTER (WHERE in_a AND in_b) AS common,
       count(*) FILTER (WHERE in_a AND NOT in_b) AS only_a,
       count(*) FILTER (WHERE in_b AND NOT in_a) AS only_b,
       round(count(*) FILTER (WHERE in_a AND in_b) * 100.0 / count(*) FILTER (WHERE in_a), 4) AS completeness_pct
FROM m
"""

Q26B = "WITH " + MEMBERS_CTE + """,
sides AS (SELECT name, CASE WHEN in_a THEN 'only_a' ELSE 'only_b' END AS side FROM m WHERE in_a <> in_b),
firsts AS (SELECT side, name, 'first' AS part FROM (
             SELECT *, row_number() OVER (PARTITION BY side ORDER BY name) AS r FROM sides) WHERE r <= 10),
lasts AS (SELECT side, name, 'last' AS part FROM (
             SELECT *, row_number() OVER (PARTITION BY side ORDER BY name DESC) AS r FROM sides) WHERE r <= 10)
SELECT side, name, min(part) AS part FROM (SELECT * FROM firsts UNION ALL SELECT * FROM lasts) GROUP BY side, name
"""


def _elem_text(tag: str) -> str:
    inner = f"regexp_extract(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>', 1)"
    s = f"regexp_replace({inner}, '<[^>]*>', '', 'g')"
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")]:
        s = f"replace({s}, {_sql_str(ent)}, {_sql_str(ch)})"
    return f"coalesce({_strip(s)}, '')"


Q29 = f"""
SELECT page_id,
       {_elem_text('title')} AS title,
       {_elem_text('h1')} AS heading,
       nullif(regexp_extract(html, '(?is)<html\\s[^>]*\\blang\\s*=\\s*"([^"]*)"', 1), '') AS lang,
       nullif(regexp_extract(html, '(?is)<meta\\s[^>]*\\bcharset\\s*=\\s*"([^"]*)"', 1), '') AS charset,
       CAST(len(regexp_extract_all(html, '(?i)<a[\\s>]')) AS INTEGER) AS n_links
FROM pages
"""

ORACLES.update({"q26_dataset_compare": Q26, "q26b_missing_files": Q26B, "q29_page_extract": Q29})


def _q31() -> str:
    lang = _lang_case("text")
    return f"""
WITH l AS (SELECT {lang} AS lang FROM documents)
SELECT count(*) AS total,
       count(*) FILTER (WHERE lang = 'spanish') AS spanish,
       count(*) FILTER (WHERE lang = 'english') AS english,
       count(*) - count(*) FILTER (WHERE lang = 'spanish') - count(*) FILTER (WHERE lang = 'english') AS other,
       round(count(*) FILTER (WHERE lang = 'spanish') * 100.0 / count(*), 1) AS spanish_pct,
       round(count(*) FILTER (WHERE lang = 'english') * 100.0 / count(*), 1) AS english_pct,
       round((count(*) - count(*) FILTER (WHERE lang = 'spanish') - count(*) FILTER (WHERE lang = 'english')) * 100.0
             / count(*), 1) AS other_pct
FROM l
"""


Q32 = "WITH " + THESAURUS_TEMPLATE.replace("@DTREE@", DESCRIPTOR_TREE_MULTI) + """
SELECT 'total_terms' AS metric, count(*) AS value FROM descriptor
UNION ALL SELECT 'terms_with_tree_numbers', count(DISTINCT ui) FROM descriptor_tree
UNION ALL SELECT 'total_categories', count(*) FROM tree_name
UNION ALL SELECT 'main_categories', count(*) FILTER (WHERE length(code) = 1) FROM tree_name
UNION ALL SELECT 'level2_categories', count(*) FILTER (WHERE NOT contains(code, '.') AND length(code) > 1) FROM tree_name
UNION ALL SELECT 'exact_matches', count(*) FILTER (WHERE exact) FROM tree_name
"""

Q33 = "WITH q15 AS (" + Q15 + """)
SELECT kind, count(*) FILTER (WHERE success) AS successful, count(*) FILTER (WHERE NOT success) AS failed,
       count(*) AS total, round(count(*) FILTER (WHERE success) * 100.0 / count(*), 2) AS success_rate
FROM q15 GROUP BY kind
"""

Q34 = "WITH " + LABEL_ORDERS_CTES + """,
rows AS (SELECT pmid, list_transform(string_split(level1_names, ';'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) AS cats
         FROM named WHERE length(level1_names) > 0),
total AS (SELECT count(*) AS n FROM rows),
counts AS (SELECT c AS category, count(*) AS count FROM (SELECT unnest(cats) AS c FROM rows) GROUP BY c)
SELECT category, count, (SELECT n FROM total) AS total_samples,
       round(count * 100.0 / (SELECT n FROM total), 4) AS percentage
FROM counts ORDER BY count DESC, category LIMIT 10
"""

Q35 = """
WITH b AS (SELECT CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '#42'), 1, 8))::BIGINT % 10000 AS INTEGER) AS bucket
           FROM documents)
SELECT CASE WHEN bucket < 2000 THEN 'test' WHEN bucket < 3600 THEN 'val' ELSE 'train' END AS split, count(*) AS count
FROM b GROUP BY 1
"""


def _q36() -> str:
    src = "SELECT printf('c%05d_t%03d', conv_id, turn) AS file, text FROM conversations"
    return "WITH RECURSIVE " + chunk_ctes(src, 50) + """,
b AS (SELECT file, CAST((row_number() OVER (ORDER BY file, chunk_index) - 1) // 100 AS INTEGER) AS batch_no FROM chunks_t)
SELECT batch_no, count(*) AS chunks, string_agg(DISTINCT file, ',' ORDER BY file) AS files FROM b GROUP BY batch_no
"""


Q37 = "WITH " + BIO_CTES + """,
verdicts AS (SELECT t.file, count(e.file) AS total_errors
             FROM (SELECT DISTINCT file FROM toks) t LEFT JOIN errs e USING (file) GROUP BY t.file)
SELECT 'error_type' AS metric, error_type AS key, count(*) AS value FROM errs GROUP BY error_type
UNION ALL SELECT 'total_files', NULL, count(*) FROM verdicts
UNION ALL SELECT 'total_errors', NULL, sum(total_errors) FROM verdicts
UNION ALL SELECT 'files_with_errors', NULL, count(*) FILTER (WHERE total_errors > 0) FROM verdicts
"""

Q38 = """
WITH o AS (SELECT o_orderkey AS id, o_orderdate, o_custkey, o_orderpriority FROM orders),
tagged AS (
  SELECT id, 'date_range' AS strategy, 0 AS rank FROM o WHERE year(o_orderdate) BETWEEN 1995 AND 1997
  UNION ALL
  SELECT id, 'journals', 1 FROM o WHERE o_custkey IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
  UNION ALL
  SELECT id, 'subjects', 2 FROM o WHERE o_orderpriority = '1-URGENT'),
winners AS (SELECT id, arg_min(strategy, rank) AS strategy FROM tagged GROUP BY id),
searched AS (SELECT strategy, CAST(min(rank) AS INTEGER) AS rank, count(*) AS searched FROM tagged GROUP BY strategy),
new AS (SELECT strategy, count(*) AS new FROM winners GROUP BY strategy)
SELECT s.strategy, s.rank, s.searched, coalesce(n.new, 0) AS new FROM searched s LEFT JOIN new n USING (strategy)
"""

ORACLES.update({
    "q22_request_lines": _q22(),
    "q31_language_summary": _q31(),
    "q32_thesaurus_stats": Q32,
    "q33_translation_summary": Q33,
    "q34_label_counts": Q34,
    "q35_split_sizes": Q35,
    "q36_batch_info": _q36(),
    "q37_bio_summary": Q37,
    "q38_strategy_counts": Q38,
})

Q39 = """
WITH li AS (SELECT l_orderkey, count(*) AS n_terms, count(*) FILTER (WHERE l_returnflag = 'R') AS n_major
            FROM lineitem GROUP BY l_orderkey),
t AS (SELECT *, 'TOTAL > ' || o_orderstatus || ': <' || CAST(CAST(floor(o_totalprice * 100) AS BIGINT) AS VARCHAR) || '> cents'
         || chr(10) || chr(10) || o_orderpriority || ' text' AS full_text FROM orders)
SELECT o.o_orderkey AS pmid, 'Order ' || o.o_orderstatus || ' & more <x>' AS title, o.full_text,
       CAST(""" + WORD_COUNT.format(c="o.full_text") + """ AS INTEGER) AS word_count, true AS structured,
       CAST(li.n_terms AS INTEGER) AS n_terms, CAST(li.n_major AS INTEGER) AS n_major,
       o.o_orderpriority AS journal_title, CAST(o.o_custkey AS VARCHAR) AS issn,
       CAST(o.o_custkey AS VARCHAR) || '/-' AS authors, o.o_orderstatus || ' < 1' AS keywords, '10/' || CAST(o.o_orderkey AS VARCHAR) AS doi,
       CAST(year(o.o_orderdate) AS INTEGER) AS year
FROM t o JOIN li ON li.l_orderkey = o.o_orderkey
WHERE NOT (o.o_orderpriority = '5-LOW' AND o.o_orderstatus = 'P')
"""

ORACLES.update({"q39_xml_extract": Q39})

Q40 = """
WITH o AS (SELECT o_orderkey AS id, o_orderdate, o_custkey, o_orderpriority FROM orders),
tagged AS (
  SELECT id, 'date_range' AS strategy, 0 AS rank FROM o WHERE year(o_orderdate) BETWEEN 1995 AND 1997
  UNION ALL
  SELECT id, 'journals', 1 FROM o WHERE o_custkey IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
  UNION ALL
  SELECT id, 'subjects', 2 FROM o WHERE o_orderpriority = '1-URGENT'),
winners AS (SELECT id, arg_min(strategy, rank) AS strategy, min(rank) AS rank FROM tagged GROUP BY id),
added AS (SELECT rank, count(*) AS n FROM winners GROUP BY rank),
earlier AS (SELECT a.rank, coalesce((SELECT sum(b.n) FROM added b WHERE b.rank < a.rank), 0) AS n FROM added a)
SELECT w.id AS pmid, w.strategy, CAST(w.rank AS INTEGER) AS rank
FROM winners w JOIN earlier e USING (rank) WHERE e.n < (SELECT count(*) // 2 FROM orders)
"""

Q41 = """
SELECT DISTINCT l_orderkey AS pmid FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE n_name IN ('NATION_3', 'NATION_7') ORDER BY pmid LIMIT 20
"""

Q42 = """
SELECT DISTINCT o_custkey AS id FROM orders WHERE year(o_orderdate) = 1998
  AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) < 1997)
"""

Q43 = "SELECT source AS category, count(*) AS count FROM documents GROUP BY source"

Q44 = """
WITH d AS (SELECT CASE WHEN n_chars > 1000 THEN lang ELSE 'Unknown' END AS journal FROM documents)
SELECT journal, format('{:,}', count(*)) AS count, printf('%.1f', count(*) * 100.0 / (SELECT count(*) FROM d)) AS share
FROM d GROUP BY journal
"""


def _stem_steps() -> str:
    """CTEs from ``words(w)`` to ``stems(w, stem)``: the steps of the published
    Spanish stemmer, one CTE each."""
    from tessera.functions import stem as st

    def ends(x: str, endings: str) -> str:
        return f"regexp_extract({x}, '(?:{endings})$')"

    def first(x: str) -> str:
        found = f"length(regexp_extract({x}, '^.*?{st.VOWEL}{st.CONSONANT}'))"
        return f"CASE WHEN {found} > 0 THEN {found} ELSE length({x}) END"

    def less(x: str, endings: str) -> str:
        return f"left({x}, r2) || regexp_replace(substr({x}, r2 + 1), '(?:{endings})$', '')" if endings else x

    standard = " ".join(f"WHEN regexp_full_match(t, '{endings}') AND length(h) >= r2 THEN "
                        + (f"h || '{instead}'" if instead else less("h", before)) for endings, instead, before in st.STANDARD)
    rv = f"length(regexp_extract(w, '^(?:.{st.CONSONANT}+{st.VOWEL}|{st.VOWEL}{{2,}}{st.CONSONANT}|{st.CONSONANT}{st.VOWEL}.)'))"
    return f"""
reg1 AS (SELECT w, {first("w")} AS r1, CASE WHEN {rv} > 0 THEN {rv} ELSE length(w) END AS rv FROM words),
reg AS (SELECT *, r1 + {first("substr(w, r1 + 1)")} AS r2 FROM reg1),
p0 AS (SELECT *, {ends("w", st.PRONOUN)} AS t FROM reg),
p1 AS (SELECT *, left(w, length(w) - length(t)) AS h FROM p0),
p2 AS (SELECT *, {ends("h", st.BEFORE_PRONOUN)} AS g FROM p1),
s0 AS (
  SELECT w, r1, r2, rv, CASE WHEN t <> '' AND g <> '' AND length(h) - length(g) >= rv AND (g <> 'yendo' OR ends_with(h, 'uyendo'))
                             THEN left(h, length(h) - length(g)) || translate(g, '{st.ACCENTED}', '{st.PLAIN}') ELSE w END AS x FROM p2),
n0 AS (SELECT *, {ends("x", st.ALL_STANDARD)} AS t FROM s0),
n1 AS (SELECT *, left(x, length(x) - length(t)) AS h FROM n0),
s1 AS (SELECT w, rv, x AS before, CASE WHEN t = '' THEN x WHEN t = '{st.AMENTE}' AND length(h) >= r1 THEN {less("h", st.BEFORE_AMENTE)} {standard} ELSE x END AS x FROM n1),
v0 AS (SELECT *, {ends("substr(x, rv + 1)", st.VERB_Y)} AS y, {ends("substr(x, rv + 1)", st.VERB + "|" + st.VERB_SHORT)} AS o FROM s1),
s2 AS (
  SELECT w, rv, CASE WHEN x <> before THEN x WHEN y <> '' AND ends_with(left(x, length(x) - length(y)), 'u') THEN left(x, length(x) - length(y))
                     WHEN regexp_full_match(o, '{st.VERB_SHORT}') AND ends_with(left(x, length(x) - length(o)), 'gu') THEN left(x, length(x) - length(o) - 1)
                     ELSE left(x, length(x) - length(o)) END AS x FROM v0),
f0 AS (SELECT *, {ends("substr(x, rv + 1)", st.RESIDUAL + "|" + st.RESIDUAL_E)} AS t FROM s2),
stems AS (
  SELECT w, translate(CASE WHEN regexp_full_match(t, '{st.RESIDUAL_E}') AND ends_with(left(x, length(x) - length(t)), 'gu') AND length(x) - length(t) > rv
                           THEN left(x, length(x) - length(t) - 1) ELSE left(x, length(x) - length(t)) END, '{st.ACCENTED}', '{st.PLAIN}') AS stem FROM f0)"""


Q45 = f"""
WITH toks AS (SELECT doc_id, {TOKENS.format(c='text')} AS tokens FROM documents),
rows AS (SELECT doc_id, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS token FROM toks),
vocab AS (SELECT DISTINCT token FROM rows),
lemmas AS (
  SELECT v.token, substr(v.token, 1, length(v.token) - 1) AS lemma FROM vocab v
  WHERE ends_with(v.token, 's') AND length(v.token) >= 4
    AND substr(v.token, 1, length(v.token) - 1) IN (SELECT token FROM vocab)),
words AS (SELECT token AS w FROM vocab UNION SELECT lemma FROM lemmas),
{_stem_steps()},
forms AS (
  SELECT v.token, s.stem, b.stem AS both_stem FROM vocab v LEFT JOIN lemmas l ON l.token = v.token
  JOIN stems s ON s.w = v.token JOIN stems b ON b.w = coalesce(l.lemma, v.token)),
normed AS (SELECT r.doc_id, r.pos, f.stem, f.both_stem FROM rows r JOIN forms f USING (token))
SELECT d.doc_id, coalesce(string_agg(n.stem, ' ' ORDER BY n.pos), '') AS stemmed,
       coalesce(string_agg(n.both_stem, ' ' ORDER BY n.pos), '') AS lemma_stemmed
FROM documents d LEFT JOIN normed n USING (doc_id)
GROUP BY d.doc_id
"""

Q46 = """
WITH b AS (
  SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '#42'), 1, 8))::BIGINT % 10000 AS INTEGER) AS bucket
  FROM documents, (VALUES (0), (1)) AS c(copy)),
n AS (SELECT count(*) AS n, CAST(ceil(count(*) / 5.0) AS BIGINT) AS t FROM b),
cut AS (SELECT n, t, CAST(ceil((n - t) / 5.0) AS BIGINT) AS v FROM n),
r AS (SELECT bucket, row_number() OVER (ORDER BY bucket, doc_id) AS k FROM b),
s AS (SELECT bucket, CASE WHEN k <= t THEN 'test' WHEN k <= t + v THEN 'val' ELSE 'train' END AS split FROM r, cut)
SELECT split, count(*) AS n, max(bucket) AS last_bucket FROM s GROUP BY split
"""

Q47 = "WITH " + RESULTS_CTE + """,
ok AS (
  SELECT conv_id, turn,
         list_filter(list_transform(list_filter(list_transform(regexp_split_to_array(content, '\\r\\n|\\r|\\n'),
                       lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '' AND contains(s, chr(9))),
                     lambda s: string_split(s, chr(9))), lambda p: len(p) >= 2) AS parts
  FROM res WHERE status_code = 200),
t AS (SELECT conv_id, max(turn) + 1 AS total_chunks FROM conversations GROUP BY conv_id)
SELECT t.conv_id, t.total_chunks,
       CAST(coalesce((SELECT sum(len(parts)) FROM ok WHERE ok.conv_id = t.conv_id), 0) AS INTEGER) AS n_tokens,
       coalesce((SELECT string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FROM generate_series(0, t.total_chunks - 1) g(i)
                 WHERE i NOT IN (SELECT turn FROM ok WHERE ok.conv_id = t.conv_id)), '') AS missing
FROM t
"""

Q48 = "WITH " + LABEL_ORDERS_CTES + """
SELECT pmid, 'said "hi", ok' || chr(10) || title AS title, year,
       CASE WHEN level1_codes = '' THEN '[]' ELSE '["' || replace(level1_codes, ',', '","') || '"]' END AS level1_codes,
       major_subjects_count, nullif(level1_names, '') AS level1_categories_str
FROM named
"""

Q49 = """
WITH s AS (SELECT o_orderstatus AS k, count(*) AS n FROM orders GROUP BY k),
y AS (SELECT year(o_orderdate) AS k, count(*) AS n FROM orders GROUP BY k ORDER BY n DESC, k LIMIT 10),
j AS (SELECT o_orderpriority AS k, count(*) AS n FROM orders GROUP BY k ORDER BY n DESC, k LIMIT 20)
SELECT count(*) AS total_articles, CAST(min(year(o_orderdate)) AS INTEGER) AS year_earliest, CAST(max(year(o_orderdate)) AS INTEGER) AS year_latest,
       round(avg(o_totalprice), 2) AS avg_abstract_length, count(*) FILTER (WHERE o_orderstatus = 'F') AS structured_abstracts,
       (SELECT string_agg(k || ':' || n, ',' ORDER BY k || ':' || n) FROM s) AS language_distribution,
       (SELECT string_agg(k || ':' || n, ',' ORDER BY k || ':' || n) FROM y) AS top_years,
       (SELECT string_agg(k || ':' || n, ',' ORDER BY k || ':' || n) FROM j) AS top_journals,
       'final:1' AS collection_stats
FROM orders
"""

Q50 = """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority = '5-LOW' THEN 'failed' ELSE 'in_progress' END AS status, count(*) AS count
FROM orders GROUP BY status
"""

ORACLES.update({
    "q50_status_classes": Q50,
    "q40_gated_union": Q40, "q41_subject_filter": Q41, "q42_new_ids": Q42, "q43_single_labels": Q43, "q44_report": Q44,
    "q45_stem_modes": Q45, "q46_split_exact": Q46, "q47_chunk_redelivery": Q47, "q48_category_csv": Q48, "q49_corpus_statistics": Q49,
})

# The same white space as on the Spark side, inside classes and alone.
ORACLES.update({k: v.replace("_\\s]", "_" + fv.WHITESPACE + "]").replace("\\s", "[" + fv.WHITESPACE + "]") for k, v in ORACLES.items()
                if k != "q29_page_extract"})  # markup has ASCII space only
