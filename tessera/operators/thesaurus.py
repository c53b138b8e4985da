"""Thesaurus hierarchy and category labelling.

Data model (three small tables, sized by the vocabulary, not by the corpus):

* ``descriptor(ui, name)``           -- one row per descriptor id
* ``descriptor_tree(ui, tree_number, ord)`` -- tree numbers of each descriptor;
  ``ord`` is the descriptor's position in the source (first occurrence)
* ``tree_name(code, name)``          -- name of every root letter and prefix

Labelling takes each article's distinct major descriptor ids, joins the
``ui -> categories`` table (one row per ui), gathers the category arrays per
article and joins the result back, so articles without a major descriptor
keep a row with empty category lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import fixed_values as fv
from tessera.operators.quality import major_terms_only


# ---------------------------------------------------------------- F2 / E4
def root_categories(spark: SparkSession) -> DataFrame:
    """the 16 fixed root letters and their names."""
    return spark.createDataFrame(fv.ROOT_CATEGORIES, "code string, name string")


# ---------------------------------------------------------------- F4
def level1_code(tree_number: Column) -> Column:
    """first letter of the first segment (``''`` when the segment is empty)."""
    return F.substring(F.substring_index(tree_number, ".", 1), 1, 1)


def level2_code(tree_number: Column) -> Column:
    """first dotted segment, ``B01.050.150`` -> ``B01``."""
    return F.substring_index(tree_number, ".", 1)


# ---------------------------------------------------------------- F1
def tree_prefixes(tree_number: Column) -> Column:
    """All dotted prefixes of one tree number, shortest first."""
    parts = F.split(tree_number, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, 1, i), "."),
    )


# ---------------------------------------------------------------- E3 / F3
def tree_names(descriptor: DataFrame, descriptor_tree: DataFrame) -> DataFrame:
    """name every root letter and every prefix of every tree number.

    Roots come first and win; other prefixes take the exact-match descriptor
    name (E3), else ``"<root name> (<prefix>)"`` where the root name falls back
    to ``Category_<letter>`` for letters outside the fixed roots (E4).
    Output: ``code, name, exact`` (``exact`` marks E3 hits, used for the
    mapped-count report).

    One aggregation does F1 and E3 together: every tree number is exploded
    into its prefixes; a prefix row whose prefix *is* the tree number carries
    the descriptor's order as the ``min_by`` key, so grouping by prefix gives
    both the distinct closure and the first exact match by source order.
    """
    spark = descriptor.sparkSession
    roots = root_categories(spark)
    named = descriptor.where(F.col("name").isNotNull() & (F.col("name") != "")).select("ui", "name")
    rows = descriptor_tree.select(
        "ui", "tree_number", "ord", F.explode(tree_prefixes(F.col("tree_number"))).alias("code")
    ).join(named, "ui", "left")
    hit = (F.col("code") == F.col("tree_number")) & F.col("name").isNotNull()
    per_code = rows.groupBy("code").agg(F.min_by(F.col("name"), F.when(hit, F.col("ord"))).alias("exact_name"))
    # the 16 fixed roots are a literal table: broadcasting them is bounded
    root_of = F.broadcast(roots.select(F.col("code").alias("root"), F.col("name").alias("root_name")))
    named_codes = (
        per_code.join(F.broadcast(roots.select("code")), "code", "left_anti")
        .join(root_of, F.substring(F.col("code"), 1, 1) == F.col("root"), "left")
        .select(
            "code",
            F.coalesce(
                F.col("exact_name"),
                F.concat(
                    F.coalesce(F.col("root_name"), F.concat(F.lit("Category_"), F.substring("code", 1, 1))),
                    F.lit(" ("), F.col("code"), F.lit(")"),
                ),
            ).alias("name"),
            F.col("exact_name").isNotNull().alias("exact"),
        )
    )
    return roots.withColumn("exact", F.lit(False)).unionByName(named_codes)


# ---------------------------------------------------------------- D10
def thesaurus_stats(descriptor: DataFrame, descriptor_tree: DataFrame, tree_name: DataFrame) -> DataFrame:
    """Term and category counts as a long ``(metric, value)`` table.

    Three independent one-row aggregates are unioned (no join between them)."""
    d = descriptor.agg(F.count("*").alias("value")).select(F.lit("total_terms").alias("metric"), "value")
    t = descriptor_tree.agg(F.count_distinct("ui").alias("value")).select(
        F.lit("terms_with_tree_numbers").alias("metric"), "value")
    n = tree_name.agg(
        F.count("*").alias("total_categories"),
        F.count_if(F.length("code") == 1).alias("main_categories"),
        F.count_if(~F.col("code").contains(".") & (F.length("code") > 1)).alias("level2_categories"),
        F.count_if(F.col("exact")).alias("exact_matches"),
    ).select(F.expr(
        "stack(4, 'total_categories', total_categories, 'main_categories', main_categories, "
        "'level2_categories', level2_categories, 'exact_matches', exact_matches) as (metric, value)"))
    return d.unionByName(t).unionByName(n)


# ---------------------------------------------------------------- E1 / E2 / F5
def ui_categories(descriptor_tree: DataFrame, tree_name: DataFrame) -> DataFrame:
    """E1 + F4 + E2: one row per ``ui`` with its distinct level-1 and level-2
    categories, ``l1`` and ``l2`` (arrays of code and name).

    Codes come from every tree number of a descriptor and are named through
    ``tree_name`` with the ``Unknown_<code>`` default."""
    tn = F.col("tree_number")
    codes = descriptor_tree.select(
        "ui", F.explode(F.array(F.struct(F.lit(1).alias("level"), level1_code(tn).alias("code")),
                                F.struct(F.lit(2).alias("level"), level2_code(tn).alias("code")))).alias("lc"),
    ).select("ui", "lc.level", "lc.code").where(F.col("code") != "").distinct()
    named = codes.join(tree_name.select("code", F.col("name").alias("tname")), "code", "left")
    pair = F.struct("code", F.coalesce("tname", F.concat(F.lit("Unknown_"), F.col("code"))).alias("name"))
    return named.groupBy("ui").agg(F.collect_set(F.when(F.col("level") == 1, pair)).alias("l1"),
                                   F.collect_set(F.when(F.col("level") == 2, pair)).alias("l2"))


def major_descriptor_ids(mesh_terms: Column) -> Column:
    """C11 + dedup: distinct non-empty descriptor ids of major-topic headings.
    Qualifier-level major flags are ignored."""
    uis = F.transform(major_terms_only(mesh_terms), lambda m: m["descriptor"]["ui"])
    return F.array_distinct(F.filter(uis, lambda u: u.isNotNull() & (u != "")))


def categories_per_article(majors: DataFrame, ui_cats: DataFrame, id_col: str = "pmid") -> DataFrame:
    """F5 + F6 over a long table of ``(id, ui)`` major headings (duplicates allowed).

    Output per id: sorted distinct level-1/level-2 codes, their names in code
    order, and the number of distinct major ids (unknown ids count too).  Each
    distinct (id, ui) is joined once; the category arrays of an id's headings
    are flattened and made distinct in the row."""
    joined = majors.select(id_col, "ui").distinct().join(ui_cats, "ui", "left")
    agg = joined.groupBy(id_col).agg(
        F.count("ui").cast("int").alias("major_subjects_count"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("l1")))).alias("_l1"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("l2")))).alias("_l2"))
    return agg.select(
        id_col,
        F.col("_l1.code").alias("level1_codes"), F.col("_l1.name").alias("level1_names"),
        F.col("_l2.code").alias("level2_codes"), F.col("_l2.name").alias("level2_names"),
        "major_subjects_count")


def attach_categories(articles: DataFrame, categories: DataFrame, id_col: str = "pmid") -> DataFrame:
    """one output row per article, also when nothing matched (empty lists, count 0),
    plus the ``'; '``-joined name strings (B10)."""
    empty = F.array().cast("array<string>")
    out = articles.join(categories, id_col, "left")
    return out.select(
        *[c for c in articles.columns],
        F.coalesce("level1_codes", empty).alias("level1_codes"),
        F.coalesce("level1_names", empty).alias("level1_names"),
        F.coalesce("level2_codes", empty).alias("level2_codes"),
        F.coalesce("level2_names", empty).alias("level2_names"),
        F.coalesce("major_subjects_count", F.lit(0)).alias("major_subjects_count"),
    ).withColumns({
        "level1_categories_str": F.array_join("level1_names", "; "),
        "level2_categories_str": F.array_join("level2_names", "; "),
    })


def article_row_projection(articles: DataFrame) -> DataFrame:
    """``pmid, title, year, spanish_abstract`` from nested articles.

    Title is the translated title (``''`` when absent); the abstract text is
    kept only when its translation succeeded."""
    tr = F.col("abstract.spanish_translation")
    return articles.select(
        F.col("pmid"),
        F.coalesce(F.col("title_spanish_translation.translated_title"), F.lit("")).alias("title"),
        F.col("publication_info.year").alias("year"),
        F.when(F.coalesce(tr["success"], F.lit(False)), F.coalesce(tr["text"], F.lit("")))
        .otherwise(F.lit("")).alias("spanish_abstract"),
    )


def label_articles(articles: DataFrame, descriptor_tree: DataFrame, tree_name: DataFrame) -> DataFrame:
    """F7 over nested articles (``mesh_terms`` array): the 11-column category table."""
    majors = articles.select("pmid", F.explode(major_descriptor_ids(F.col("mesh_terms"))).alias("ui"))
    cats = categories_per_article(majors, ui_categories(descriptor_tree, tree_name), "pmid")
    return attach_categories(article_row_projection(articles), cats, "pmid")


def label_from_terms(articles: DataFrame, terms: DataFrame, descriptor_tree: DataFrame, tree_name: DataFrame,
                     id_col: str = "pmid") -> DataFrame:
    """F7 over a long term table ``(id, ui, major_topic)`` -- the shape of a
    normalised heading table; major, non-empty ids only."""
    majors = terms.where(
        F.coalesce(F.col("major_topic"), F.lit(False)) & F.col("ui").isNotNull() & (F.col("ui") != "")
    ).select(id_col, "ui")
    cats = categories_per_article(majors, ui_categories(descriptor_tree, tree_name), id_col)
    return attach_categories(articles, cats, id_col)
