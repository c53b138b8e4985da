"""Corpus profiling: group counts, scalar profiles, top-k.

Group tables are ``groupBy(...).count()`` (partial aggregation before the
shuffle); top-k is ``orderBy(...).limit(k)``, which Spark plans as
``TakeOrderedAndProject`` -- a per-partition heap, no full sort.  Ties are
broken on the key so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import fixed_values as fv


def _col(c):
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- D1-D3, D15
def group_counts(df: DataFrame, key: Column | str, name: str = "key", count_name: str = "count") -> DataFrame:
    """``(key, count)`` per distinct key value."""
    return df.groupBy(_col(key).alias(name)).agg(F.count("*").alias(count_name))


def language_distribution(df: DataFrame, language: Column | str = "abstract_language") -> DataFrame:
    """D1."""
    return group_counts(df, language, "language")


def year_counts(df: DataFrame, year: Column | str = "publication_info.year") -> DataFrame:
    """Integer years only."""
    return group_counts(df.where(_col(year).isNotNull()), year, "year")


def journal_counts(df: DataFrame, title: Column | str = "journal.title") -> DataFrame:
    """D3: missing title counts as ``Unknown``."""
    return group_counts(df, F.coalesce(_col(title), F.lit("Unknown")), "journal")


def top_k(df: DataFrame, k: int, count_col: str = "count", key_col: str | None = None) -> DataFrame:
    """H1-H5: the ``k`` largest counts, ties by key ascending."""
    order = [F.desc(count_col)] + ([F.asc(key_col)] if key_col else [])
    return df.orderBy(*order).limit(k)


def head_and_tail(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """H6: first ``n`` and last ``n`` by ``key`` when there are more than ``2n``,
    else everything; ``part`` tells which end a row comes from."""
    first = df.orderBy(F.asc(key)).limit(n).withColumn("part", F.lit("first"))
    last = df.orderBy(F.desc(key)).limit(n).withColumn("part", F.lit("last"))
    cols = [c for c in df.columns if c != key]
    return first.unionByName(last).groupBy(key).agg(
        *[F.first(c).alias(c) for c in cols], F.min("part").alias("part"))


def sample_first(df: DataFrame, n: int, key: str) -> DataFrame:
    """H8: first ``n`` rows by key (deterministic sample for previews)."""
    return df.orderBy(key).limit(n)


# ---------------------------------------------------------------- D4-D7, D9
def corpus_profile(
    df: DataFrame,
    year: Column | str = "publication_info.year",
    word_count: Column | str = "abstract.word_count",
    structured: Column | str = "abstract.structured",
) -> DataFrame:
    """One-pass scalar profile -- count, year range, mean length, structured count."""
    return df.agg(*corpus_profile_columns(year, word_count, structured))


#: Columns of :func:`corpus_profile` and their types.
PROFILE = {"total_articles": "long", "year_earliest": "int", "year_latest": "int", "avg_abstract_length": "double", "structured_abstracts": "long"}


def corpus_profile_columns(year: Column | str, word_count: Column | str = "abstract.word_count",
                           structured: Column | str = "abstract.structured") -> list[Column]:
    values = (F.count("*"), F.min(_col(year)), F.max(_col(year)), F.avg(_col(word_count)),
              F.count_if(F.coalesce(_col(structured), F.lit(False))))
    return [v.alias(n) for v, n in zip(values, PROFILE)]


def corpus_statistics(
    df: DataFrame,
    year: Column | str = "publication_info.year",
    journal: Column | str = "journal.title",
    language: Column | str = "abstract_language",
    stage_counts: dict[str, int] | None = None,
    word_count: Column | str = "abstract.word_count",
    structured: Column | str = "abstract.structured",
) -> DataFrame:
    """The whole statistics record as one row: the D4-D6 profile, the
    language distribution, the 10 most frequent years and 20 most frequent
    journals as maps, and the counts of the collection stages.

    One scan: years, journals, languages and the whole are grouping sets of the
    same aggregation; only its rows, one per distinct value, are ranked."""
    base = df.select(_col(year).alias("y"), F.coalesce(_col(journal), F.lit("Unknown")).alias("j"), _col(language).alias("l"),
                     _col(year).alias("of"), _col(word_count).alias("w"), _col(structured).alias("s"))
    groups = base.groupingSets([["y"], ["j"], ["l"], []], "y", "j", "l").agg(
        *corpus_profile_columns("of", "w", "s"), F.grouping("y").alias("no_y"), F.grouping("j").alias("no_j"), F.grouping("l").alias("no_l"))
    limits = {"top_years": ("y", 10), "top_journals": ("j", 20), "language_distribution": ("l", None)}
    stat = F.lit("all")
    for name, (c, _) in limits.items():
        stat = F.when(F.col(f"no_{c}") == 0, F.when(F.col(c).isNotNull(), name)).otherwise(stat)
    ranked = groups.withColumn("stat", stat).where("stat IS NOT NULL").withColumn("rank", F.row_number().over(
        Window.partitionBy("stat").orderBy(F.desc("total_articles"), "y", "j", "l")))
    of = {name: (F.col("stat") == name) & ((F.col("rank") <= k) if k else F.lit(True)) for name, (_, k) in limits.items()}
    key = F.coalesce(F.col("y").cast("string"), F.col("j").cast("string"), F.col("l").cast("string"))
    maps = [F.map_from_entries(F.collect_list(F.when(of[s], F.struct(key.alias("key"), F.col("total_articles").alias("count"))))).alias(s)
            for s in ("language_distribution", "top_years", "top_journals")]
    scalars = [F.max(F.when(F.col("stat") == "all", F.col(n))).alias(n) for n in PROFILE]
    counts = F.create_map(*[x for k, v in (stage_counts or {}).items() for x in (F.lit(k), F.lit(int(v)).cast("long"))]).cast("map<string,bigint>")
    out = ranked.agg(*scalars, *maps)
    return out.select(
        *[(F.coalesce(F.col(n), F.lit(0)) if t == "long" else F.col(n)).cast(t).alias(n) for n, t in PROFILE.items()],
        "language_distribution", "top_years", "top_journals", counts.alias("collection_stats"))


def language_summary(df: DataFrame, language: Column | str = "abstract_language") -> DataFrame:
    """Spanish / english / other counts and percentages (null when empty)."""
    lang = _col(language)
    total = F.count("*")
    sp = F.count_if(lang == fv.LANG_SPANISH)
    en = F.count_if(lang == fv.LANG_ENGLISH)
    other = total - sp - en
    pct = lambda x: F.when(total > 0, F.round(x * 100.0 / total, 1))
    return df.agg(
        total.alias("total"), sp.alias("spanish"), en.alias("english"), other.alias("other"),
        pct(sp).alias("spanish_pct"), pct(en).alias("english_pct"), pct(other).alias("other_pct"),
    )


# ---------------------------------------------------------------- D11-D12
def coverage_stats(
    labelled: DataFrame,
    categories_str: str = "level1_categories_str",
    translation: str = "spanish_abstract",
    weight: str | None = None,
) -> DataFrame:
    """D11 + D12: coverage of categories and translations (percentages null on
    an empty input instead of dividing by zero).  ``weight``: a column with the
    number of articles that a row stands for."""
    n = F.col(weight) if weight else F.lit(1)

    def count_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("long")

    total = count_where(F.lit(True))
    with_cat = count_where(F.length(categories_str) > 0)
    with_tr = count_where(F.length(translation) > 0)
    pct = lambda x: F.when(total > 0, F.round(x * 100.0 / total, 4))
    return labelled.agg(
        total.alias("total_articles"),
        with_cat.alias("articles_with_categories"),
        with_tr.alias("articles_with_translation"),
        pct(with_cat).alias("coverage_percentage"),
        pct(with_tr).alias("translation_percentage"),
        (total - with_cat).alias("articles_without_categories"),
        pct(total - with_cat).alias("without_categories_percentage"),
    )


def category_frequencies(labelled: DataFrame, categories_str: str = "level1_categories_str", weight: str | None = None) -> DataFrame:
    """Article count per level-1 category name (from the ``'; '``
    strings); ``weight`` as in :func:`coverage_stats`."""
    names = labelled.where(F.length(categories_str) > 0).select(
        (F.col(weight) if weight else F.lit(1)).alias("n"), F.explode(F.split(categories_str, "; ")).alias("category"))
    return names.groupBy("category").agg(F.sum("n").cast("long").alias("count"))


# ---------------------------------------------------------------- D24
def distinct_sketches(df: DataFrame, keys: list[str], value: Column | str, lg_k: int = 12) -> DataFrame:
    """``keys, sketch``: a mergeable count of the distinct values per group, at
    most ``2 ** lg_k`` bytes or so however many there are.  Null values count
    for nothing.  Kept per year or strategy, new rows need only their own."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(_col(value), F.lit(lg_k)).alias("sketch"))


def distinct_estimates(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, distinct`` of sketches merged over all other columns.  The
    standard error is about ``1.04 / sqrt(2 ** lg_k)``: 1.6 % for 12."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("distinct"))


# ---------------------------------------------------------------- D14
def text_profile(df: DataFrame, column: str, processed: str) -> DataFrame:
    """Non-null count and mean length before; non-empty count and mean
    length after (empties count in the 'after' mean, nulls are skipped 'before')."""
    return df.agg(
        F.lit(column).alias("column"),
        F.count(column).alias("non_empty_before"),
        F.avg(F.length(column)).alias("avg_length_before"),
        F.count_if(F.col(processed) != "").alias("non_empty_after"),
        F.avg(F.length(processed)).alias("avg_length_after"),
    )


# ---------------------------------------------------------------- J14
def report_format(df: DataFrame, counts: list[str] = (), percents: list[str] = ()) -> DataFrame:
    """Report text -- counts with thousands separators (``1,234``),
    percentages with one decimal (``12.5``)."""
    cols = {c: F.format_number(F.col(c), 0) for c in counts}
    cols.update({p: F.format_string("%.1f", F.col(p)) for p in percents})
    return df.withColumns(cols)
