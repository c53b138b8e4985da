"""Filters and predicates (C1-C15) and the per-rule stage counters.

All filters are plain ``Column`` predicates so Catalyst can combine them and
push the pushable parts (flags, years, ids) into the parquet scan.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import fixed_values as fv
from tessera.functions import text as tx
from tessera.operators.joins import semi_join


def _col(c):
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- C1-C4
def require_abstract(has_content: Column | str = "abstract.has_content") -> Column:
    """The abstract has text."""
    return F.coalesce(_col(has_content), F.lit(False))


def require_terms(terms: Column | str = "mesh_terms") -> Column:
    """At least one heading."""
    return F.coalesce(F.size(_col(terms)) > 0, F.lit(False))


def min_words(word_count: Column | str = "abstract.word_count", n: int = fv.MIN_ABSTRACT_WORDS) -> Column:
    """``word_count >= n``."""
    return F.coalesce(_col(word_count) >= F.lit(n), F.lit(False))


def quality_rules(
    has_content: Column | str = "abstract.has_content",
    word_count: Column | str = "abstract.word_count",
    terms: Column | str | None = "mesh_terms",
    n: int = fv.MIN_ABSTRACT_WORDS,
) -> list[tuple[str, Column]]:
    """The quality rules in evaluation order, as ``(name, passes)`` pairs."""
    rules = [("no_abstract", require_abstract(has_content))]
    if terms is not None:
        rules.append(("no_terms", require_terms(terms)))
    rules.append(("too_short", min_words(word_count, n)))
    return rules


def quality_filter(df: DataFrame, **kw) -> DataFrame:
    """C4: keep rows passing every rule (one combined predicate)."""
    return df.where(all_of([p for _, p in quality_rules(**kw)]))


def first_failed_rule(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule a row fails, null when it passes all (D8 helper)."""
    expr = None
    for name, passes in rules:
        expr = F.when(~passes, F.lit(name)) if expr is None else expr.when(~passes, F.lit(name))
    return expr


def stage_counters(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Single-pass counts: rows seen, dropped per rule (first failing
    rule only, as with a sequential filter), and kept."""
    failed = first_failed_rule(rules)
    aggs = [F.count("*").alias("total")]
    aggs += [F.count_if(failed == F.lit(name)).alias(f"dropped_{name}") for name, _ in rules]
    aggs.append(F.count_if(failed.isNull()).alias("final"))
    return df.agg(*aggs)


# ---------------------------------------------------------------- C5-C8
def all_of(predicates: Sequence[Column]) -> Column:
    """AND of predicates (the composable form of a search-query builder)."""
    return functools.reduce(operator.and_, predicates) if predicates else F.lit(True)


def date_in_years(date: Column | str, lo: int, hi: int) -> Column:
    """C6 on a date/timestamp column, written as a range on the column itself
    (``lo-01-01 <= d < (hi+1)-01-01``) so the predicate is pushed into the
    parquet scan and prunes row groups, unlike ``year(d) BETWEEN lo AND hi``."""
    d = _col(date)
    return (d >= F.to_timestamp_ntz(F.lit(f"{lo:04d}-01-01"))) & (d < F.to_timestamp_ntz(F.lit(f"{hi + 1:04d}-01-01")))


def in_listed_years(articles: DataFrame, years: DataFrame, year_col: str = "year") -> DataFrame:
    """C6 on a dataset in year folders (L1): articles of the years of a small
    table.  The list's values reach the scan before it starts (dynamic partition
    pruning), so the folders of other years are not read."""
    listed = years.select(F.col(year_col).alias(year_col)).where(F.col(year_col) > 0).distinct()
    return articles.join(listed, year_col)


def member_of(df: DataFrame, key: str, values: DataFrame, values_key: str) -> DataFrame:
    """Rows whose ``key`` is in a list table (left semi join)."""
    return semi_join(df, values.select(F.col(values_key).alias(key)), key)


def any_term_in(terms: Column | str, subjects: Sequence[str], field=lambda m: m["descriptor"]["name"]) -> Column:
    """Some heading's descriptor name is one of ``subjects``."""
    lst = F.array(*[F.lit(s) for s in subjects])
    return F.exists(_col(terms), lambda m: F.array_contains(lst, field(m)))


# ---------------------------------------------------------------- C9-C12
def abstract_queue_predicate(
    language: Column | str = "abstract_language",
    has_content: Column | str = "abstract.has_content",
    translated_ok: Column | str = "abstract.spanish_translation.success",
    languages: Sequence[str] = (fv.LANG_ENGLISH, fv.LANG_MIXED),
) -> Column:
    """Abstract in a source language, with text, not yet translated."""
    return (
        _col(language).isin(list(languages))
        & F.coalesce(_col(has_content), F.lit(False))
        & ~F.coalesce(_col(translated_ok), F.lit(False))
    )


def major_terms_only(terms: Column | str = "mesh_terms") -> Column:
    """C11: headings whose descriptor is a major topic."""
    return F.filter(_col(terms), lambda m: F.coalesce(m["descriptor"]["major_topic"], F.lit(False)))


def has_categories(c: Column | str = "level1_categories_str") -> Column:
    """Category string present and non-empty."""
    return F.coalesce(F.length(_col(c)) > 0, F.lit(False))


# ---------------------------------------------------------------- C14
COMPLETED = ["completed"]
FAILED = ["failed", "cancelled", "expired"]


def status_class(status: Column | str) -> Column:
    """C14: ``done`` / ``failed`` / ``in_progress`` for batch-job statuses."""
    s = _col(status)
    return (
        F.when(s.isin(COMPLETED), F.lit("done"))
        .when(s.isin(FAILED), F.lit("failed"))
        .otherwise(F.lit("in_progress"))
    )


def ok_result(status_code: Column | str = "response.status_code") -> Column:
    """C14: HTTP-style success of one result line."""
    return F.coalesce(_col(status_code) == 200, F.lit(False))
