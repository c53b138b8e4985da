"""Train/validation/test splits and label matrices.

Split membership is a pure function of the row id: a seeded hash bucket in
``[0, 10000)``, so both split kinds (single-label and multi-label) get the
same membership, nothing shuffles, and re-runs are reproducible.  The
proportions follow two successive 20 % cuts: test = 20 %, validation = 20 %
of the rest (16 %), train = 64 %.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import fixed_values as fv
from tessera.functions import text as tx

BUCKETS = 10000


# ---------------------------------------------------------------- J9-J11
def first_category(c: Column | str) -> Column:
    """First ``;``-separated item, stripped."""
    col = F.col(c) if isinstance(c, str) else c
    return tx.strip_ws(F.split(col, ";")[0])


def category_list(c: Column | str) -> Column:
    """All ``;``-separated items, stripped."""
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(F.split(col, ";"), tx.strip_ws)


def category_column_name(name: str) -> str:
    """A category name as a column name."""
    clean = name.replace(" ", "_").replace(",", "").replace("(", "").replace(")", "").replace("-", "_")
    return f"category_{clean}"


# ---------------------------------------------------------------- K6
def split_bucket(id_col: Column | str, seed: int = fv.SPLIT_SEED) -> Column:
    """Seeded hash bucket of an id in ``[0, 10000)``."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.conv(F.substring(F.md5(F.concat(col.cast("string"), F.lit(f"#{seed}"))), 1, 8), 16, 10)
    return (h.cast("long") % BUCKETS).cast("int")


def split_of(bucket: Column, test: float = fv.TEST_FRACTION, val: float = fv.VAL_FRACTION) -> Column:
    test_cut = int(round(test * BUCKETS))
    val_cut = test_cut + int(round(val * (1 - test) * BUCKETS))
    return (
        F.when(bucket < test_cut, F.lit("test"))
        .when(bucket < val_cut, F.lit("val"))
        .otherwise(F.lit("train"))
    )


def assign_splits(df: DataFrame, id_col: str, seed: int = fv.SPLIT_SEED,
                  test: float = fv.TEST_FRACTION, val: float = fv.VAL_FRACTION) -> DataFrame:
    """K6: add ``bucket`` and ``split`` (no shuffle; same ids -> same split)."""
    return df.withColumn("bucket", split_bucket(id_col, seed)).withColumn(
        "split", split_of(F.col("bucket"), test, val))


def assign_splits_exact(df: DataFrame, id_col: str, seed: int = fv.SPLIT_SEED,
                        test: float = fv.TEST_FRACTION, val: float = fv.VAL_FRACTION) -> DataFrame:
    """K6, exact-size mode: rows ordered by ``(bucket, id)`` and cut at exact
    counts (test = ceil(n * test), val = ceil(rest * val)).  The dense index is
    computed without a single-partition window (see ``chunking.dense_index``)."""
    from tessera.operators.chunking import dense_index

    with_bucket = df.withColumn("bucket", split_bucket(id_col, seed))
    out = dense_index(with_bucket, ["bucket", id_col], "_idx")
    n = df.count()
    n_test = math.ceil(n * Fraction(str(test)))
    n_val = math.ceil((n - n_test) * Fraction(str(val)))
    idx = F.col("_idx")
    return out.withColumn(
        "split", F.when(idx < n_test, "test").when(idx < n_test + n_val, "val").otherwise("train")).drop("_idx")


def split_sizes(df: DataFrame) -> DataFrame:
    """K8: rows per split."""
    return df.groupBy("split").agg(F.count("*").alias("count"))


# ---------------------------------------------------------------- K4, K5
def single_label(df: DataFrame, categories_str: str = "level1_categories_str") -> DataFrame:
    """K4: ``single_category`` = first category."""
    return df.withColumn("single_category", first_category(categories_str))


def label_classes(df: DataFrame, categories_str: str = "level1_categories_str") -> list[str]:
    """Sorted distinct category names.  The result is the label vocabulary
    (bounded by the thesaurus, not by the corpus) and becomes the column list
    of the matrix, so it is brought to the driver."""
    cats = df.select(F.explode(category_list(categories_str)).alias("c")).distinct().orderBy("c")
    return [r["c"] for r in cats.collect()]


def multilabel_matrix(df: DataFrame, classes: Sequence[str],
                      categories_str: str = "level1_categories_str") -> DataFrame:
    """K5: one 0/1 column per class (``category_<clean name>``), computed in the
    row with ``array_contains`` -- no pivot, no shuffle.  Raises if two classes
    have the same cleaned name."""
    names = [category_column_name(c) for c in classes]
    if len(set(names)) < len(names):
        raise ValueError(f"categories with the same column name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    cats = category_list(categories_str)
    return df.withColumns({
        category_column_name(c): F.array_contains(cats, F.lit(c)).cast("int") for c in classes
    })


def label_counts(df: DataFrame, categories_str: str = "level1_categories_str",
                 total: int | None = None, weight: str | None = None) -> DataFrame:
    """Rows per category and percentage of all rows.  The per-category
    counts are partially aggregated; the row total is one scalar (or passed
    in), used as a literal.  ``weight``: a column with the number of rows that
    a row stands for."""
    each = (F.col(weight) if weight else F.lit(1)).cast("long")
    exploded = df.select(each.alias("n"), F.explode(category_list(categories_str)).alias("category"))
    counts = exploded.groupBy("category").agg(F.sum("n").alias("count"))
    n = (df.agg(F.sum(each)).first()[0] or 0) if total is None else total
    return counts.withColumns({
        "total_samples": F.lit(n).cast("long"),
        "percentage": F.round(F.col("count") * 100.0 / F.lit(n), 4) if n else F.lit(None).cast("double"),
    })
