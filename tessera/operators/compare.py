"""Dataset comparison by member name.

One full outer join on the name with side flags gives every count and both
"missing" lists in a single shuffle; the per-row side tag is what the
anti joins / set differences would produce separately.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.profile import head_and_tail


def membership(a: DataFrame, b: DataFrame, key: str = "name") -> DataFrame:
    """``(name, in_a, in_b, side)`` for the union of both name sets."""
    left = a.select(key).distinct().withColumn("in_a", F.lit(True))
    right = b.select(key).distinct().withColumn("in_b", F.lit(True))
    j = left.join(right, key, "full_outer")
    in_a = F.coalesce("in_a", F.lit(False))
    in_b = F.coalesce("in_b", F.lit(False))
    return j.select(
        key, in_a.alias("in_a"), in_b.alias("in_b"),
        F.when(in_a & in_b, "both").when(in_a, "only_a").otherwise("only_b").alias("side"),
    )


def completeness(members: DataFrame) -> DataFrame:
    """Sizes of A, B, A∩B, A-only, B-only and ``common / |A| * 100`` (null for empty A)."""
    a = F.count_if("in_a")
    both = F.count_if(F.col("in_a") & F.col("in_b"))
    return members.agg(
        a.alias("size_a"),
        F.count_if("in_b").alias("size_b"),
        both.alias("common"),
        F.count_if(F.col("in_a") & ~F.col("in_b")).alias("only_a"),
        F.count_if(F.col("in_b") & ~F.col("in_a")).alias("only_b"),
        F.when(a > 0, F.round(both * 100.0 / a, 4)).alias("completeness_pct"),
    )


def missing(members: DataFrame, side: str, key: str = "name") -> DataFrame:
    """Names present only on ``side`` (``only_a`` or ``only_b``)."""
    return members.where(F.col("side") == side).select(key)


def missing_preview(members: DataFrame, side: str, key: str = "name", n: int = 10) -> DataFrame:
    """H6: first and last ``n`` missing names when there are more than ``2n``."""
    return head_and_tail(missing(members, side, key), key, n)
