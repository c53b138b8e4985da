"""Ordered per-group helpers that stay parallel when one group is huge (G2, lag).

A plain ``Window.partitionBy(key)`` sends a whole group to one task.  When the
caller can name a *segment* column -- any value that is non-decreasing along
the group's order, such as a day bucket of a timestamp or ``line // 100000``
-- the work is split per ``(key, segment)`` and only a tiny per-segment table
(one row per segment) is ordered per key to stitch segments together:

* positions: local ``row_number`` + the running total of earlier segment sizes;
* previous value: local ``lag`` + the last value of the preceding segment.

Without a segment column the plain window is used (right when a group is one
input row, e.g. a token file read whole).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positions(
    df: DataFrame,
    key: str,
    order_cols: Sequence[str],
    segment: Column | None = None,
    out: str = "ord",
) -> DataFrame:
    """1-based position of each row inside its ``key`` group."""
    order = [F.col(c) for c in order_cols]
    if segment is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    d = df.withColumn("_seg", segment)
    d = d.withColumn("_local", F.row_number().over(Window.partitionBy(key, "_seg").orderBy(*order)))
    sizes = d.groupBy(key, "_seg").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(key, "_seg", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        d.join(offsets, [key, "_seg"])
        .withColumn(out, (F.col("_local") + F.col("_off")).cast("int"))
        .drop("_seg", "_local", "_off")
    )


def previous_value(
    df: DataFrame,
    key: str,
    order_cols: Sequence[str],
    value_col: str,
    segment: Column | None = None,
    out: str = "prev",
) -> DataFrame:
    """``lag(value_col)`` inside each ``key`` group in ``order_cols`` order."""
    order = [F.col(c) for c in order_cols]
    if segment is None:
        return df.withColumn(out, F.lag(value_col).over(Window.partitionBy(key).orderBy(*order)))
    w = Window.partitionBy(key, "_seg").orderBy(*order)
    d = df.withColumn("_seg", segment)
    d = d.withColumn(out, F.lag(value_col).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = d.groupBy(key, "_seg").agg(F.max_by(value_col, F.struct(*order)).alias("_last"))
    carry = last.select(key, "_seg", F.lag("_last").over(Window.partitionBy(key).orderBy("_seg")).alias("_carry"))
    return (
        d.join(carry, [key, "_seg"])
        .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out)))
        .drop("_seg", "_first", "_carry")
    )


def positions_and_previous(
    df: DataFrame,
    key: str,
    order_cols: Sequence[str],
    value_col: str,
    segment: Column | None = None,
    out_pos: str = "ord",
    out_prev: str = "prev",
) -> DataFrame:
    """:func:`positions` and :func:`previous_value` in one pass: one window
    per ``(key, segment)`` and one per-segment table (size and last value)
    stitched with a single join."""
    order = [F.col(c) for c in order_cols]
    if segment is None:
        w = Window.partitionBy(key).orderBy(*order)
        return df.withColumn(out_pos, F.row_number().over(w)).withColumn(out_prev, F.lag(value_col).over(w))
    w = Window.partitionBy(key, "_seg").orderBy(*order)
    d = (df.withColumn("_seg", segment)
         .withColumn("_local", F.row_number().over(w))
         .withColumn(out_prev, F.lag(value_col).over(w)))
    seg = d.groupBy(key, "_seg").agg(F.count("*").alias("_n"), F.max_by(value_col, F.struct(*order)).alias("_last"))
    ws = Window.partitionBy(key).orderBy("_seg")
    stitch = seg.select(
        key, "_seg",
        F.coalesce(F.sum("_n").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.lag("_last").over(ws).alias("_carry"),
    )
    return (
        d.join(stitch, [key, "_seg"])
        .withColumn(out_pos, (F.col("_local") + F.col("_off")).cast("int"))
        .withColumn(out_prev, F.when(F.col("_local") == 1, F.col("_carry")).otherwise(F.col(out_prev)))
        .drop("_seg", "_local", "_off", "_carry")
    )
