"""Anti and semi joins.

Join strategies are left to the planner: file statistics and AQE decide what
is small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (E7-E10, ``new - seen``)."""
    return left.join(right, on, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with at least one match in ``right`` (membership filters)."""
    return left.join(right, on, "left_semi")
