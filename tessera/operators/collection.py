"""Id collection across search strategies.

Each strategy yields a one-column id DataFrame.  The union keeps, for every
id, the first strategy (by rank) that found it -- ``min_by`` over one
shuffle on the id with map-side partial aggregation -- which gives the
"new ids per strategy" counts without a chain of anti joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import anti_join
from tessera.session import reusable


def tag_strategies(strategies: Sequence[tuple[str, DataFrame]], id_col: str = "id") -> DataFrame:
    """All ids of all strategies with ``(strategy, rank)``, duplicates kept (the 'searched' rows)."""
    out = None
    for rank, (name, ids) in enumerate(strategies):
        tagged = ids.select(F.col(id_col).alias(id_col), F.lit(name).alias("strategy"), F.lit(rank).alias("rank"))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def union_strategies(strategies: Sequence[tuple[str, DataFrame]], id_col: str = "id") -> DataFrame:
    """I1 + G3: distinct ids, each with the first strategy that found it."""
    tagged = tag_strategies(strategies, id_col)
    return tagged.groupBy(id_col).agg(
        F.min("rank").alias("rank"), F.min_by("strategy", "rank").alias("strategy"))


def strategy_counts(strategies: Sequence[tuple[str, DataFrame]], id_col: str = "id") -> DataFrame:
    """I3 + D8: per strategy, ids searched (with duplicates) and ids new to the union."""
    tagged = tag_strategies(strategies, id_col)
    searched = tagged.groupBy("strategy", "rank").agg(F.count("*").alias("searched"))
    new = union_strategies(strategies, id_col).groupBy("strategy").agg(F.count("*").alias("new"))
    return searched.join(new, "strategy", "left").select(
        "strategy", "rank", "searched", F.coalesce("new", F.lit(0)).alias("new"))


def new_ids(candidates: DataFrame, seen: DataFrame, id_col: str = "id") -> DataFrame:
    """``candidates - seen`` as a left anti join."""
    return anti_join(candidates.select(id_col).distinct(), seen.select(id_col), id_col)


def gated_union(
    strategies: Sequence[tuple[str, DataFrame]],
    target: int,
    id_col: str = "id",
) -> tuple[DataFrame, list[str]]:
    """Run strategies in order while the distinct total is below ``target``.

    A strategy is skipped once the target is reached (checked between
    strategies); nothing is truncated.  The ids that a strategy adds are
    written once and counted once.  Returns the union (``id``, ``strategy``,
    ``rank`` of the first strategy that found it) and the names of those that
    ran.
    """
    found, ran, total = None, [], 0
    for rank, (name, ids) in enumerate(strategies):
        if total >= target:
            break
        fresh = new_ids(ids, found, id_col) if found is not None else ids.select(id_col).distinct()
        fresh = reusable(fresh.select(id_col, F.lit(name).alias("strategy"), F.lit(rank).alias("rank")))
        total += fresh.count()
        found = fresh if found is None else found.unionByName(fresh)
        ran.append(name)
    return found, ran
