"""Mixing sources to target weights by iterative proportional fitting
(operator 5).

Documents fall into cells of source, language and topic.  The tokens of the
cells are raked: scaled along one margin after the other until the sums match
every target.  Raked over own tokens is a cell's weight, and a document is
sampled with a probability in proportion to it, by a hash of its id, so that
the expected tokens of the sample have the target shares.  A token rate can be
asked for; cells too small for it are then taken whole.

Only the cells' table goes round the loop, as DataFrames; documents are read
once to fill the cells and once to be sampled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage, words

MARGINS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    """Coarse topic by form: tables, symbol noise, short notes, prose."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(t.rlike(r"\|[^|]{1,80}\|[^|]{1,80}\|"), "table")
            .when(t.rlike(r"[#*$%&<>]{3}"), "symbols")
            .when(F.length(t) < 800, "note").otherwise("prose"))


def _value(c: Column) -> Column:
    """Text of a margin's value; null becomes a value that no text has."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def margin_targets(cells: DataFrame, margin: str, aim: float | Mapping[str, float] | DataFrame) -> DataFrame:
    """Rows ``value, target`` with shares that sum to 1.  ``aim`` is a power
    (targets are own tokens to that power: 1 keeps the mix, 0 makes all values
    equal), weights by name, or a table ``value, weight`` with a value once
    (null stands for null); values not named then have weight 0."""
    own = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("own")).filter("own > 0")
    if isinstance(aim, DataFrame):
        own = own.join(aim.select(_value(F.col("value")).alias("value"), F.col("weight").cast("double").alias("asked")), "value", "left")
        weight = F.coalesce("asked", F.lit(0.0))
    elif isinstance(aim, Mapping):
        weight = F.lit(0.0)
        for name, w in aim.items():
            weight = F.when(F.col("value") == F.lit("=" + name), F.lit(float(w))).otherwise(weight)
    else:
        weight = F.pow("own", F.lit(float(aim)))
    weighed = own.select("value", weight.alias("w"))
    total = weighed.agg(F.sum("w")).first()[0] or 1.0
    return weighed.select("value", (F.col("w") / F.lit(float(total))).alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = 1e-6, max_rounds: int = 100) -> DataFrame:
    """``cells`` (margins, ``tokens``) plus ``raked``: tokens scaled so that the
    sums along each margin have the target shares, and ``gap``, by how much of
    its target the share that is off most misses it.  Ends when ``gap`` is at
    most ``tolerance``, when a round brings no gain (targets that contradict
    each other), or after ``max_rounds``; a larger ``gap`` tells of the last two."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    state, off = stage(cells.withColumn("raked", F.col("tokens").cast("double")), "raked"), float("inf")
    for _ in range(max_rounds if total else 0):
        for margin, target in targets.items():
            sums = state.groupBy(F.col(margin).alias("value")).agg(F.sum("raked").alias("sum"))
            factor = (target.join(sums, "value").filter("sum > 0")
                      .select(F.col("value").alias(margin), (F.col("target") * F.lit(float(total)) / F.col("sum")).alias("factor")))
            state = state.join(factor, margin, "left").withColumn("raked", F.col("raked") * F.coalesce("factor", F.lit(0.0))).drop("factor")
        state = stage(state, "raked")
        gaps = []
        for margin, target in targets.items():
            sums = state.groupBy(F.col(margin).alias("value")).agg(F.sum("raked").alias("sum"))
            gap = F.abs(F.col("sum") / F.lit(float(total)) - F.col("target")) / F.greatest("target", F.lit(1e-12))
            gaps.append(target.filter("target > 0").join(sums, "value").agg(F.max(gap)).first()[0] or 0.0)
        before, off = off, max(gaps)
        if off <= tolerance or off >= before:
            break
    return state.withColumn("gap", F.lit(float(off) if total else 0.0))


def scale_to(cells: DataFrame, rate: float) -> float:
    """Factor by which ``sum(tokens * least(1, factor * weight))`` over ``cells``
    is ``rate`` of all tokens.  Cells that reach 1 are taken whole and the others
    share what is left, until no more cells reach 1; if all do, the rate cannot
    be met and every cell with a weight is whole."""
    budget, factor = rate * (cells.agg(F.sum("tokens")).first()[0] or 0), 0.0
    while True:
        whole = F.col("weight") * F.lit(factor) >= 1
        taken, rest = cells.filter("weight > 0").agg(
            F.sum(F.when(whole, F.col("tokens"))), F.sum(F.when(~whole, F.col("weight") * F.col("tokens")))).first()
        if not rest or (budget - (taken or 0)) / rest <= factor * (1 + 1e-12):
            return factor
        factor = (budget - (taken or 0)) / rest


#: Share of all tokens that the query and the pipeline keep.
RATE = 0.75

#: Powers of the default targets: sources are evened out most.
AIMS = {"source": 0.8, "lang": 0.9, "topic": 0.95}


def sample_documents(docs: DataFrame, aims: Mapping[str, float | Mapping[str, float] | DataFrame] = AIMS, text: str = "text",
                     doc_id: str = "doc_id", source: str = "source", lang: str = "lang", topic: Column | None = None,
                     seed: int = 42, rate: float | None = None) -> DataFrame:
    """``docs`` plus ``topic``, ``n_tokens`` (words), ``weight`` (raked over own
    tokens of the document's cell), ``probability``, ``sampled`` and
    ``target_gap``, the same in all rows: how far the raking stayed from the
    target it missed most, as a share of it (see :func:`rake`).

    With a ``rate`` the expected tokens of the sample are that share of all
    tokens: probabilities are weights times one factor, 1 at most, so a cell
    that is rarer than its target is taken whole and does not shrink the rest.
    Without, they are weights over the largest weight: expected shares are
    exact, and the least cell decides how much is kept.

    Null sources and languages are values of their own; a document without a
    word costs no tokens and is kept; equal ids with equal texts are drawn
    alike; an empty table gives an empty table; columns of ``docs`` with one of
    the six names are replaced."""
    names = ["topic", "n_tokens", "weight", "probability", "sampled", "target_gap"]
    plain = docs.drop(*names)
    rows = plain.withColumns({
        "topic": topic_of(F.col(text)) if topic is None else topic, "n_tokens": F.size(words(F.col(text))).cast("long")})
    rows = rows.withColumns({"__source": _value(F.col(source)), "__lang": _value(F.col(lang)), "__topic": _value(F.col("topic"))})
    key = ["__source", "__lang", "__topic"]
    cells = stage(rows.groupBy(*[F.col(k).alias(m) for k, m in zip(key, MARGINS)]).agg(F.sum("n_tokens").alias("tokens")), "cells")
    targets = {m: stage(margin_targets(cells, m, aims[m]), f"target_{m}") for m in MARGINS if m in aims}
    raked = rake(cells, targets)
    weighed = raked.select(*[F.col(m).alias(k) for k, m in zip(key, MARGINS)],
                           "tokens", F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).alias("weight"), F.col("gap").alias("target_gap"))
    if rate is None:
        factor = 1 / (weighed.agg(F.max("weight")).first()[0] or 1.0)
    else:
        factor = scale_to(weighed, rate)
    probability = F.least(F.lit(1.0), F.col("weight") * F.lit(float(factor)))
    cell = stage(weighed.withColumn("probability", probability).drop("tokens"), "cell_probabilities")
    draw = F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.col(text), F.lit(seed)), 11) / float(1 << 53)
    free = F.col("n_tokens") == 0
    return (rows.join(cell, key, "left").drop(*key)
            .withColumn("probability", F.when(free, F.lit(1.0)).otherwise(F.coalesce("probability", F.lit(0.0))))
            .withColumn("sampled", draw < F.col("probability"))
            .select(*plain.columns, *names))
