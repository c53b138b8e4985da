"""Toxicity by non-negative positive-unlabelled learning (operator 2).

Confirmed toxic texts are the positives; the unlabelled set is every text that
is not held out, toxic ones among them.  With the class prior p, the risk of a
scorer is

    p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-))

and the maximum keeps the estimate of the clean texts' risk from going below
zero, which is where a flexible model would start to learn the positives by
heart.  Models are logistic, over the presence of words.

Words are counted over all these texts by one aggregation, and those whose
shares differ between positives and all texts are the inputs.  Texts, as lists
of such words, are then dealt by hash to blocks of about ``block`` texts.  Each
block trains models with numpy on its own texts against the same positives (a
sample of at most ``max_positives`` labelled texts), and the model is the mean
of all blocks' weights.  So every text is learned from, a task holds one block
at a time, and the driver gets the positives' word lists and one weight a word.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import stage, text_key

LETTERS = re.compile(r"[^\W\d_]+")
UNIT = 1 << 30  # weights are summed as whole multiples of 1 / UNIT, so their order does not matter
MAX_TASKS = 1 << 14


def word_hashes(text: str | None) -> set[int]:
    """Signed 64-bit hashes of the distinct lower-cased letter runs."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    return {h - (1 << 64) if (h := digest(w.encode())) >> 63 else h for w in set(LETTERS.findall((text or "").lower()))}


@F.pandas_udf(T.ArrayType(T.LongType()))
def _features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([np.array(sorted(word_hashes(t)), dtype=np.int64) for t in texts], dtype=object)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _known(place: dict[int, int], text: str | None) -> np.ndarray:
    """Ascending places of the words of ``text`` that ``place`` has."""
    return np.array(sorted(place[h] for h in place.keys() & word_hashes(text)), dtype="<i4")


@dataclass
class Model:
    """``words``: sorted hashes; ``weights``: one for each; ``bias``."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        place = dict(zip(self.words.tolist(), range(len(self.words))))
        return self.scores_of([_known(place, t) for t in texts])

    def scores_of(self, places: list[np.ndarray]) -> np.ndarray:
        """Scores of texts given as ascending places in ``words``."""
        return _sigmoid(np.array([self.bias + self.weights[p].sum() for p in places], dtype=np.float64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class _Rows:
    """Documents as index lists into the chosen words."""

    def __init__(self, docs: list[np.ndarray], words: np.ndarray):
        at = [np.searchsorted(words, d) for d in docs]
        own = [a[(a < len(words)) & (words[np.minimum(a, len(words) - 1)] == d)] if len(words) else a[:0] for a, d in zip(at, docs)]
        self.index = np.concatenate([*own, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(docs)), [len(o) for o in own])
        self.n = len(docs)

    def logits(self, w: np.ndarray, b: float) -> np.ndarray:
        return b + np.bincount(self.row, weights=w[self.index], minlength=self.n)

    def gradient(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, weights=g[self.row], minlength=size)


def differing_words(texts: DataFrame, max_words: int = 20_000, min_docs: int = 5, min_z: float = 4.0) -> np.ndarray:
    """Sorted hashes of the words of ``texts`` (``pos, text``) whose shares of
    the rows with ``pos`` and of all rows differ by at least ``min_z`` standard
    errors and which at least ``min_docs`` rows hold (those with ``pos`` count
    twice); of more than ``max_words`` those that differ most."""
    n_pos, n_all = texts.agg(F.count_if("pos"), F.count(F.lit(1))).first()
    if not n_pos:
        return np.zeros(0, dtype=np.int64)
    counts = (texts.select("pos", F.explode(_features("text")).alias("word")).groupBy("word")
              .agg(F.count_if("pos").alias("a"), F.count(F.lit(1)).alias("b")).filter(F.col("a") + F.col("b") >= min_docs))
    share = (F.col("a") + F.col("b")) / float(n_pos + n_all)
    error = F.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_all)) + 1e-12
    z = F.abs(F.col("a") / n_pos - F.col("b") / n_all) / error
    best = counts.select("word", z.alias("z")).filter(F.col("z") >= min_z).orderBy(F.desc("z"), "word").limit(max_words)
    return np.sort(np.array([r["word"] for r in best.collect()], dtype=np.int64))


def _places(words: np.ndarray, text: Column) -> Column:
    """Places in ``words`` of a text's words: ascending 32-bit numbers."""

    @F.pandas_udf(T.BinaryType())
    def places(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        place = dict(zip(words.tolist(), range(len(words))))
        for texts in batches:
            yield pd.Series([_known(place, t).tobytes() for t in texts], dtype=object)

    return places(text)


def risk_gradient(pos: _Rows, unl: _Rows, theta: np.ndarray, prior: float, decay: float) -> np.ndarray:
    """Gradient by ``theta`` (weights, then the bias) of the non-negative risk
    and ``decay / 2`` times the squared weights.  While the estimate of the
    clean texts' risk is below zero it is that of minus this estimate alone, which climbs back out."""
    size = len(theta) - 1
    sp, su = (_sigmoid(r.logits(theta[:size], theta[size])) for r in (pos, unl))
    clean = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
    toxic_g = prior * (sp - 1) / pos.n
    clean_p, clean_u = -prior * sp / pos.n, su / unl.n
    if clean < 0:
        toxic_g, clean_p, clean_u = 0 * toxic_g, -clean_p, -clean_u
    gp, gu = toxic_g + clean_p, clean_u
    return np.append(pos.gradient(gp, size) + unl.gradient(gu, size) + decay * theta[:size], gp.sum() + gu.sum())


def train(pos: list[np.ndarray], unl: list[np.ndarray], size: int, prior: float, models: int = 3, steps: int = 400,
          rate: float = 0.05, decay: float = 1e-4, seed: int | tuple[int, ...] = 7) -> np.ndarray:
    """``size`` weights, then the bias: the mean of ``models`` logistic models,
    each trained with Adam on the non-negative risk over its own bootstrap of
    the texts, which are lists of places below ``size``."""
    total, own = np.zeros(size + 1), np.arange(size)
    rng = np.random.default_rng(seed)
    for _ in range(models):
        p = _Rows([pos[i] for i in rng.integers(0, len(pos), len(pos))], own)
        u = _Rows([unl[i] for i in rng.integers(0, len(unl), len(unl))], own)
        theta, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
        theta[size] = np.log(prior / (1 - prior))
        for t in range(1, steps + 1):
            g = risk_gradient(p, u, theta, prior, decay)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        total += theta / models
    return total


def train_blocks(texts: DataFrame, n_texts: int, pos: list[np.ndarray], size: int, prior: float, block: int, seed: int) -> np.ndarray:
    """Mean of the weights that ``train`` finds on each block of ``texts``
    (``key, places``); texts are dealt to blocks by a hash of their key."""
    n_blocks = max(1, math.ceil(n_texts / block))

    def learn(part: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "places"])
        theta = train(pos, [np.frombuffer(x, dtype="<i4") for x in rows["places"]], size, prior, seed=(seed, int(part[0])))
        return pd.DataFrame({"place": np.arange(size + 1), "units": np.rint(theta * UNIT).astype(np.int64)})

    dealt = texts.select(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(n_blocks)).alias("part"), "key", "places")
    learnt = dealt.repartition(min(n_blocks, MAX_TASKS), "part").groupBy("part").applyInPandas(learn, "place int, units long")
    mean = learnt.groupBy("place").agg((F.sum("units") / F.count(F.lit(1)) / UNIT).alias("weight")).collect()
    theta = np.zeros(size + 1)
    theta[[r["place"] for r in mean]] = [r["weight"] for r in mean]
    return theta


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
        max_positives: int = 4000, max_words: int = 20_000, block: int = 12_000, prior: float | None = None,
        seed: int = 7) -> tuple[Model, DataFrame] | None:
    """A model from the rows that are not held out, and one row per row of
    ``docs`` with ``id`` and the ``places`` of its text's words in the model's;
    None without a positive.

    ``prior`` is the share of toxic texts; by default that of the labelled
    rows learned from.  Documents with several labels count as toxic if one
    says so; null ids and null labels are not learned from.  Texts are null,
    empty or of any length: a text counts by the set of its words.  Equal texts
    are learned from once, and are positives if one of them is; words are
    counted over all rows.  Labelled rows are a sample, drawn by hashes, of at
    most ``max_positives`` toxic texts; all other texts are used."""
    seen = labels.filter(~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    marked = seen.groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("toxic"))
    n_marked, n_toxic = marked.agg(F.count(F.lit(1)), F.count_if(F.col("toxic") == 1)).first()
    if not n_toxic:
        return None
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    few = (marked.filter(F.col("toxic") == 1).withColumn("draw", draw).filter(F.col("draw") < 1.2 * max_positives / n_toxic)
           .orderBy("draw", "id").limit(max_positives).select("id", F.lit(True).alias("pos")))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(few), "id", "left")  # at most max_positives ids
    rows = rows.select("id", "text", F.coalesce("pos", F.lit(False)).alias("pos"), (~held_out(F.col("id")) & F.col("id").isNotNull()).alias("used"))
    words = differing_words(rows.filter("used"), max_words)
    listed = stage(rows.select("id", "used", "pos", text_key(F.col("text")).alias("key"), _places(words, F.col("text")).alias("places")), "toxicity_rows")
    texts = stage(listed.filter("used").groupBy("key", "places").agg(F.max("pos").alias("pos")), "toxicity_texts")
    pos = [np.frombuffer(r["places"], dtype="<i4") for r in texts.filter("pos").orderBy("key", "places").limit(max_positives).collect()]
    if not pos:
        return None
    theta = train_blocks(texts, texts.count(), pos, len(words), min(max(prior or n_toxic / n_marked, 1e-4), 0.9), block, seed)
    return Model(words, theta[:-1], float(theta[-1])), listed.select("id", "places")


def score_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    A null or empty text has the score of a text without known words; a null
    id is not held out; repeated rows are scored each by itself; without a
    positive label every score is 0; an empty table gives an empty table; other
    columns are left out and are never an input."""
    found = fit(docs, labels, text, doc_id, **options)
    if found is None:
        scored = docs.select(F.col(doc_id).alias("id"), F.lit(0.0).alias("score"))
    else:
        model, listed = found

        @F.pandas_udf(T.DoubleType())
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for places in batches:
                yield pd.Series(model.scores_of([np.frombuffer(p, dtype="<i4") for p in places]))

        scored = listed.select("id", score("places").alias("score"))
    return (scored.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
