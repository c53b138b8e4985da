"""Translation flow with an injected translator.

The translator is any Python callable ``list[str] -> list[str]`` (a model
wrapper in production, a fake in tests).  It runs inside an *iterator* pandas
UDF, so it is created once per task and called on batches of texts of like
length.  A failing batch is halved until the failing items stand alone, so one
bad item does not fail its neighbours; each item gets ``(text, success, error)``.

Abstracts are translated sentence by sentence inside the row: the sentences
of the articles in one Arrow batch are flattened, translated in batches and
re-joined per article in order -- no explode and no regroup shuffle; an
article fails if any of its sentences failed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import quality as ql
from tessera.operators.joins import anti_join

RESULT_TYPE = "struct<text:string,success:boolean,error:string>"

TranslatorFactory = Callable[[], Callable[[list[str]], list[str]]]


def _translate_batch(fn: Callable[[list[str]], list[str]], texts: list[str]) -> list[tuple]:
    """``(text, success, error)`` of each text.  A batch that fails is halved
    until the failing texts stand alone: one of n costs about 2 log2(n) calls."""
    try:
        out = fn(texts)
        if len(out) != len(texts):
            raise ValueError(f"translator returned {len(out)} results for {len(texts)} inputs")
        return [(o, True, None) for o in out]
    except Exception as e:  # noqa: BLE001 - isolated, then reported per item
        if len(texts) == 1:
            return [("", False, f"{type(e).__name__}: {e}")]
        half = len(texts) // 2
        return _translate_batch(fn, texts[:half]) + _translate_batch(fn, texts[half:])


def _translate_all(fn: Callable[[list[str]], list[str]], texts: list[str], batch_size: int) -> list[tuple]:
    """Results of ``texts`` in their order.  Batches hold texts of like length,
    longest first, so that a model pads little and runs out of memory, if it
    does, at the start."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    results: list[tuple] = [()] * len(texts)
    for at in range(0, len(order), batch_size):
        batch = order[at:at + batch_size]
        for i, result in zip(batch, _translate_batch(fn, [texts[i] for i in batch])):
            results[i] = result
    return results


def translator_udf(factory: TranslatorFactory, batch_size: int = 64):
    """Iterator pandas UDF ``text -> struct<text, success, error>``.

    ``factory`` builds the translator once per task (model load goes there)."""

    @F.pandas_udf(RESULT_TYPE)
    def _translate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fn = factory()
        for texts in batches:
            res = _translate_all(fn, texts.fillna("").tolist(), batch_size)
            yield pd.DataFrame(res, columns=["text", "success", "error"])

    return _translate


def sentences_translator_udf(factory: TranslatorFactory, batch_size: int = 64):
    """K10 + K11 in the row: ``array<sentence> -> struct<text, success, error>``.

    The sentences of all articles in an Arrow batch are flattened and sent to
    the translator in batches of ``batch_size`` (isolating failing items), then
    re-joined per article in order.  An article fails when any of its
    sentences failed; its text is then ``''``.  No explode / regroup shuffle."""

    @F.pandas_udf(RESULT_TYPE)
    def _translate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fn = factory()
        for arrays in batches:
            lists = [list(a) if a is not None else [] for a in arrays]
            flat = [s for lst in lists for s in lst]
            results = _translate_all(fn, flat, batch_size)
            out, pos = [], 0
            for lst in lists:
                part = results[pos:pos + len(lst)]
                pos += len(lst)
                failed = [r for r in part if not r[1]]
                if failed:
                    out.append(("", False, failed[0][2]))
                else:
                    out.append((" ".join(r[0] for r in part), True, None))
            yield pd.DataFrame(out, columns=["text", "success", "error"])

    return _translate


# ---------------------------------------------------------------- C9, C10, I6, E8
def translation_queue(
    articles: DataFrame,
    id_col: str,
    abstract: Column,
    language: Column,
    has_content: Column,
    title: Column | None = None,
    done_abstracts: DataFrame | None = None,
    done_titles: DataFrame | None = None,
    abstract_ok: Column | None = None,
    title_ok: Column | None = None,
    titles_only: bool = False,
    translate_titles: bool = True,
) -> DataFrame:
    """C9 + C10 + I6: work items ``(id, kind, source_text, original_title)``.

    Finished work is skipped either through a success flag on the row
    (``abstract_ok``/``title_ok``) or through a results table (left anti
    join on the id, E8) -- the resumable form."""
    parts = []
    if not titles_only:
        pred = ql.abstract_queue_predicate(language, has_content, abstract_ok if abstract_ok is not None else F.lit(False))
        a = articles.where(pred).select(
            F.col(id_col), F.lit("abstract").alias("kind"), abstract.alias("source_text"),
            F.lit(None).cast("string").alias("original_title"))
        if done_abstracts is not None:
            a = anti_join(a, done_abstracts.select(id_col), id_col)
        parts.append(a)
    if translate_titles and title is not None:
        open_title = tx.has_content(title) & ~F.coalesce(title_ok if title_ok is not None else F.lit(False), F.lit(False))
        # Cleaned once; a generated column is not pushed into the filter and computed again there
        cleaned = F.filter(F.array(tx.clean_title(tx.strip_ws(title))), lambda x: F.length(x) > 0)
        t = articles.where(open_title).select(
            F.col(id_col), F.lit("title").alias("kind"), F.explode_outer(cleaned).alias("source_text"), tx.strip_ws(title).alias("original_title"))
        t = t.where(F.col("source_text").isNotNull())
        if done_titles is not None:
            t = anti_join(t, done_titles.select(id_col), id_col)
        parts.append(t)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- K11, K12
def translate_items(queue: DataFrame, id_col: str, factory: TranslatorFactory, batch_size: int = 64) -> DataFrame:
    """Translate a queue.  Abstract items are split into sentences
    and translated sentence by sentence inside the row (see
    :func:`sentences_translator_udf`); title items are translated whole.
    Output ``(id, kind, source_text, original_title, text, success, error)``."""
    per_sentence = sentences_translator_udf(factory, batch_size)
    whole = translator_udf(factory, batch_size)
    abstracts = queue.where(F.col("kind") == "abstract").withColumn(
        "r", per_sentence(tx.split_sentences("source_text")))
    titles = queue.where(F.col("kind") == "title").withColumn("r", whole(F.col("source_text")))
    return abstracts.unionByName(titles).select(
        id_col, "kind", "source_text", "original_title",
        F.col("r.text").alias("text"), F.col("r.success").alias("success"), F.col("r.error").alias("error"))


def translation_struct(results: DataFrame, model: str, batch_size: int | None = None) -> DataFrame:
    """E5 helper: results as the nested record written back on the article."""
    return results.withColumn(
        "translation",
        F.struct(
            F.col("text"), F.col("success"), F.lit(model).alias("model_used"),
            F.when(F.col("success"), F.lit(batch_size)).cast("int").alias("batch_size_used"),
            F.when(F.col("success"), F.current_timestamp()).alias("translation_date"),
            F.col("error"),
        ),
    )


def translation_summary(results: DataFrame) -> DataFrame:
    """Successful / failed / total per kind and the success rate."""
    return results.groupBy("kind").agg(
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.count("*").alias("total"),
    ).withColumn("success_rate", F.round(F.col("successful") * 100.0 / F.col("total"), 2))
