"""Text preprocessing of DataFrame columns.

Cleaning and tokenising are native column expressions.  Stopword removal uses
Spark ML's ``StopWordsRemover`` (a JVM hash-set lookup, O(tokens)) instead of
``array_contains`` against a literal list, which would be O(tokens x words).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import fixed_values as fv
from tessera.functions import text as tx
from tessera.operators import profile as pf
from tessera.operators import vocabulary as vc
from tessera.stopwords import spanish_standard


MODES = ("basic", "stem", "lemmatize", "both")


def spanish_stopwords() -> list[str]:
    """K2: the standard Spanish list plus the extra academic words."""
    return list(dict.fromkeys([*spanish_standard(), *fv.EXTRA_SPANISH_STOPWORDS]))


def preprocess_columns(
    df: DataFrame,
    columns: Sequence[str],
    remove_stopwords: bool = True,
    stopwords: Sequence[str] | None = None,
    min_length: int = 2,
    extra_cleaning: bool = False,
    suffix: str = "_processed",
    mode: str = "basic",
    lemma_table: DataFrame | None = None,
    stem_fn: Callable[[str], str] | None = None,
) -> DataFrame:
    """K3: add ``<col><suffix>`` for each listed column present in ``df``
    (missing ones are skipped), computed as clean -> tokenize -> stopwords ->
    length/letter filter -> normalise (J8: ``basic`` leaves the tokens,
    ``stem``, ``lemmatize`` and ``both`` as in K1) -> join."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    tmp = {c: f"__tok_{c}" for c in present}
    kept = {c: f"__kept_{c}" for c in present}
    out = df.withColumns({tmp[c]: tx.tokenize(tx.clean_text(c, extra_cleaning)) for c in present})
    if remove_stopwords:
        remover = StopWordsRemover(
            inputCols=[tmp[c] for c in present], outputCols=[kept[c] for c in present],
            stopWords=list(stopwords if stopwords is not None else spanish_stopwords()), caseSensitive=True,
        )
        out = remover.transform(out)
    else:
        out = out.withColumns({kept[c]: F.col(tmp[c]) for c in present})
    out = out.withColumns({kept[c]: tx.filter_tokens(kept[c], None, min_length) for c in present})
    if mode != "basic":
        for c in present:
            out = vc.normalise_tokens(out, kept[c], kept[c], lemma_table, stem_fn, mode)
    out = out.withColumns({f"{c}{suffix}": F.array_join(kept[c], " ") for c in present})
    return out.drop(*tmp.values(), *kept.values())


def processing_profile(df: DataFrame, columns: Sequence[str], suffix: str = "_processed") -> DataFrame:
    """D14 for every processed column, one row per column."""
    frames = [pf.text_profile(df, c, f"{c}{suffix}") for c in columns if c in df.columns]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
