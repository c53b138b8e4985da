"""Token normalisation as a vocabulary job (K1).

Per-token normalisers (a lemma table, a stemmer) are applied once per
*distinct* word, never once per occurrence:

1. number the rows and take each one's distinct tokens,
2. build the distinct vocabulary (partially aggregated before the shuffle),
3. map it through the lemma table (left join) and a stemmer, keeping only
   words that change; several modes share one map with a column each,
4. join the map to the distinct tokens of each row (a number given to the row,
   not its id, is the key) and replace inside the row's own array.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stem import spanish_stem
from tessera.session import reusable

MODES = ("basic", "stem", "lemmatize", "both")
#: Words of a map of changed words that go to every task whole; a larger map meets the tokens in a shuffle.
MAP_BROADCAST = 200_000


def explode_tokens(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """``(id, pos, token)`` for every token of every row.

    ``posexplode_outer`` + a null filter instead of ``posexplode``: the plain
    generator makes the optimizer infer ``size(tokens) > 0`` and push it under
    the projection, which would evaluate the tokenizer twice per row."""
    return df.select(id_col, F.posexplode_outer(tokens_col).alias("pos", "token")).where(F.col("pos").isNotNull())


def vocabulary(token_rows: DataFrame) -> DataFrame:
    """Distinct tokens with their frequency."""
    return token_rows.groupBy("token").agg(F.count("*").alias("freq"))


def stemmed(words: Column, stem_fn: Callable[[str], str] | None = None) -> Column:
    """Stems of ``words``: the Spanish stemmer, or ``stem_fn`` in Arrow batches."""
    if stem_fn is None:
        return spanish_stem(words)

    @F.pandas_udf("string")
    def apply(batch: pd.Series) -> pd.Series:
        return batch.map(lambda w: stem_fn(w) if w is not None else None)

    return apply(words)


def normalisation_map(vocab: DataFrame, modes: Mapping[str, str], lemma_table: DataFrame | None = None,
                      stem_fn: Callable[[str], str] | None = None) -> DataFrame:
    """``token`` and a column per entry ``name -> mode`` of ``modes``, for the
    words of ``vocab`` that one of them changes.

    ``stem``: the stemmer.  ``lemmatize``: the lemma table, and a given
    ``stem_fn`` for words without a lemma.  ``both``: stem of the lemma, or of
    the word itself."""
    if lemma_table is None:
        known = vocab.select("token", F.lit(None).cast("string").alias("lemma"))
    else:
        known = vocab.join(lemma_table.select("token", "lemma"), "token", "left")
    token, lemma, own = F.col("token"), F.col("lemma"), F.col("_stem")
    if stem_fn is not None or {"stem", "both"}.intersection(modes.values()):
        # a word's own stem once for all modes and the filter below, which would each make it anew
        known = known.withColumn("_stem", stemmed(token, stem_fn))
        if stem_fn is None:
            known = reusable(known)

    def form(mode):
        if mode == "stem":
            return own
        if mode == "both":
            return F.when(lemma.isNull(), own).otherwise(stemmed(lemma, stem_fn))
        return F.coalesce(lemma, token if stem_fn is None else own)

    forms = known.select("token", *(F.coalesce(form(mode), token).alias(name) for name, mode in modes.items()))
    changed = [F.col(name) != token for name in modes]
    return forms.where(F.array_contains(F.array(*changed), True))


def rows_of(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each list begins in the flattened array, and the row of each element."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]), np.repeat(np.arange(len(lists)), sizes)


def replaced(tokens: Column, changes: Column, forms: list[str]) -> Column:
    """A struct with an array per name of ``forms``: ``tokens`` in their order,
    those with an entry in ``changes`` (structs of ``token`` and the forms)
    replaced.  A token has the same forms in all rows, so the rows of an Arrow
    batch look each distinct word up once; null without changes or tokens."""

    @F.arrow_udf("struct<" + ", ".join(f"{f}: array<string>" for f in forms) + ">")
    def apply(lists: pa.Array, entries: pa.Array) -> pa.Array:
        starts, _ = rows_of(lists)
        told = entries.flatten()
        found = lists.flatten().cast(pa.string()).dictionary_encode()
        n = len(found.dictionary) + 1
        # places of words; a null word has the one after them
        own = pc.fill_null(found.indices, n - 1).to_numpy(zero_copy_only=False)
        changed = pc.fill_null(pc.index_in(told.field("token").cast(pa.string()), value_set=found.dictionary), n - 1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(changed < n - 1)
        keys = np.sort(changed[known].astype(np.int64) + rows_of(entries)[1][known] * n)
        if (np.diff(keys) == 0).any():
            raise ValueError("a token has several entries in the lemma table")
        place = np.arange(n)
        place[changed[known]] = n + known
        words, take = pa.concat_arrays([found.dictionary.cast(pa.string()), pa.nulls(1, pa.string())]), pa.array(place[own])
        missing = pc.or_(lists.is_null(), entries.is_null())
        made = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.concat_arrays([words, told.field(f).cast(pa.string())]).take(take)) for f in forms]
        return pa.StructArray.from_arrays(made, names=forms, mask=missing)

    return apply(tokens, changes)


def normalise_modes(df: DataFrame, tokens_col: str, modes: Mapping[str, str],
                    lemma_table: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
                    stem_fn: Callable[[str], str] | None = None) -> DataFrame:
    """K1: ``df`` with a column per entry ``name -> mode`` of ``modes``: the
    tokens of ``tokens_col`` in their order, as ``basic`` (as they are),
    ``stem``, ``lemmatize`` or ``both`` makes them (null for a null array).
    ``lemma_table`` has columns ``(token, lemma)``, a token once; or it is a
    function that makes such a table of the vocabulary (``token``).

    Rows are numbered and written once, so repeated ids do not matter.  Only
    the distinct tokens of a row meet the map of changed words, and only the
    changes of a row come back to it; the token stream itself never moves."""
    unknown = set(modes.values()).difference(MODES)
    if unknown:
        raise ValueError(f"unknown mode {min(unknown)!r}")
    if "lemmatize" in modes.values() and lemma_table is None and stem_fn is None:
        raise ValueError("mode 'lemmatize' needs a lemma table or a stemmer")
    wanted = {name: mode for name, mode in modes.items() if mode != "basic"}
    same = {name: F.col(tokens_col) for name, mode in modes.items() if mode == "basic"}
    if not wanted:
        return df.withColumns(same)
    rows = reusable(df.withColumn("_row", F.monotonically_increasing_id()))
    tokens = rows.select("_row", F.explode(F.array_distinct(tokens_col)).alias("token"))
    vocab = reusable(tokens.select("token").distinct())
    lemmas = lemma_table(vocab) if callable(lemma_table) else lemma_table
    mapping = reusable(normalisation_map(vocab, {f"_{k}": mode for k, mode in enumerate(wanted.values())}, lemmas, stem_fn))
    # an exploded column counts as one token a row, so the planner would take the token stream for the small side
    few = mapping.limit(MAP_BROADCAST + 1).count() <= MAP_BROADCAST
    mapping = F.broadcast(mapping) if few else mapping.hint("merge")
    forms = [f"_{k}" for k in range(len(wanted))]
    changes = tokens.join(mapping, "token").groupBy("_row").agg(F.collect_list(F.struct("token", *forms)).alias("_changes"))

    told = rows.join(changes, "_row", "left").withColumn("_forms", replaced(F.col(tokens_col), F.col("_changes"), forms))
    made = {name: F.when(F.col("_forms").isNull(), F.col(tokens_col)).otherwise(F.col(f"_forms.{f}")) for name, f in zip(wanted, forms)}
    return told.withColumns({**same, **made}).drop("_row", "_changes", "_forms")


def normalise_tokens(df: DataFrame, tokens_col: str, out_col: str,
                     lemma_table: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
                     stem_fn: Callable[[str], str] | None = None, mode: str = "lemmatize") -> DataFrame:
    """:func:`normalise_modes` with one mode."""
    return normalise_modes(df, tokens_col, {out_col: mode}, lemma_table, stem_fn)


def plural_lemma_table(vocab: DataFrame, min_length: int = 4) -> DataFrame:
    """A lemma table derived from the data: a word ending in ``s`` (at least
    ``min_length`` characters) maps to the word without the ``s`` when that
    word also is in ``vocab`` (distinct ``token``)."""
    cand = vocab.where(F.col("token").endswith("s") & (F.length("token") >= min_length)).select(
        "token", F.expr("substring(token, 1, length(token) - 1)").alias("lemma"))
    return cand.join(vocab.select(F.col("token").alias("lemma")), "lemma", "left_semi")
