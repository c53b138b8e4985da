"""Token counts (operator 10).

The library cuts a text into pre-tokens and then merges inside each pre-token
alone, so a text's count is the sum over its distinct pre-tokens of
(frequency in the text) x (pieces of the pre-token).  Each task keeps a
lookup of the pre-tokens met so far with their piece counts, looks up the
distinct pre-tokens of a document in it, runs the tokenizer only for those
missing, and sums.  No id sequence is kept and nothing is shuffled.

The lookup is per task, bounded by ``max_lookup`` entries (it is emptied when
full, which changes no result): a corpus-wide lookup would shuffle one row per
(document, distinct pre-token), several times the size of the input.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters up to here have the same class in every Unicode table in use;
#: above, characters assigned lately may count as letters in one table only.
SETTLED = "\u0557"


class PieceCounter:
    """Counts pieces of whole texts for a byte-level BPE tokenizer file."""

    def __init__(self, path: str, pattern: str, max_lookup: int = 400_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.find = regex.compile(pattern).findall
        self.unsettled = regex.compile(f"[^\\x00-{SETTLED}]").findall
        self.special = regex.compile("|".join(
            regex.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        self.max_lookup = max_lookup
        self.pieces: dict[str, int] = {}

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(self.unsettled(text))):
            return self.whole([text])[0]
        n, parts = 0, [text]
        if "<" in text and self.special.search(text):  # each special string is one token and cuts the text
            parts = self.special.split(text)
            n = len(parts) - 1
        freq = Counter(self.find(parts[0]))
        for part in parts[1:]:
            freq.update(self.find(part))
        missing = list(set(freq).difference(self.pieces))
        if missing:
            if len(self.pieces) + len(missing) > self.max_lookup:
                self.pieces.clear()
                missing = list(freq)
            self.pieces.update(zip(missing, self.whole(missing)))
        return n + sum(map(int.__mul__, freq.values(), map(self.pieces.__getitem__, freq)))


def token_count(text: Column, file_name: str, max_lookup: int = 400_000) -> Column:
    """Tokens of ``text`` (null counts as empty) by the named tokenizer file."""

    @F.pandas_udf(T.LongType())
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counter = PieceCounter(public_tokenizers.path(file_name), public_tokenizers.PATTERN, max_lookup)
        for texts in batches:
            yield pd.Series([counter.count(t or "") for t in texts], dtype="int64")

    return n_tokens(text)


def count_tokens(docs: DataFrame, file_name: str = "byte_bpe_50k.json", limit: int = 512,
                 text: str = "text") -> DataFrame:
    """``docs`` plus ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    A null or empty text has 0 bytes and 0 tokens; repeated rows and null ids
    pass through one by one; an empty table gives an empty table; columns of
    ``docs`` with one of the three names are replaced."""
    return docs.withColumns({
        "n_bytes": F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long"),
        "n_tokens": token_count(F.col(text), file_name),
    }).withColumn("over_limit", F.col("n_tokens") > limit)
