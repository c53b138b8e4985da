"""Best-fit packing by exact complements (operator 4).

Documents become token sequences, cut into pieces of at most ``capacity``
tokens.  What to pack depends on the lengths alone, and there are at most
``capacity`` different ones: their counts are the whole input of the plan.

A sequence is opened with the longest length left.  Its gap is looked up among
the sums of one, two and three lengths still available; a combination that
fills it exactly is consumed as often as the counts allow, in one step.  If
there is none, the longest length that fits goes in and the smaller gap is
looked up.  A step uses up one length at least, so a plan has some thousand
steps however many pieces there are.

Pieces then get numbers within their length and look their place up in the
plan.  The numbers come from counts per (length, bucket) and ranks inside a
bucket, so a length that holds a third of all pieces is ranked in many parts.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from struct import pack as pack_ids
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import kept_by_worker, stage

CAPACITY = 2048

# --- fixed values: white space of the tokenizer's normaliser ---------------------
TOKENIZER_SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
#: Python's str.split() cuts at these too.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: Without these, lower-casing is one to one and nothing needs normalising.
UNUSUAL = re.compile("[\u0130\u0250-\U0010ffff]|<[|]")


def byte_letters() -> list[str]:
    """Letter that a byte-level vocabulary writes for each byte: printable
    Latin-1 characters stand for themselves, the others for U+0100 and on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordIds:
    """Ids of whole texts for a tokenizer that merges inside words only: the
    ids of a text are those of its words, which are looked up."""

    def __init__(self, path: str, max_lookup: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letter = byte_letters()
        self.split_at = re.compile(TOKENIZER_SPACE).split
        self.max_lookup = max_lookup
        self.ids: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit numbers."""
        if not UNUSUAL.search(text):  # lower-casing first changes no id then
            text = text.lower()
        words = self.split_at(text) if any(c in text for c in NOT_SPACE) else text.split()
        distinct = set(words)
        missing = distinct.difference(self.ids)
        if missing:
            if len(self.ids) + len(missing) > self.max_lookup:
                self.ids.clear()
                missing = distinct
            self.learn(missing)
        return b"".join(map(self.ids.__getitem__, words))

    def learn(self, words: set[str]) -> None:
        """Look words up in the tokenizer.  A word of usual lower-case letters
        is one pre-token and goes straight to the merges; a last point or comma
        after letters is a pre-token of its own."""
        plain = {w for w in words if self.is_plain(w)}
        ended = {w: w[:-1] for w in words.difference(plain) if w.endswith((".", ",")) and self.is_plain(w[:-1])}
        for w in plain.union(ended.values()).difference(self.ids):
            letters = w if w.isascii() else "".join([self.letter[b] for b in w.encode()])
            found = [t.id for t in self.merge(letters)]
            self.ids[w] = pack_ids(f"<{len(found)}I", *found)
        others = list(words.difference(plain, ended).union(".,"))
        for w, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            self.ids[w] = pack_ids(f"<{len(e.ids)}I", *e.ids)
        for w, stem in ended.items():
            self.ids[w] = self.ids[stem] + self.ids[w[-1]]

    @staticmethod
    def is_plain(word: str) -> bool:
        return word.isalpha() and (word.isascii() or not UNUSUAL.search(word)) and word == word.lower()


def token_pieces(docs: DataFrame, file_name: str = "word_bpe_49k.json", capacity: int = CAPACITY,
                 text: str = "text", doc_id: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids, ids_crc32``: each text's ids and
    a closing id 0, cut every ``capacity`` ids, as little-endian unsigned 32-bit
    numbers, and their checksum.  Without ``with_ids`` the ids do not leave the
    task, and there is no column of them."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), *([T.StructField("ids", T.BinaryType())] if with_ids else []),
                           T.StructField("ids_crc32", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        path = public_tokenizers.path(file_name)
        ids = kept_by_worker(f"word ids of {path}", lambda: WordIds(path))  # its words are those of many tasks
        for batch in batches:
            owner, piece, length, parts, sums = [], [], [], [], []
            for i, t in enumerate(batch.column(1)):
                data = ids.encode(t.as_py()) + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    owner.append(i)
                    piece.append(k)
                    length.append(len(part) // 4)
                    sums.append(crc32(part))
                    if with_ids:
                        parts.append(part)
            k = np.array(piece, dtype=np.int32)
            yield pa.record_batch([batch.column(0).take(pa.array(owner, pa.int64())), pa.array(k), pa.array(k.astype(np.int64) * capacity),
                                   pa.array(length, pa.int64()), *([pa.array(parts, pa.binary())] if with_ids else []),
                                   pa.array(sums, pa.int64())], names=schema.names)

    return source.mapInArrow(cut, schema)


class Sums:
    """Exact sums of one, two and three available lengths.

    Counts only fall, so a combination that failed once is never tried again:
    each sum remembers how far its search has come."""

    def __init__(self, counts: np.ndarray):
        self.left = counts
        self.pair_at = np.arange(len(counts)) - 1
        self.triple_at = np.arange(len(counts)) - 2

    def pair(self, total: int, lent: int = 0) -> tuple[int, ...] | None:
        """The pair of ``total`` with the longest second length.  A pair that
        fails while a piece of length ``lent`` is set aside may do later, so
        the search comes back to the first such pair."""
        left = self.left
        b, again = self.pair_at[total], None
        while 2 * b >= total:
            a = total - b
            if left[b] > (a == b) and left[a] > 0:
                break
            if again is None and lent in (a, b):
                again = b
            b -= 1
        self.pair_at[total] = b if again is None else again
        return (b, total - b) if 2 * b >= total and total > 1 else None

    def triple(self, total: int) -> tuple[int, ...] | None:
        c = self.triple_at[total]
        found = None
        while 3 * c >= total and total > 2:
            if self.left[c] > 0:
                self.left[c] -= 1
                found = self.pair(total - c, lent=c)
                self.left[c] += 1
                if found:
                    found = (c, *found)
                    break
            c -= 1
        self.triple_at[total] = c
        return found

    def exact(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.left[gap] > 0 else self.pair(gap) or self.triple(gap)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, first, last, sequence, per_sequence, offset)``: pieces
    number ``first`` to ``last`` (exclusive) of a length go ``per_sequence``
    to a sequence, from ``sequence`` on, next to each other from ``offset``."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    sums, used, runs, sequence = Sums(left), np.zeros_like(left), [], 0
    top = capacity
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return runs
        taken, gap = [top], capacity - top
        left[top] -= 1
        while gap:
            found = sums.exact(gap)
            if not found:
                fitting = np.flatnonzero(left[1:gap + 1])
                if not len(fitting):
                    break
                found = (int(fitting[-1]) + 1,)
            for x in found:
                left[x] -= 1
            taken += found
            gap -= sum(found)
        pattern = Counter(int(x) for x in taken)
        for x, c in pattern.items():
            left[x] += c
        times = min(int(left[x]) // c for x, c in pattern.items())
        offset = 0
        for x, c in pattern.items():
            runs.append((x, int(used[x]), int(used[x]) + times * c, sequence, c, offset))
            used[x] += times * c
            left[x] -= times * c
            offset += x * c
        sequence += times


def place(runs: list[tuple[int, int, int, int, int, int]], length, number):
    """Column ``struct<sequence_id, offset>`` of piece ``number`` of ``length``."""
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)
    wide = int(table[:, 2].max(initial=0)) + 1
    keys = table[:, 0] * wide + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def find(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        n, x = numbers.to_numpy(), lengths.to_numpy()
        r = table[np.searchsorted(keys, x * wide + n, side="right") - 1]
        j = n - r[:, 1]
        return pd.DataFrame({"sequence_id": r[:, 3] + j // r[:, 4], "offset": r[:, 5] + j % r[:, 4] * x})

    return find(length, number)


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_rows: int = 1000) -> DataFrame:
    """``pieces`` (a staged table of :func:`token_pieces`) plus ``sequence_id``
    and ``offset``; other columns, such as the ids, go along.  At most
    ``capacity`` counts reach the driver, and the plan sent to the tasks has at
    most 64 runs a step."""
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = max([1, *(-(-n // bucket_rows) for n in counts.values())])
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sizes = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "bucket", F.expr(
        "sum(n) OVER (PARTITION BY length ORDER BY bucket) - n").alias("before"))
    ranked = bucketed.withColumn("rank", F.expr("row_number() OVER (PARTITION BY length, bucket ORDER BY doc_id, piece) - 1"))
    numbered = ranked.join(before, ["length", "bucket"]).withColumn("number", (F.col("before") + F.col("rank")).cast("long"))
    placed = numbered.withColumn("at", place(plan(counts, capacity), F.col("length"), F.col("number")))
    return placed.select(*pieces.columns, "at.sequence_id", "at.offset")


def assemble(packed: DataFrame) -> DataFrame:
    """Rows ``sequence_id, n_ids, ids`` of packed pieces: the ids of a sequence
    one after the other, in the form of :func:`token_pieces`.  A group has
    ``capacity`` ids at most."""
    held = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return held.select("sequence_id", "n_ids", F.aggregate("parts", F.lit(bytearray()), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, file_name: str = "word_bpe_49k.json", capacity: int = CAPACITY,
                   text: str = "text", doc_id: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per piece of every row of ``docs``: ``doc_id, piece, start,
    length, ids, ids_crc32, sequence_id, offset``.  :func:`assemble` makes the
    sequences of them.  Without ``with_ids``, places and checksums only.

    A null or empty text is one piece of length 1 (the closing id); repeated
    rows and null ids are packed each by itself; an empty table gives an empty
    table; other columns are left out."""
    return pack(stage(token_pieces(docs, file_name, capacity, text, doc_id, with_ids), "pieces"), capacity)
