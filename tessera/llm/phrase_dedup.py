"""Substring deduplication by repeated-phrase automata (operator 3).

A window is 50 consecutive words; every word covered by a window that also
starts in a document with a smaller id is removed.

1. *Phrases.*  Of the 16-word phrases inside a window, the one with the
   smallest hash stands for the window.  Equal windows have equal phrases, so
   only phrases that occur in two documents matter; about one phrase in
   eighteen words is counted, not every window.
2. *Recurring passages.*  In the documents that hold such phrases, the windows
   they stand for are counted.  Of a window in several documents, the smallest
   document is the owner; the words around an owner's phrase are a passage.
3. *Automata.*  The touched documents are dealt into buckets of bounded size.
   A window holds its phrase and 28 words more around it, in one of five ways:
   these 44 words lead a passage to the buckets it may occur in (a phrase alone
   could be a common line, with a passage for each document that is copied).  A
   bucket's
   passages are compiled into one Aho-Corasick automaton over words, its whole
   documents stream through it, and the windows around every occurrence are
   looked up among the passages' windows and compared word by word.  Every word
   of an equal window is removed.

Hashes only choose what to compare; what is removed has been compared word by
word.  A phrase that a third of all documents hold is counted with partial
sums, and reaches a bucket once for each passage, not for each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import stage, text_key

WINDOW = 50
PHRASE = 16

_BASE = 0x9E3779B97F4A7C15  # odd, so that powers have inverses modulo 2**64


def split_words(text: bytes | str | None) -> list[bytes]:
    """Words of a text as UTF-8; bytes split at the six ASCII spaces only."""
    return (text.encode() if isinstance(text, str) else text or b"").split()


class _Powers:
    """Powers of the base and of its inverse, as many as asked for so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _runs(hashes: np.ndarray, k: int, powers: _Powers) -> np.ndarray:
    """Mixed hash of every run of ``k`` words."""
    up, down = powers.upto(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * up[:-1], dtype=np.uint64)])
    return _mix((sums[k:] - sums[:-k]) * down[:len(hashes) - k + 1])


def _word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in words], dtype=np.uint64)


def standing_phrases(hashes: np.ndarray, window: int, phrase: int, powers: _Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hash, at, first`` of the phrases that stand for windows: a phrase that
    starts at word ``at`` stands for the windows from ``first`` up to the next
    phrase's first window."""
    runs = _runs(hashes, phrase, powers)
    wide = window - phrase + 1
    view = np.lib.stride_tricks.sliding_window_view(runs, wide)
    chosen = np.concatenate([view[i:i + 4096].argmin(axis=1) + np.arange(i, min(i + 4096, len(view))) for i in range(0, len(view), 4096)])
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    return runs[chosen[first]].view(np.int64), chosen[first], first


PHRASES = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("at", T.IntegerType()),
                                    T.StructField("first", T.IntegerType()), T.StructField("n", T.IntegerType())]))


def phrase_table(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """``docs`` (doc_id, text_key, text) to ``doc_id, text_key, n_words, sha256``
    (of the words joined by a space) and the phrases ``h, at, first, n``."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("sha256", T.StringType()), T.StructField("phrases", PHRASES)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        kind = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("n", pa.int32())]))
        for batch in batches:
            n_words, sha, parts, ends = [], [], [], [0]
            for t in batch.column(2).cast(pa.binary()):
                w = split_words(t.as_py())
                n_words.append(len(w))
                sha.append(hashlib.sha256(b" ".join(w)).hexdigest())
                if len(w) >= window:
                    h, at, first = standing_phrases(_word_hashes(w), window, phrase, powers)
                    parts.append((h, at, first, np.diff(np.r_[first, len(w) - window + 1])))
                ends.append(ends[-1] + (len(parts[-1][0]) if len(w) >= window else 0))
            joined = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(4)]
            flat = pa.StructArray.from_arrays([pa.array(joined[0].astype(np.int64))] + [pa.array(j.astype(np.int32)) for j in joined[1:]],
                                              names=["h", "at", "first", "n"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat).cast(kind)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(sha), lists], names=schema.names)

    return docs.mapInArrow(scan, schema)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and fields of a column of lists of structs."""
    flat = column.flatten()
    names = [f.name for f in flat.type]
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], {n: flat.field(n).to_numpy(zero_copy_only=False) for n in names}


def _windows_of(window: int):
    """Rows ``h, w, doc_id`` of the windows that recurring phrases stand for."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            at, p = _lists(batch.column(2))
            hs, ws, owner = [], [], []
            for i, t in enumerate(batch.column(1).cast(pa.binary())):
                h, first, n = (p[f][at[i]:at[i + 1]] for f in ("h", "first", "n"))
                runs = _runs(_word_hashes(split_words(t.as_py())), window, powers).view(np.int64)
                place = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                ws.append(runs[place])
                hs.append(np.repeat(h, n))
                owner.append(np.full(len(place), i, dtype=np.int64))
            if ws:
                yield pa.record_batch([pa.array(np.concatenate(hs)), pa.array(np.concatenate(ws)),
                                       batch.column(0).take(pa.array(np.concatenate(owner)))], names=["h", "w", "doc_id"])

    return scan


def lead_shapes(window: int, phrase: int, step: int = 7) -> list[tuple[int, int]]:
    """``(left, size)`` of the leads of a phrase: every window with the phrase
    holds one of them, ``size`` words from ``left`` words before the phrase."""
    slack = window - phrase
    return [(left, phrase + left + max(slack - left - step + 1, 0)) for left in range(0, slack + 1, step)]


def _leads(at: np.ndarray, hashes: np.ndarray, low: int, high: int, shapes: list[tuple[int, int]], powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the leads of phrases ``at``, inside ``low`` to ``high``."""
    found, starts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for size in sorted({z for _, z in shapes}):
        start = np.unique(np.concatenate([at - left for left, z in shapes if z == size]))
        start = start[(start >= low) & (start + size <= high)]
        if len(start):
            found.append(_runs(hashes, size, powers).view(np.int64)[start])
            starts.append(start)
    return np.concatenate(found), np.concatenate(starts)


def _leads_of(window: int, phrase: int):
    """Rows ``lead, bucket, doc_id``: hashes of the phrases' leads."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, shapes = _Powers(), lead_shapes(window, phrase)
        for batch in batches:
            offsets, p = _lists(batch.column(3))
            owner, leads = [], []
            for i, t in enumerate(batch.column(2).cast(pa.binary())):
                hashes = _word_hashes(split_words(t.as_py()))
                leads.append(np.unique(_leads(p["at"][offsets[i]:offsets[i + 1]], hashes, 0, len(hashes), shapes, powers)[0]))
                owner.append(np.full(len(leads[-1]), i, dtype=np.int64))
            if owner:
                who = pa.array(np.concatenate(owner))
                yield pa.record_batch([pa.array(np.concatenate(leads)), batch.column(0).take(who), batch.column(1).take(who)],
                                      names=["lead", "bucket", "doc_id"])

    return scan


def _passages_of(window: int, phrase: int):
    """Rows ``owner, key, start, words, leads, ats``: the words of every run of
    owned phrases that follow each other, and the hashes of the phrases' leads
    and their places in it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, shapes = _Powers(), lead_shapes(window, phrase)
        for batch in batches:
            offsets, p = _lists(batch.column(3))
            rows, out = [], []
            for i, (t, owned) in enumerate(zip(batch.column(2).cast(pa.binary()), batch.column(4))):
                w, mine = split_words(t.as_py()), set(owned.as_py())
                span = slice(offsets[i], offsets[i + 1])
                found = sorted(z for z in zip(*(p[f][span].tolist() for f in ("first", "n", "at", "h"))) if z[3] in mine)
                runs: list[list] = []
                for z in found:
                    if runs and runs[-1][-1][0] + runs[-1][-1][1] == z[0]:
                        runs[-1].append(z)
                    else:
                        runs.append([z])
                hashes = _word_hashes(w) if runs else None
                for run in runs:
                    start, end = run[0][0], run[-1][0] + run[-1][1] - 1 + window
                    leads, at = _leads(np.array([z[2] for z in run]), hashes, start, end, shapes, powers)
                    rows.append(i)
                    out.append((start, b" ".join(w[start:end]), leads.tolist(), (np.unique(at) - start).tolist()))
            if out:
                start, words, leads, ats = zip(*out)
                at = pa.array(rows, pa.int64())
                yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array(start, pa.int32()), pa.array(words, pa.binary()),
                                       pa.array(leads, pa.list_(pa.int64())), pa.array(ats, pa.list_(pa.int32()))],
                                      names=["owner", "key", "start", "words", "leads", "ats"])

    return scan


#: Words of a lead that the automaton looks for (the rest is looked up where it
#: finds them), and letters of a word in it.
KEY_WORDS = 6
LETTERS = 3


def word_letters(n: int) -> list[str]:
    """Three letters for each word number up to ``n``, from an alphabet for each
    of the three places and with 64 letters in the last two, so that an
    automaton's nodes have few children and a key can match at the start of a
    word only.  Number 0 stands for a word that is in no key."""
    first, second, third = ([chr(start + d) for d in range(size)] for start, size in ((0x10000, (n >> 12) + 1), (0x100, 64), (0x200, 64)))
    return ["\0" * LETTERS, *(first[i >> 12] + second[i >> 6 & 63] + third[i & 63] for i in range(1, n + 1))]


def _locate(window: int, size: int, kept_text: bool):
    """All occurrences of a bucket's passages in its documents: a row for each
    document that loses a word."""

    def locate(docs: pd.DataFrame, passages: pd.DataFrame) -> pd.DataFrame:
        import ahocorasick

        powers, number = _Powers(), {}
        rank = {d: i for i, d in enumerate(sorted({*passages["owner"], *docs["doc_id"]}))}
        flat, starts, owners, leads = [np.zeros(0, dtype=np.int64)], [], [], set()
        length = 0
        for owner, text, places in zip(passages["owner"], passages["words"], passages["ats"]):
            ids = [number.setdefault(w, len(number) + 1) for w in text.split()]
            leads.update(tuple(ids[at:at + min(KEY_WORDS, size)]) for at in places)
            flat.append(np.array(ids, dtype=np.int64))
            starts.append(np.arange(length, length + len(ids) - window + 1))
            owners.append(np.full(len(starts[-1]), rank[owner]))
            length += len(ids)
        words_of, hash_of, letters = np.concatenate(flat), _mix(np.arange(1, len(number) + 2, dtype=np.uint64)), word_letters(len(number))
        if leads:
            # of equal windows in the passages, the one of the smallest owner
            start, owner = np.concatenate(starts), np.concatenate(owners)
            hashes = _runs(hash_of[words_of], window, powers)[start]
            order = np.lexsort((owner, hashes))
            keep = order[np.r_[True, hashes[order][1:] != hashes[order][:-1]]]
            start, owner, hashes = start[keep], owner[keep], hashes[keep]
            there = np.lib.stride_tricks.sliding_window_view(words_of, window)
            automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for lead in leads:
                automaton.add_word("".join([letters[i] for i in lead]))
            automaton.make_automaton()

        def repeated(ids: np.ndarray, hay: str, own: int) -> np.ndarray:
            """Windows of a document that a passage of a smaller one holds."""
            at = np.array([(last + 1 - n) // LETTERS for last, n in automaton.iter(hay)], dtype=np.int64)
            low, high = np.maximum(at - (window - size), 0), np.minimum(at, len(ids) - window)
            edges = np.zeros(len(ids) + 2, dtype=np.int64)
            np.add.at(edges, low[low <= high], 1)
            np.add.at(edges, high[low <= high] + 1, -1)
            found = np.flatnonzero(np.cumsum(edges) > 0)  # windows with a lead where the automaton found one
            run = _runs(hash_of[ids], window, powers)[found]
            j = np.minimum(np.searchsorted(hashes, run), len(hashes) - 1)
            same = (hashes[j] == run) & (owner[j] < own)
            found, j = found[same], j[same]
            here = np.lib.stride_tricks.sliding_window_view(ids, window)
            equal = [(here[found[k:k + 4096]] == there[start[j[k:k + 4096]]]).all(axis=1) for k in range(0, len(found), 4096)]
            return found[np.concatenate(equal)] if equal else found

        out = []
        for doc_id, key, text in zip(docs["doc_id"], docs["text_key"], docs["text"]):
            words = split_words(text)
            edges = np.zeros(len(words) + 1, dtype=np.int64)
            if leads and len(words) >= window:
                ids = np.fromiter(map(number.get, words, repeat(0)), dtype=np.int64, count=len(words))
                gone = repeated(ids, "".join([letters[i] for i in ids.tolist()]), rank[doc_id])
                np.add.at(edges, gone, 1)
                np.add.at(edges, gone + window, -1)
            mask = np.cumsum(edges[:-1]) > 0
            if not mask.any():
                continue
            spans = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
            kept = b" ".join(compress(words, (~mask).tolist()))
            out.append((doc_id, key, int(mask.sum()), spans.tolist(), kept.decode() if kept_text else None, hashlib.sha256(kept).hexdigest()))
        rows = pd.DataFrame(out, columns=["doc_id", "text_key", "n_removed", "edges", "kept", "sha256"])
        return rows if kept_text else rows.drop(columns="kept")

    return locate


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, phrase: int = PHRASE,
                   bucket_bytes: int = 2 << 20, kept_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, n_words, n_removed``,
    ``removed`` (word numbers, ``[start, end, start, end, ...]``) and
    ``kept_sha256`` of the kept words joined by a space; with ``kept_text``
    also ``kept``, these words, for documents that lose any (else null).

    Null and empty texts have no words; texts shorter than a window lose none;
    rows of equal id never remove each other, and equal rows lose the same; a
    null id neither removes nor loses; an empty table gives an empty table;
    other columns are left out."""
    source = docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    table = stage(phrase_table(source, window, phrase), "phrases")
    each = table.filter("doc_id IS NOT NULL").select("doc_id", "text_key", F.explode("phrases").alias("p")).select("doc_id", "text_key", "p.*")
    shared = stage(each.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("h"), "shared_phrases")
    # a set, and one row of equal ones: a row that is repeated very often is looked at once
    marked = each.join(shared, "h").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("h", "at", "first", "n")).alias("phrases"))
    renamed = marked.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "phrases")
    touched = stage(source.join(renamed, (source["doc_id"] == F.col("d")) & (source["text_key"] == F.col("k")))
                    .select("doc_id", "text_key", "text", F.array_sort("phrases").alias("phrases")).dropDuplicates(["doc_id", "text_key"]), "touched_documents")

    id_type = touched.schema["doc_id"].dataType.simpleString()
    windows = touched.select("doc_id", "text", "phrases").mapInArrow(_windows_of(window), f"h long, w long, doc_id {id_type}")
    owners = (windows.groupBy("h", "w").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
              .filter("owner < last").select("h", "owner").distinct())
    owned = stage(owners.groupBy("owner").agg(F.collect_list("h").alias("owned")), "owned_phrases")
    passages = stage(touched.join(owned, touched["doc_id"] == owned["owner"]).select("doc_id", "text_key", "text", "phrases", "owned").mapInArrow(
        _passages_of(window, phrase), f"owner {id_type}, key long, start int, words binary, leads array<long>, ats array<int>"), "passages")

    size = touched.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(max(1, -(-size // bucket_bytes)))).cast("int")
    bucketed = touched.withColumn("bucket", bucket)
    wanted = (bucketed.select("bucket", "doc_id", "text", "phrases").mapInArrow(_leads_of(window, phrase), f"lead long, bucket int, doc_id {id_type}")
              .groupBy("lead", "bucket").agg(F.max("doc_id").alias("last")))
    name = ["owner", "key", "start"]
    routes = (passages.select(*name, F.explode("leads").alias("lead")).join(wanted, "lead").filter("owner < last")
              .select(F.col("bucket").alias("b"), *name).distinct())
    dealt = routes.join(passages.drop("leads"), name).select("b", "owner", "words", "ats")
    located = (bucketed.select("bucket", "doc_id", "text_key", "text").groupBy("bucket").cogroup(dealt.groupBy("b"))
               .applyInPandas(_locate(window, min(z for _, z in lead_shapes(window, phrase)), kept_text), f"doc_id {id_type}, text_key long, n_removed long, edges array<int>, "
                              + ("kept string, " if kept_text else "") + "sha256 string"))
    lost = located.dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "n_removed", "edges", F.col("sha256").alias("sha"), *(["kept"] if kept_text else []))
    joined = table.join(lost, (table["doc_id"] == lost["d"]) & (table["text_key"] == lost["k"]), "left")
    return joined.select("doc_id", "text_key", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                         F.coalesce("edges", F.array().cast("array<int>")).alias("removed"), F.coalesce("sha", "sha256").alias("kept_sha256"),
                         *(["kept"] if kept_text else []))
