"""SimHash near-duplicates by pigeonhole blocks (operator 8).

A fingerprint is cut into ``r`` blocks.  Two fingerprints that differ in at
most ``d`` bits agree in at least ``r - d`` blocks, so they share one of the
keys made of ``r - d`` blocks each.  Distinct fingerprints are joined on those
keys and pairs are verified by their Hamming distance.

``r`` grows with the number of distinct fingerprints so that a key stays
selective; every choice finds the same pairs.  Inside a key's group only the
links of a spanning forest are kept, so a dense group of k fingerprints gives
fewer than k links; a group larger than ``chunk`` is cut into chunks and each
pair of chunks is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import stage, text_key
from tessera.llm.components import component_ids

BITS = 64
SEED = 42


def simhash(data: bytes | None, shingle: int = 3) -> int:
    """Fingerprint of a UTF-8 text, as a signed long; 0 without words."""
    import xxhash

    w = (data or b"").lower().split()  # of bytes: A-Z, and the six ASCII spaces, only
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    grams = zip(*[w[i:] for i in range(shingle)]) if len(w) >= shingle else [w]
    hashes = np.array([digest(b" ".join(g), SEED) for g in grams], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = hashes[i:i + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64-bit SimHash of the shingles of ``text`` (null: as empty)."""

    @F.pandas_udf(T.LongType())
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return fp(text.cast("binary"))


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of every choice of ``blocks - distance`` blocks, as signed longs."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def blocks_for(n: int, distance: int) -> int:
    """Fewest blocks whose keys have 128 times as many values as ``n``."""
    r = distance + 1
    while r < 2 * distance + 6 and BITS * (r - distance) // r < np.log2(max(n, 1)) + 7:
        r += 1
    return r


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning links of the distinct fingerprints within ``distance`` bits."""
    out, left = [], fps
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= distance
            todo += (found := list(left[near]))
            out += [(x, y) for y in found]
            left = left[~near]
    return out


def _links_of_sorted(distance: int):
    """Task function: rows sorted by group to the links inside each group."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def close(rows: np.ndarray) -> pa.RecordBatch:
            """Links of whole groups: rows are (which, key, part, fp)."""
            starts = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(rows)])
            fps = rows[:, 3].view(np.uint64)
            two = starts[sizes == 2]
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance]
            a, b = [fps[two]], [fps[two + 1]]
            for s, k in zip(starts[sizes > 2], sizes[sizes > 2]):
                if found := _forest(fps[s:s + k], distance):
                    x = np.array(found, dtype=np.uint64)
                    a.append(x[:, 0])
                    b.append(x[:, 1])
            return pa.record_batch([pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], names=["a", "b"])

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1))
            rows = np.concatenate(held)
            if not len(rows):
                held = []
                continue
            last = (rows[:, :3] == rows[-1, :3]).all(axis=1).argmax()  # first row of the group still open
            held = [rows[last:]]
            if last:
                yield close(rows[:last])
        if held and len(held[0]):
            yield close(held[0])

    return links


def close_pairs(fps: DataFrame, distance: int = 3, blocks: int | None = None, chunk: int = 2000) -> DataFrame:
    """Links ``a, b`` that span every set of the distinct longs ``fp`` of
    ``fps`` connected by steps of at most ``distance`` differing bits."""
    masks = block_masks(blocks or blocks_for(fps.count(), distance), distance)
    fp = F.col("fp")
    keyed = fps.select("fp", F.posexplode(F.array(*[fp.bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("which", "key"))
    hot = stage(keyed.groupBy("which", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > chunk)
                .withColumn("m", F.ceil(F.col("n") / chunk).cast("long")).drop("n"), "hot_blocks")
    m, own = F.coalesce("m", F.lit(1)).cast("long"), F.col("own")
    parts = (keyed.join(hot, ["which", "key"], "left").withColumn("m", m)
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("m")))
             .select("which", "key", "fp", "m", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("other"))
             .withColumn("part", F.least("own", "other") * F.col("m") + F.greatest("own", "other"))
             .select(F.col("which").cast("long").alias("which"), "key", "part", "fp"))
    group = ["which", "key", "part"]
    dealt = parts.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(_links_of_sorted(distance), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits),
    ``component_id``, the smallest id reachable over links, and ``text_key``.

    Null and empty texts have fingerprint 0 and link like any other; a null id
    is never the smallest unless its whole component has no id (then null);
    repeated rows each give a row; an empty table gives an empty table; other
    columns are left out."""
    prints = stage(docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("text_key"),
                               fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")
    reps = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct_fingerprints")
    nodes = reps.select(F.col("fp").alias("node"), F.col("low").alias("id"))
    ids = component_ids(nodes, close_pairs(reps.select("fp"), distance)).withColumnRenamed("node", "fp")
    return prints.join(ids, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_key")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of ``docs`` for each component, unchanged: the one of smallest
    id.  Where no row of a component has an id, one for each fingerprint."""
    found = near_duplicates(docs, text=text, doc_id=doc_id, **options)
    group = F.coalesce(F.col("component_id").cast("string"), F.col("fingerprint"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    best = stage(found.groupBy(F.col("component_id").isNull(), group).agg(first.alias("b"))
                 .select(F.col("b.doc_id").alias("__id"), F.col("b.text_key").alias("__best")), "kept_documents")
    keyed = docs.withColumn("__key", text_key(F.col(text)))
    kept = keyed.join(best, (keyed["__key"] == best["__best"]) & keyed[doc_id].eqNullSafe(best["__id"]), "left_semi")
    return kept.dropDuplicates([doc_id, "__key"]).select(*docs.columns)
