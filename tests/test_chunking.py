"""K9 chunking against a brute-force sequential implementation, both modes."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import chunking as ch

CUTS = {".", ",", ";", "!", "?"}


def brute_chunks(tokens, max_lines, overlap):
    """Sequential reference: grow a chunk token by token; once it is full, look
    ahead (50 tokens, sliding) for a cut token and extend the chunk to it;
    otherwise hard-cut after 50 extra tokens; the last token closes the
    last chunk.  ``overlap`` restarts right after the token where the cut
    was decided (repeating the look-ahead tokens)."""
    n = len(tokens)
    if n <= max_lines:
        return [(0, n - 1)]
    out, s = [], 0
    while s < n:
        i = s
        end = None
        while i < n:
            length = i - s + 1
            if length >= max_lines:
                hit = next((j for j in range(i, min(i + 50, n)) if tokens[j] in CUTS), None)
                if hit is not None:
                    end = hit
                    break
                if length >= max_lines + 50:
                    end = i
                    break
            if i == n - 1:
                end = i
                break
            i += 1
        out.append((s, end))
        s = (i + 1) if overlap else (end + 1)
    return out


def _docs(seed, count=40):
    rnd = random.Random(seed)
    docs = []
    for d in range(count):
        n = rnd.choice([0, 1, 5, 20, 21, 60, 150, 333, 700])
        p = rnd.choice([0.0, 0.01, 0.05, 0.3])
        toks = [rnd.choice(sorted(CUTS)) if rnd.random() < p else f"w{k}" for k in range(n)]
        docs.append((f"d{d}", toks))
    return docs


@pytest.mark.parametrize("overlap", [False, True])
@pytest.mark.parametrize("max_lines", [1, 7, 20])
def test_chunk_bounds_match_brute_force(spark, overlap, max_lines):
    docs = _docs(max_lines * 10 + overlap)
    df = spark.createDataFrame(docs, "file string, toks array<string>").select(
        "file", F.transform("toks", lambda t: F.struct(t.alias("token"), F.lit("O").alias("label"))).alias("tokens"))
    got = {r["source_file"]: [] for r in df.select(F.col("file").alias("source_file")).collect()}
    for r in ch.split_documents(df, "file", "tokens", max_lines, compat_overlap=overlap).orderBy(
            "source_file", "chunk_index").collect():
        got[r["source_file"]].append((r["start"], r["end"]))
        assert len(r["tokens"]) == max(0, r["end"] - r["start"] + 1)
    for file, toks in docs:
        assert got[file] == brute_chunks(toks, max_lines, overlap), file


def test_chunks_concatenate_back(spark):
    docs = _docs(7, 20)
    df = spark.createDataFrame(docs, "file string, toks array<string>").select(
        "file", F.transform("toks", lambda t: F.struct(t.alias("token"), F.lit("O").alias("label"))).alias("tokens"))
    chunks = ch.split_documents(df, "file", "tokens", 20)
    back = chunks.groupBy("source_file").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk_index", "tokens"))),
                              lambda c: c["tokens"])).alias("t"))
    joined = back.join(df.withColumnRenamed("file", "source_file"), "source_file")
    assert joined.where(F.col("t") != F.col("tokens")).count() == 0


def test_custom_id_round_trip(spark):
    df = spark.createDataFrame([("a__chunk_b.nersuite", 3)], "f string, i int")
    r = df.select(ch.chunk_custom_id(F.col("f"), F.col("i")).alias("c")).select(
        "c", ch.custom_id_file(F.col("c")).alias("f"), ch.custom_id_index(F.col("c")).alias("i")).first()
    assert r["c"] == "a__chunk_b.nersuite__chunk_3" and r["f"] == "a__chunk_b.nersuite" and r["i"] == 3


def test_batches_are_dense_and_bounded(spark):
    df = spark.range(0, 1234).select(F.format_string("f%05d", "id").alias("source_file"), F.lit(0).alias("chunk_index"))
    b = ch.assign_batches(df, ["source_file", "chunk_index"], 100)
    info = ch.batch_info(b).orderBy("batch_no").collect()
    assert [r["batch_no"] for r in info] == list(range(13))
    assert all(r["chunks"] == 100 for r in info[:-1]) and info[-1]["chunks"] == 34
