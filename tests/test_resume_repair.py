"""Interrupted translation runs, isolation of failing items, settled labels, one record per id."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.jobs import corpus
from tessera.operators import bio, translate
from tessera.sources import articles as art

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


class Calls:
    """A translator that notes its calls and fails on some texts."""

    def __init__(self, bad=()):
        self.bad, self.seen = set(bad), []

    def __call__(self, texts):
        self.seen.append(list(texts))
        if self.bad.intersection(texts):
            raise RuntimeError("model failure")
        return [t.upper() for t in texts]


@pytest.mark.parametrize("bad", [0, 37, 63])
def test_one_bad_item_costs_a_logarithm_of_calls(bad):
    texts = [f"t{i}" for i in range(64)]
    fn = Calls([texts[bad]])
    out = translate._translate_batch(fn, texts)
    assert len(fn.seen) == 1 + 2 * int(math.log2(64))
    assert [r[1] for r in out] == [i != bad for i in range(64)] and out[bad] == ("", False, "RuntimeError: model failure")
    assert [r[0] for i, r in enumerate(out) if i != bad] == [t.upper() for i, t in enumerate(texts) if i != bad]


def test_all_bad_and_wrong_numbers_of_results():
    texts = list("abcdefg")
    assert [r[1] for r in translate._translate_batch(Calls(texts), texts)] == [False] * 7
    out = translate._translate_batch(lambda t: t[:-1] if len(t) > 1 else t, texts)  # one result short until alone
    assert [r[0] for r in out] == texts
    assert translate._translate_batch(lambda t: [], ["a"])[0][2] == "ValueError: translator returned 0 results for 1 inputs"


def test_batches_hold_texts_of_like_length_and_results_keep_their_order():
    rng = random.Random(3)
    texts = ["x" * rng.randrange(1, 200) + str(i) for i in range(100)]
    fn = Calls()
    assert [r[0] for r in translate._translate_all(fn, texts, 16)] == [t.upper() for t in texts]
    lengths = [len(t) for batch in fn.seen for t in batch]
    assert lengths == sorted(lengths, reverse=True) and [len(b) for b in fn.seen] == [16] * 6 + [4]


def reversing(log=None, stop_after=None, allowed=None):
    """A factory whose tasks fail once ``stop_after`` parts are in the log."""
    def make():
        done = len([n for n in os.listdir(log) if n.endswith(".json")]) if log and os.path.isdir(log) else 0
        if stop_after is not None and done >= stop_after and not os.path.exists(allowed):
            raise RuntimeError("node lost")
        return lambda texts: [t[::-1] for t in texts]

    return make


def test_a_run_is_taken_up_where_it_failed(spark, tmp_path):
    arts, _, _ = art.read_article_dataset(spark, os.path.join(FIX, "articles.json"))
    copies = F.explode(F.array(*(F.concat("pmid", F.lit(f"-{i}")) for i in range(10))))
    arts = spark.createDataFrame(arts.withColumn("pmid", copies).collect(), arts.schema)
    work, allowed = str(tmp_path / "work"), str(tmp_path / "go")
    factory = reversing(os.path.join(work, "log"), 3, allowed)
    with pytest.raises(Exception, match="node lost"):
        corpus.translate_in_parts(spark, arts, factory, "m", work, n_parts=6)
    log = sorted(n for n in os.listdir(os.path.join(work, "log")) if n.endswith(".json"))
    assert log == ["part_00000.json", "part_00001.json", "part_00002.json"]
    before = {k: os.stat(os.path.join(work, "results", f"part={k}")).st_mtime_ns for k in range(3)}
    open(allowed, "w").close()
    out, summary = corpus.translate_in_parts(spark, arts, factory, "m", work, n_parts=6)
    assert {k: os.stat(os.path.join(work, "results", f"part={k}")).st_mtime_ns for k in range(3)} == before  # not translated again

    def told(df):
        return sorted((r["pmid"], r["abstract"]["spanish_translation"] and r["abstract"]["spanish_translation"]["text"],
                       r["title_spanish_translation"] and r["title_spanish_translation"]["translated_title"]) for r in df.collect())

    whole, whole_summary = corpus.translate_dataset(spark, arts, reversing(), "m")
    assert told(out) == told(whole) and sorted(map(tuple, summary.collect())) == sorted(map(tuple, whole_summary.collect()))
    again, summary = corpus.translate_in_parts(spark, arts, reversing(stop_after=0, allowed=str(tmp_path / "never")), "m", work)
    assert told(again) == told(whole)  # all parts are in the log: the translator is not made
    records = spark.read.json(os.path.join(work, "log"))
    assert records.count() == 6 and records.agg(F.sum("items")).first()[0] == 70


def repaired_in_passes(tokens):
    """Validate and repair until no error is left, as the rules say it."""
    cur = tokens.select("file", "ord", "token", "label")
    for _ in range(10):
        errs = bio.validate_tokens(cur)
        if not errs.count():
            return cur
        cur = bio.repair_labels(cur, errs).select("file", "ord", "token", F.col("fixed_label").alias("label"))
    raise AssertionError("not settled")


def test_settled_labels_are_those_of_repeated_passes(spark):
    rng = random.Random(12)
    labels = ["O", "B-a", "I-a", "B-b", "I-b", "B-", "I-", "X", "", "b-a", "I-a-b"]
    rows = [(f"f{f}", i + 1, "t", rng.choice(labels)) for f in range(120) for i in range(rng.randrange(1, 14))]
    toks = spark.createDataFrame(rows, "file string, ord int, token string, label string").cache()
    want = sorted(map(tuple, repaired_in_passes(toks).collect()))
    assert sorted(map(tuple, bio.repair_until_clean(toks).collect())) == want
    assert sorted(map(tuple, bio.repair_until_clean(toks, segment=F.floor(F.col("ord") / 4)).collect())) == want
    assert bio.validate_tokens(bio.repair_until_clean(toks)).count() == 0
    plan = bio.repair_until_clean(toks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1


def test_records_without_an_id_are_not_copies(spark):
    rows = [("", "a"), ("", "b"), (None, "c"), ("1", "short"), ("1", "the longest"), ("1", "longest too"), ("2", None)]
    df = spark.createDataFrame(rows, "pmid string, text string").repartition(3)
    got = sorted(map(tuple, corpus.one_per_id(df, "pmid", F.col("text")).collect()), key=repr)
    assert got == sorted([("", "a"), ("", "b"), (None, "c"), ("1", "the longest"), ("2", None)], key=repr)
