"""Line dedup against a plain statement of it."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import line_keep
from tessera.llm.common import text_key

SCHEMA = "doc_id long, text string"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain(rows):
    """(doc_id, n_lines, n_dropped, kept text) of every row, as the contract says it."""
    order = lambda i: (i is not None, i)
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(i)
    last = {k: max(v, key=order) for k, v in held.items() if len(k) >= 40 and len(v) >= 5}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def digest(rows):
    return sorted(((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in rows), key=repr)


def odd_rows():
    rng = random.Random(3)
    pool = ["".join(rng.choices("abc É🙂dEF", k=n)) for n in (38, 39, 40, 41, 60, 200)] + ["x" * 40, "y" * 39, "É" * 40, "🙂" * 20]
    rows = [(i, "\n".join(rng.choices([*pool, "", " ", "short"], k=rng.randrange(1, 8)))) for i in range(80)]
    rows += [(100 + i, f" \t{pool[4].upper()}\x0b\r\n{i}") for i in range(6)]  # same key, other case and ends
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, pool[4] + "\n" + pool[5]), (None, pool[4]), (None, None)]
    rows += [(203, "\n".join(rng.choices(pool, k=20_000))), (204, "x" * 300_000), (5, "x" * 40), rows[3], rows[3], rows[3]]
    rows += [(300 + i, "z" * 45) for i in range(4)] * 3  # four documents, however often they are repeated
    return rows


@pytest.fixture(params=[line_keep.SEGMENT_ROWS, 3])  # 3: every range is crowded, so keys are cut to segments
def segment_rows(request, monkeypatch):
    monkeypatch.setattr(line_keep, "SEGMENT_ROWS", request.param)


def test_against_a_plain_statement(spark, segment_rows):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("doc", "of", "keep", "lines", "n_lines", "h1", "seg", "word", "__doc")})
    got = line_keep.dedup_lines(docs).drop("keep").collect()
    assert sorted((tuple(r) for r in got), key=repr) == digest(plain(rows))


def test_texts_and_bitmaps(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.lit("mine"))
    bitmaps = line_keep.keep_bitmaps(docs)
    left = line_keep.drop_lines(docs, bitmaps)
    want = sorted(((i, t) for i, _, _, t in plain(rows)), key=repr)
    assert sorted(((r["doc_id"], r["text"] or "") for r in left.collect()), key=repr) == want
    assert left.columns[:3] == docs.columns and {r["n_chars"] for r in left.collect()} == {"mine"}
    of = {(r["doc_id"], r["k"]): r["text"] or "" for r in docs.select("doc_id", "text", text_key(F.col("text")).alias("k")).collect()}
    for r in bitmaps.collect():  # bits tell the same as the texts
        lines = of[r["doc"], r["of"]].split("\n")
        words = {w["word"]: w["kept"] for w in r["keep"]}
        assert all(0 <= k < line_keep.FULL for k in words.values()) and list(words) == sorted(words)
        kept = [x for j, x in enumerate(lines) if words.get(j // 32, line_keep.FULL) >> (j % 32) & 1]
        assert len(lines) - len(kept) == r["n_dropped"] > 0
        assert (r["doc"], "\n".join(kept)) in want


def test_one_line_in_nearly_all_documents(spark, monkeypatch):
    monkeypatch.setattr(line_keep, "SEGMENT_ROWS", 50)
    notice = "this notice is at the foot of every single page here"
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("page "), F.col("id"), F.lit("\n" + notice)).alias("text"))
    rows = line_keep.long_lines(docs, "text", "doc_id", 40)
    assert line_keep.segments(rows).groupBy("h1", "h2", "seg").count().agg(F.max("count")).first()[0] < 120
    got = line_keep.dedup_lines(docs)
    assert got.filter("n_dropped = 1").count() == 4999 and got.filter("n_dropped = 0").first()["doc_id"] == 4999


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_keep.dedup_lines(empty).collect() == [] and line_keep.keep_bitmaps(empty).collect() == []
