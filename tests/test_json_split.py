"""One JSON document cut by many tasks: the same articles as when it is parsed whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tessera.sources import articles as art
from tessera.sources.json_split import array_elements, pieces


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


NASTY = ['quote " inside', "brace } and {", "] [ \\ backslash", 'end\\', '\\"}', "tab\t, nl\n", '"articles": [', "é🙂}", "", '{"articles":[{"x":1}]}']


def documents():
    rng = random.Random(2)

    def value(depth=0):
        kind = rng.randrange(6 if depth < 3 else 3)
        return [rng.choice(NASTY), rng.randrange(9), None][kind] if kind < 3 else (
            {rng.choice([*NASTY, "articles", "a", "b"]): value(depth + 1) for _ in range(rng.randrange(4))} if kind == 3 else
            [value(depth + 1) for _ in range(rng.randrange(4))] if kind == 4 else [[], [[1, [2]]], {}][rng.randrange(3)])

    for n in (0, 1, 5, 300):
        arts = [{"pmid": str(i), "v": value(), "w": [value() for _ in range(3)]} for i in range(n)]
        yield {"articles": arts}
        yield {"metadata": value(), "n": 3, "list": [[1, 2], "articles"], "statistics": {"articles": [{"no": 1}]}, "articles": arts, "later": [{"x": 1}, {"y": [{}]}]}
    yield {"other": [{"a": 1}], "nested": {"articles": [{"b": 2}]}}


@pytest.mark.parametrize("indent", [None, 1])
def test_elements_of_odd_documents(spark, tmp_path, small_blocks, indent):
    want = {}
    for k, doc in enumerate(documents()):
        (tmp_path / f"d{k}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=k % 2 == 0) + "\n" * (k % 3), encoding="utf-8")
        want[f"d{k}.json"] = doc.get("articles", [])
    assert pieces(spark, str(tmp_path)).select("file", "block").distinct().count() > 2 * len(want)
    got = {name: {} for name in want}
    for r in array_elements(spark, str(tmp_path), "articles").collect():
        got[r["file"].rsplit("/", 1)[1]][r["number"]] = json.loads(r["json"])
    assert {name: [x[i] for i in sorted(x)] for name, x in got.items()} == want


def test_one_document_equals_json_lines(spark, tmp_path, small_blocks):
    orders = spark.read.parquet(f"{SF01}/orders.parquet").limit(500).select(F.struct(
        F.col("o_orderkey").cast("string").alias("pmid"), F.concat(F.lit('say "hi" } ] {['), "o_orderpriority").alias("title"),
        F.struct(F.lit("a\\b").alias("full_text"), F.lit(True).alias("has_content")).alias("abstract"),
        F.struct(F.year("o_orderdate").cast("string").alias("year")).alias("publication_info")).alias("a"))
    lines = [r[0] for r in orders.select(F.to_json("a")).collect()]
    (tmp_path / "doc.json").write_text('{"metadata": {"total_articles": 500}, "articles": [\n' + ",\n".join(lines) + '\n], "statistics": {"total_articles": 500}}')
    (tmp_path / "lines.jsonl").write_text("\n".join(lines))
    by_lines = art.read_articles(spark, str(tmp_path / "lines.jsonl"))
    articles = art.read_articles(spark, str(tmp_path / "doc.json"), "document")
    assert articles.schema == by_lines.schema
    assert sorted(map(repr, articles.collect())) == sorted(map(repr, by_lines.collect())) and articles.count() == 500
