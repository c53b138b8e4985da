"""Statistics in one scan, mergeable distinct counts, year folders read through a list."""

import os

from pyspark.sql import functions as F

from conftest import SF01
from tessera.operators import profile as pf
from tessera.operators import quality as ql
from tessera.sinks import writers


def test_statistics_take_one_scan(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    stats = pf.corpus_statistics(orders, year=F.year("o_orderdate"), journal="o_orderpriority", language="o_orderstatus", word_count="o_totalprice",
                                 structured=F.col("o_orderstatus") == "F", stage_counts={"final": 1})
    row = stats.first()
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    years = orders.groupBy(F.year("o_orderdate").alias("y")).count().orderBy(F.desc("count"), "y").limit(10).collect()
    assert row["top_years"] == {str(r["y"]): r["count"] for r in years}
    assert row["total_articles"] == orders.count() and row["collection_stats"] == {"final": 1}


def test_statistics_of_odd_rows(spark):
    schema = "y int, j string, l string, w int, s boolean"
    rows = [(2000 + i % 13, f"j{i % 25}", None if i % 7 == 0 else "en", i, i % 2 == 0) for i in range(200)] + [(None, None, None, None, None)] * 3
    row = pf.corpus_statistics(spark.createDataFrame(rows, schema), "y", "j", "l", word_count="w", structured="s").first()
    assert row["total_articles"] == 203 and (row["year_earliest"], row["year_latest"]) == (2000, 2012) and row["structured_abstracts"] == 100
    assert len(row["top_years"]) == 10 and len(row["top_journals"]) == 20 and "Unknown" not in row["top_journals"]
    assert row["language_distribution"] == {"en": sum(r[2] == "en" for r in rows)}
    empty = pf.corpus_statistics(spark.createDataFrame([], schema), "y", "j", "l", word_count="w", structured="s").first()
    assert empty["total_articles"] == 0 and empty["structured_abstracts"] == 0 and empty["year_earliest"] is None and empty["top_years"] == {}


def test_sketches_merge_to_the_count_of_the_whole(spark):
    df = spark.range(120_000).select((F.col("id") % 10).cast("int").alias("year"), (F.col("id") % 3).alias("strategy"), (F.col("id") % 40_000).alias("v"))
    sketches = pf.distinct_sketches(df, ["year", "strategy"], "v")
    assert sketches.count() == 30 and sketches.agg(F.max(F.length("sketch"))).first()[0] < 3 * 2**12
    for keys in ([], ["year"], ["strategy"]):
        exact = {tuple(r)[:-1]: r["n"] for r in df.groupBy(*keys).agg(F.count_distinct("v").alias("n")).collect()}
        got = {tuple(r)[:-1]: r["distinct"] for r in pf.distinct_estimates(sketches, keys).collect()}
        assert set(got) == set(exact) and all(abs(got[k] - n) <= 4 * 1.04 / 64 * n for k, n in exact.items())
    nulls = spark.createDataFrame([(1, None), (2, 5)], "year int, v long")
    assert {r["year"]: r["distinct"] for r in pf.distinct_estimates(pf.distinct_sketches(nulls, ["year"], "v"), ["year"]).collect()} == {1: 0, 2: 1}


def test_only_the_folders_of_listed_years_are_read(spark, tmp_path):
    out = str(tmp_path / "corpus")
    arts = spark.range(4000).select("id", (F.lit(1990) + F.col("id") % 40).cast("int").alias("year"), F.lit("x").alias("title"))
    writers.write_article_dataset(arts, out, year="year")
    folders = spark.read.parquet(os.path.join(out, "articles"))
    years = spark.createDataFrame([(1991,), (2005,), (2005,), (1800,), (None,)], "year int")
    got = ql.in_listed_years(folders, years)
    assert {r["year"]: r["count"] for r in got.groupBy("year").count().collect()} == {1991: 100, 2005: 100}
    assert len(got.collect()) == 200
    scans = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert scans and all("dynamicpruning" in x for x in scans)
    files = ql.in_listed_years(folders.withColumn("f", F.col("_metadata.file_path")), years).select("f").distinct().collect()
    assert {os.path.basename(os.path.dirname(r["f"])) for r in files} == {"year=1991", "year=2005"}
