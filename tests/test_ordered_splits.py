"""Stitched positions (G2), split membership (K6) and label matrices (K5)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import ordered, splits


def test_segmented_positions_equal_row_number(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 3).cast("string").alias("k"), ((F.col("id") * 7919) % 3001).alias("o"))
    plain = df.withColumn("ord", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    seg = ordered.positions(df, "k", ["o"], segment=F.floor(F.col("o") / 97))
    assert plain.exceptAll(seg.select("k", "o", "ord")).count() == 0
    assert seg.count() == 3000


def test_split_membership_is_a_partition_and_stable(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "doc_id")
    a = splits.assign_splits(df, "doc_id")
    b = splits.assign_splits(df.repartition(7), "doc_id")
    assert a.exceptAll(b).count() == 0
    sizes = {r["split"]: r["count"] for r in splits.split_sizes(a).collect()}
    assert sum(sizes.values()) == 5000
    assert abs(sizes["test"] / 5000 - 0.2) < 0.03 and abs(sizes["val"] / 5000 - 0.16) < 0.03


def test_exact_split_sizes(spark):
    df = spark.range(0, 1001).withColumnRenamed("id", "doc_id")
    sizes = {r["split"]: r["count"] for r in splits.split_sizes(splits.assign_splits_exact(df, "doc_id")).collect()}
    assert sizes == {"test": 201, "val": 160, "train": 640}


def test_multilabel_matrix(spark):
    df = spark.createDataFrame([("1", "Anatomy; Health Care"), ("2", "Diseases"), ("3", "Named Groups; Anatomy")],
                               "pmid string, level1_categories_str string")
    classes = splits.label_classes(df)
    assert classes == sorted(classes)
    m = {r["pmid"]: r for r in splits.multilabel_matrix(df, classes).collect()}
    assert m["1"]["category_Anatomy"] == 1 and m["1"]["category_Health_Care"] == 1 and m["1"]["category_Diseases"] == 0
    assert splits.category_column_name("Analytical, Diagnostic (x)-y") == "category_Analytical_Diagnostic_x_y"
    lc = {r["category"]: r for r in splits.label_counts(df).collect()}
    assert lc["Anatomy"]["count"] == 2 and lc["Anatomy"]["total_samples"] == 3


def test_positions_and_previous_equal_windows(spark):
    df = spark.range(0, 2000).select(
        (F.col("id") % 4).cast("string").alias("k"), ((F.col("id") * 7919) % 2003).alias("o"),
        (F.col("id") % 13).cast("string").alias("v"))
    w = Window.partitionBy("k").orderBy("o")
    plain = df.withColumn("ord", F.row_number().over(w)).withColumn("prev", F.lag("v").over(w))
    seg = ordered.positions_and_previous(df, "k", ["o"], "v", segment=F.floor(F.col("o") / 61))
    assert plain.exceptAll(seg.select("k", "o", "v", "ord", "prev")).count() == 0
    assert seg.count() == 2000
