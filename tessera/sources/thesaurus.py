"""Thesaurus sources.

The descriptor XML is read with Spark's XML source (``rowTag`` =
``DescriptorRecord``) and an explicit schema of the fields used -- no mixed
content occurs in these fields, so the struct reading is safe, and the source
splits the large file across tasks.  The three derived tables are written as
parquet and reloaded on later runs.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.thesaurus import tree_names

DESCRIPTOR_XML_SCHEMA = (
    "DescriptorUI string, DescriptorName struct<String:string>, "
    "TreeNumberList struct<TreeNumber:array<string>>"
)
TABLES = ("descriptor", "descriptor_tree", "tree_name")


def read_descriptor_records(spark: SparkSession, path: str) -> DataFrame:
    """A3: one row per ``DescriptorRecord`` with its position in the source:
    file, start of the block it was read from, and place in that block -- the
    same however Spark packs files and blocks into tasks."""
    raw = spark.read.format("xml").option("rowTag", "DescriptorRecord").schema(DESCRIPTOR_XML_SCHEMA).load(path)
    return raw.select(
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("place")).alias("rec"),
        F.col("DescriptorUI").alias("ui"),
        F.col("DescriptorName.String").alias("name"),
        F.filter(F.coalesce(F.col("TreeNumberList.TreeNumber"), F.array().cast("array<string>")),
                 lambda t: t.isNotNull() & (t != "")).alias("tree_numbers"),
    )


def build_thesaurus(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A3 -> ``(descriptor, descriptor_tree, tree_name)``.

    Records without an id are skipped; for a repeated id the later record's
    name and tree numbers win, while its source order is that of its first
    record with tree numbers (ties between descriptors sharing a tree number
    go to the earlier one)."""
    recs = records.where(F.col("ui").isNotNull())
    descriptor = recs.where(F.col("name").isNotNull()).groupBy("ui").agg(F.max_by("name", "rec").alias("name"))
    with_trees = recs.where(F.size("tree_numbers") > 0)
    trees = with_trees.groupBy("ui").agg(
        F.max_by("tree_numbers", "rec").alias("tree_numbers"), F.min("rec").alias("ord"))
    descriptor_tree = trees.select("ui", F.explode("tree_numbers").alias("tree_number"), "ord").distinct()
    return descriptor, descriptor_tree, tree_names(descriptor, descriptor_tree)


def write_thesaurus(tables: tuple[DataFrame, DataFrame, DataFrame], out_dir: str) -> None:
    """L2: the three tables as parquet."""
    for name, df in zip(TABLES, tables):
        df.write.mode("overwrite").parquet(os.path.join(out_dir, name))


def load_thesaurus(spark: SparkSession, table_dir: str) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """A4: the three tables, or ``None`` when they were never built."""
    try:
        return tuple(spark.read.parquet(os.path.join(table_dir, n)) for n in TABLES)  # type: ignore[return-value]
    except AnalysisException:
        return None


def load_or_build_thesaurus(spark: SparkSession, xml_path: str, table_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reuse the derived tables when present, else build, write and reload them."""
    found = load_thesaurus(spark, table_dir)
    if found is not None:
        return found
    write_thesaurus(build_thesaurus(read_descriptor_records(spark, xml_path)), table_dir)
    return load_thesaurus(spark, table_dir)  # type: ignore[return-value]
