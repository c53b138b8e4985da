"""Sinks (L1-L11).  Tables are plain ``DataFrameWriter`` calls: folders of part
files (Spark's unit of parallel output), never a single document assembled on
the driver.  Outputs whose file names matter go through :mod:`tessera.sinks.files`.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tessera.operators import bio
from tessera.sinks.files import write_named_files
from tessera.sources import tokens as tk


def _arrays_to_json(df: DataFrame) -> DataFrame:
    """CSV has no nested types: arrays/maps/structs become JSON text."""
    return df.withColumns({
        f.name: F.to_json(f.name) for f in df.schema.fields
        if isinstance(f.dataType, (ArrayType, MapType, StructType))
    })


def _write_csv(df: DataFrame, path: str, *partitions: str) -> None:
    """Header CSV that standard readers understand: quotes inside a cell are
    doubled, nested columns are JSON text."""
    w = _arrays_to_json(df).write.mode("overwrite").option("header", True).option("escape", '"')
    (w.partitionBy(*partitions) if partitions else w).csv(path)


def write_article_dataset(articles: DataFrame, out_dir: str, metadata: DataFrame | None = None,
                          statistics: DataFrame | None = None, fmt: str = "parquet", year: str | None = None) -> None:
    """Articles as parquet (or JSON lines) plus one-row metadata and
    statistics JSON beside them.  With ``year``, a column to deal the articles
    out by, they are written in one folder per year, so that a range of years
    (C6) reads only its folders."""
    w = (articles.repartition(year) if year else articles).write.mode("overwrite")
    w = w.partitionBy(year) if year else w
    (w.parquet if fmt == "parquet" else w.json)(os.path.join(out_dir, "articles"))
    if metadata is not None:
        metadata.coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "metadata"))
    if statistics is not None:
        statistics.coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "statistics"))


def write_category_csv(df: DataFrame, path: str) -> None:
    """L3: the category table as CSV with a header; list columns as JSON text."""
    if not path.endswith(".csv"):
        raise ValueError("the category table is written only to a path ending in .csv")
    _write_csv(df, path)


def read_category_csv(spark, path: str, schema: str) -> DataFrame:
    """Header CSV with quoted multi-line cells; empty cells -> null."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').csv(path))


def write_request_files(requests: DataFrame, out_dir: str) -> None:
    """L4: JSON lines, one file ``batch_<number>.jsonl`` per batch, in the order
    of the requests."""
    write_named_files(requests.select(F.format_string("batch_%05d.jsonl", F.col("batch_no").cast("long")).alias("file"), F.struct("source_file", "chunk_index").alias("ord"),
                                      F.to_json("request").alias("line")), out_dir)


def write_token_files(tokens: DataFrame, out_dir: str, label_col: str = "label") -> None:
    """``token<TAB>label`` lines, one file of its own name per source file."""
    write_named_files(tk.render_token_lines(tokens.withColumn("label", F.col(label_col))), out_dir)


def write_validation_report(verdicts: DataFrame, errors: DataFrame, out_dir: str) -> None:
    """Per-file verdict JSON with the file's errors in it, a one-row summary
    (D20 and the errors per type) and an errors CSV (missing fix -> ``N/A``)."""
    nested = errors.groupBy("file").agg(F.sort_array(F.collect_list(F.struct(
        F.col("line_number").alias("line"), "rule", "token", "label", F.col("error_type").alias("type"), "description", "suggested_fix"))).alias("errors"))
    verdicts.join(nested, "file", "left").write.mode("overwrite").json(os.path.join(out_dir, "files"))
    types = errors.groupBy("error_type").agg(F.count("*").alias("n")).agg(
        F.map_from_entries(F.collect_list(F.struct("error_type", "n"))).alias("error_type_distribution"))
    summary = bio.validation_summary(verdicts).withColumn("_k", F.lit(1)).join(types.withColumn("_k", F.lit(1)), "_k").drop("_k")
    summary.coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "summary"))
    _write_csv(errors.select(
        "file", "line_number", "token", "label", "error_type", "description",
        F.coalesce("suggested_fix", F.lit("N/A")).alias("suggested_fix"),
    ), os.path.join(out_dir, "errors"))


def write_splits(df: DataFrame, out_dir: str) -> None:
    """One CSV folder per split value."""
    _write_csv(df, out_dir, "split")


def write_info(info: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Small info records as JSON."""
    info.coalesce(1).write.mode(mode).json(path)


def write_records(records: DataFrame, path: str, name: Column) -> None:
    """A JSON file ``name`` per record; writing a record again replaces its
    file, so a rerun adds none twice."""
    write_named_files(records.select(name.alias("file"), F.lit(0).alias("ord"), F.to_json(F.struct(*records.columns)).alias("line")), path, mode="append")


def write_names(names: DataFrame, path: str, column: str = "name") -> None:
    """A list of names, one per line, sorted."""
    names.select(column).orderBy(column).write.mode("overwrite").text(path)
