"""Batch results: parsing, reassembly and the retry set.

Results arrive as JSON lines ``{custom_id, response: {status_code, body}}``.
They are read with a declared schema (never inferred), split into ok and
failed rows, parsed into tokens, and regrouped per source file in chunk
order.  Chunks of one file are bounded by the file's size, so the regroup
``collect_list`` is bounded per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators.chunking import custom_id_file, custom_id_index
from tessera.operators.joins import anti_join
from tessera.operators.quality import ok_result

RESULT_SCHEMA = (
    "custom_id string, response struct<status_code:int, "
    "body:struct<choices:array<struct<message:struct<content:string>>>>>"
)
TOKENS_TYPE = "array<struct<token:string,label:string>>"


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result JSONL with the declared schema."""
    return spark.read.schema(RESULT_SCHEMA).json(path)


def parse_result_json(lines: DataFrame, col: str = "value") -> DataFrame:
    """Result records from JSON text lines."""
    return lines.select(F.from_json(F.col(col), RESULT_SCHEMA).alias("r")).select("r.*")


def result_content(response: Column) -> Column:
    """Text of the first choice (null when there is none)."""
    return F.try_element_at(response["body"]["choices"], F.lit(1))["message"]["content"]


def parse_translation(content: Column) -> Column:
    """Stripped non-empty lines with a tab; first two columns -> (token, label)."""
    lines = F.filter(F.transform(F.split(F.coalesce(content, F.lit("")), r"\r\n|\r|\n"), tx.strip_ws),
                     lambda s: (s != "") & s.contains("\t"))
    parts = F.transform(lines, lambda s: F.split(s, "\t"))
    ok = F.filter(parts, lambda p: F.size(p) >= 2)
    return F.transform(ok, lambda p: F.struct(p[0].alias("token"), p[1].alias("label")))


def split_results(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C14: (ok, failed) by HTTP status 200."""
    ok_flag = ok_result("response.status_code")
    return results.where(ok_flag), results.where(~ok_flag)


def translated_chunks(ok_results: DataFrame) -> DataFrame:
    """Ok results as ``(source_file, chunk_index, tokens)`` (B12 + J13)."""
    return ok_results.select(
        custom_id_file(F.col("custom_id")).alias("source_file"),
        custom_id_index(F.col("custom_id")).alias("chunk_index"),
        parse_translation(result_content(F.col("response"))).alias("tokens"),
    )


def latest_chunks(chunks: DataFrame, order: str | None = None) -> DataFrame:
    """One row per (source_file, chunk_index): the one of largest ``order``;
    among equals, or without an order, the one with the largest tokens."""
    key = F.struct(*([order] if order else []), "tokens")
    best = chunks.groupBy("source_file", "chunk_index").agg(F.max(key).alias("_best"))
    return best.select("source_file", "chunk_index", F.col("_best.tokens").alias("tokens"))


def reassemble(chunks: DataFrame, totals: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """Concatenate each file's chunk tokens in chunk order (not arrival
    order), reporting which chunk indexes are present.  A chunk that was
    delivered several times counts once (see :func:`latest_chunks`).  With
    ``totals`` (``source_file, total_chunks``) the missing indexes of every
    file are reported too, also of files without any chunk."""
    g = latest_chunks(chunks, order).groupBy("source_file").agg(
        F.sort_array(F.collect_list(F.struct("chunk_index", "tokens"))).alias("_parts"))
    out = g.select(
        "source_file",
        F.transform("_parts", lambda p: p["chunk_index"]).alias("chunk_indexes"),
        F.flatten(F.transform("_parts", lambda p: p["tokens"])).alias("tokens"),
    )
    if totals is None:
        return out
    every = F.when(F.col("total_chunks") > 0, F.sequence(F.lit(0), F.col("total_chunks").cast("int") - 1))
    none = F.array().cast("array<int>")
    return totals.select("source_file", "total_chunks").join(out, "source_file", "left").withColumn(
        "missing", F.array_except(F.coalesce(every, none), F.coalesce(F.col("chunk_indexes").cast("array<int>"), none)))


def retry_set(requests: DataFrame, ok_results: DataFrame) -> DataFrame:
    """Requests without a successful result (left anti join on custom_id)."""
    return anti_join(requests, ok_results.select("custom_id"), "custom_id")
