"""Elements of an array in one large JSON document, read by many tasks (A1).

The text source can cut a file at any separator, so the document is read as
pieces that each end in ``}``, in as many tasks as it has blocks.  What a piece
means depends on what lies before it: whether it starts inside a string, and at
which depth.  Both are running sums -- of unescaped quotes, and of brackets
outside strings -- taken inside each segment of a block and shifted by the
totals of the segments before, of which there is one row a segment.  With them
the pieces that belong to one element are known, and are put together by its
number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import reusable

MARK = "\u0001"
SEGMENT_BITS = 15  # a running sum is taken over 2 ** 15 pieces at once


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, segment, place, text`` of the pieces of the documents at
    ``path``; a segment is some of the pieces of a block that follow each other."""
    raw = spark.read.option("lineSep", "}").text(path)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return reusable(raw.select(at.alias("at"), F.monotonically_increasing_id().alias("place"), F.concat("value", F.lit("}")).alias("text"))).select(
        "at.file", "at.block", F.shiftright("place", SEGMENT_BITS).alias("segment"), "place", "text")


def running_sum(df: DataFrame, value: Column, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the pieces of the file
    before this one."""
    valued = df.withColumn("_value", value)
    segment = ["file", "block", "segment"]
    inside = Window.partitionBy(*segment).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    totals = valued.groupBy(*segment).agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy("file").orderBy("block", "segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*segment, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    placed = valued.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return placed.join(F.broadcast(starts), segment).withColumn(out, F.col("_start") + F.col("_inside")).drop("_value", "_inside", "_start")


def count_of(text: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def array_elements(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``file, number, json`` of the objects in the array ``key`` at the top of
    each JSON document at ``path``: their order in it from 0, and their text.

    The documents are valid UTF-8 JSON, and the array's elements are objects.
    A document without the key, or with an empty array, has no rows."""
    unescaped = F.regexp_replace("text", r"(?s)\\.", "")
    quoted = running_sum(pieces(spark, path).withColumn("bare", unescaped), count_of(F.col("bare"), '"'), "quotes")
    outside = F.when(F.col("quotes") % 2 == 1, F.regexp_replace("bare", '^[^"]*"?', "")).otherwise(F.col("bare"))
    marked = F.replace(outside, F.lit(f'"{key}"'), F.lit(MARK))
    skeleton = F.regexp_replace(F.regexp_replace(marked, '"[^"]*"', ""), '"[^"]*$', "")
    shaped = quoted.withColumn("skeleton", skeleton).drop("bare", "quotes")
    change = count_of(F.col("skeleton"), r"\[{") - count_of(F.col("skeleton"), r"\]}")
    deep = reusable(running_sum(shaped, change, "depth").withColumn("after", F.col("depth") + change))

    # The array begins in a piece that is in the document's object where the key is met, all arrays before it closed.
    before = F.regexp_extract("skeleton", rf"(?s)^(.*?){MARK}\s*:\s*\[", 1)
    begins = (F.col("skeleton").rlike(rf"{MARK}\s*:\s*\[") & (F.col("depth") <= 1) & (count_of(before, "{") == 1 - F.col("depth"))
              & (count_of(before, r"\[") == count_of(before, r"\]")))
    rest = rf'(?s)^.*?"{key}"\s*:\s*\[(.*)$'
    closes = ((F.col("depth") == 2) & F.col("skeleton").rlike(r"^\s*\]")) | (begins & F.col("skeleton").rlike(rf"{MARK}\s*:\s*\[\s*\]"))
    where = F.struct("block", "place")
    marks = deep.withColumns({"begins": begins, "closes": closes})
    starts = marks.where("begins").groupBy("file").agg(F.min(where).alias("start"))
    ends = marks.where("closes").join(F.broadcast(starts), "file").where(where >= F.col("start")).groupBy("file").agg(F.min(where).alias("stop"))
    inside = marks.join(F.broadcast(starts), "file").join(F.broadcast(ends), "file", "left").where(
        (where >= F.col("start")) & (F.col("stop").isNull() | (where < F.col("stop"))))
    done = (F.col("after") == 2) & F.col("skeleton").endswith("}")
    numbered = running_sum(inside.select("file", "block", "segment", "place", "skeleton", "after",
                                         F.when(F.col("begins"), F.regexp_extract("text", rest, 1)).otherwise(F.col("text")).alias("text")),
                           done.cast("int"), "number")
    whole = numbered.groupBy("file", "number").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "place", "text"))), lambda p: p["text"]), "").alias("json"))
    return whole.select("file", "number", F.regexp_replace("json", r"^[\s,]+", "").alias("json")).where(F.col("json").startswith("{"))
