"""Quality rules by cross-document line frequency (operator 9).

Measures of a text are taken in one pass with array functions.  The lines of a
document are hashed after normalising (case, digits, spaces); per host the
documents that hold a line are counted, lines above the limit are removed, and
a document that keeps too few of its words is rejected.

Copies must not make a text look like boilerplate: documents of a host with
the same set of lines count as one.  The limit is a count of documents, a share
of a host's documents, or both.  A count (``NOTICES``) finds notices on hosts of
any size; documents made of shared lines for the most part are not counted then,
so that a group of near copies does not make its own text a notice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CLASS, stage, text_key, words

#: Words a document needs, and the share of repeated words it may have.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Limits that do not grow with the host: lines of six words or more in 20
#: documents of it that have at least half of their words elsewhere.
NOTICES = {"min_docs": 20, "max_share": 0.0, "min_line": 6, "max_shared": 0.5}


def repeat_words(w: Column, n: int = 3) -> Column:
    """Words of ``w`` in ``n``-word windows found twice or more in ``w``.

    Window hashes are shifted up to make room for the window's place and
    sorted as longs, so equal windows are neighbours: n log n steps, however
    often a window repeats.  A long text's places leave few bits to the hash,
    so windows whose bits agree are then compared by their words."""
    m = F.size(w) - (n - 1)
    bits = F.length(F.bin(m.cast("long")))

    def high(x):
        return F.call_function("shiftrightunsigned", x, bits)

    def packed(i):
        return F.call_function("shiftleft", F.xxhash64(F.slice(w, i + 1, n)), bits).bitwiseOR(i.cast("long"))

    def alike(p):
        twice = F.filter(p, lambda x, k: high(F.get(p, k - 1)).eqNullSafe(high(x)) | high(F.get(p, k + 1)).eqNullSafe(high(x)))
        place = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        return F.sort_array(F.transform(twice, lambda x: F.struct(
            F.slice(w, x.bitwiseAND(place).cast("int") + 1, n).alias("k"), x.bitwiseAND(place).alias("i"))))

    def places(s):
        equal = F.filter(s, lambda x, k: F.get(s, k - 1)["k"].eqNullSafe(x["k"]) | F.get(s, k + 1)["k"].eqNullSafe(x["k"]))
        return F.sort_array(F.transform(equal, lambda x: x["i"]))

    def covered(s):
        steps = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, z: F.least(F.lit(n).cast("long"), F.coalesce(z - a, F.lit(n).cast("long"))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda t, x: t + x)

    sorted_windows = F.sort_array(F.transform(F.sequence(F.lit(0), m - 1), packed))
    found = F.transform(F.transform(F.transform(F.array(sorted_windows), alike), places), covered)
    return F.when(m < 2, F.lit(0).cast("long")).otherwise(found[0])


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_key(line: Column) -> Column:
    """Hash of a normalised line: lower case, digit runs as 0, single spaces."""
    low = F.regexp_replace(F.lower(line), "[0-9]+", "0")
    return F.xxhash64(F.trim(F.regexp_replace(low, SPACE_CLASS, " ")))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus word, symbol, line and repetition measures of ``text``
    (null or empty: all 0) and ``lines``, the hash and word count of each line
    that has a word."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns({"__w": words(t), "__l": F.filter(F.split(t, "\n"), has_word)})
    out = out.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.length(F.array_join("__w", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "n_repeat_words": repeat_words(F.col("__w")),
        "lines": F.transform("__l", lambda x: F.struct(line_key(x).alias("h"), F.size(words(x)).alias("w"))),
    })
    return out.drop("__w", "__l")


def busy_lines(lines: DataFrame, host: str, min_docs: int, max_share: float, min_line: int = 0, max_shared: float = 1.0) -> DataFrame:
    """Rows ``host, h`` of the lines of ``min_line`` words or more that more than
    ``max_share`` of a host's distinct documents hold, and ``min_docs`` of them
    at least.  ``lines`` has a row per document with its host and ``lines``.

    Below 1, ``max_shared`` is the share of a document's words that such lines
    may have for it to be counted: a document made of little else is a near
    copy of others and no witness of a notice."""
    keys = F.transform("lines", lambda x: x["h"])
    own = lines.filter(F.size("lines") > 0).select(
        F.col(host).alias("host"), "lines", F.array_sort(F.array_distinct(keys)).alias("keys")).withColumn("sig", F.xxhash64("keys"))
    hosts = own.select("host", "sig").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"))

    def above(held):
        per_line = held.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)
        if not max_share:
            return per_line.select("host", "h")
        both = per_line.join(hosts, per_line["host"].eqNullSafe(hosts["host"]))
        return both.filter(F.col("n") > max_share * F.col("n_docs")).select(per_line["host"], "h")

    if not min_line and max_shared >= 1:
        return above(own.select("host", "sig", F.explode("keys").alias("h")).distinct())
    held = own.select("host", "sig", F.explode(F.array_distinct("lines")).alias("line")).select(
        "host", "sig", F.col("line.h").alias("h"), F.col("line.w").alias("w")).distinct()
    if max_shared >= 1:
        return above(held.filter(F.col("w") >= min_line))
    held = stage(held, "held_lines")
    found = stage(above(held.filter(F.col("w") >= min_line)), "shared_lines")
    shared = held.join(found, (held["h"] == found["h"]) & held["host"].eqNullSafe(found["host"])).select(held["host"], "sig", held["h"], "w")
    sizes = held.groupBy("host", "sig").agg(F.sum("w").alias("n"))
    parts = shared.groupBy("host", "sig").agg(F.sum("w").alias("w"), F.collect_list("h").alias("keys"))
    both = parts.join(sizes, (parts["sig"] == sizes["sig"]) & parts["host"].eqNullSafe(sizes["host"]))
    witness = both.filter(F.col("w") <= max_shared * F.col("n"))
    return above(witness.select(parts["host"], F.explode("keys").alias("h")))


def without_lines(text: Column, keys: Column) -> Column:
    """``text`` without the lines whose :func:`line_key` is among ``keys``; null
    or no keys leave it as it is."""
    left = F.filter(F.split(text, "\n"), lambda x: ~(has_word(x) & F.array_contains(keys, line_key(x))))
    return F.when(F.size(F.coalesce(keys, F.array().cast("array<bigint>"))) > 0, F.array_join(left, "\n")).otherwise(text)


def judge_documents(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", host: str = "source",
                    min_docs: int = 20, max_share: float = 0.4, min_left: float = 0.3,
                    min_line: int = 0, max_shared: float = 1.0, removed_keys: str | None = None) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep``, the measures,
    ``base_failed`` (fewer than 50 words, or over half of them repeated),
    ``n_removed_lines``, ``n_removed_words`` (lines above the limit) and
    ``kept``: not base-failed, and ``min_left`` of its words left.  With
    ``removed_keys``, a column of that name has the keys of the lines above the
    limit (null: none), which :func:`without_lines` takes.

    Null and empty texts have no words and fail the base rule; a null host is
    a host of its own; repeated rows are judged each by itself; an empty table
    gives an empty table; other columns of ``docs`` are left out, so they
    cannot clash."""
    rows = docs.select(*keep, F.col(host).alias("__host"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    judged = stage(measures(rows, "__text").drop("__text").withColumn("__row", F.monotonically_increasing_id()), "line_measures")
    busy = stage(busy_lines(judged, "__host", min_docs, max_share, min_line, max_shared), "busy_lines")
    lines = judged.select("__row", "__host", F.explode("lines").alias("line")).select(
        "__row", "__host", F.col("line.h").alias("h"), F.col("line.w").alias("w"))
    told = [F.count(F.lit(1)).alias("n_removed_lines"), F.sum("w").alias("n_removed_words")]
    if removed_keys:
        told.append(F.collect_set(lines["h"]).alias(removed_keys))
    removed = (lines.join(busy, (lines["h"] == busy["h"]) & lines["__host"].eqNullSafe(busy["host"]))
               .groupBy("__row").agg(*told))
    n_words, gone = F.col("n_words"), F.coalesce("n_removed_words", F.lit(0))
    base_failed = (n_words < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * n_words)
    return (judged.drop("lines").join(removed, "__row", "left")
            .withColumns({"base_failed": base_failed, "n_removed_lines": F.coalesce("n_removed_lines", F.lit(0)),
                          "n_removed_words": gone})
            .withColumn("kept", ~F.col("base_failed") & (n_words - F.col("n_removed_words") >= min_left * n_words))
            .drop("__row", "__host"))


def reject_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that :func:`judge_documents` keeps, with the lines
    above the limit cut out of ``text`` and nothing else changed."""
    keyed = docs.withColumn("__key", text_key(F.col(text)))
    judged = judge_documents(keyed.withColumn("__of", F.col(host)), (doc_id, "__key", "__of"), text, host, removed_keys="__gone", **limits)
    fate = (judged.filter("NOT kept OR n_removed_lines > 0")
            .select(F.col(doc_id).alias("__id"), F.col("__key").alias("__judged"), "__of", "kept", F.array_sort("__gone").alias("__gone"))
            .dropDuplicates(["__id", "__judged", "__of"]).withColumnRenamed("kept", "__kept"))
    same = (keyed["__key"] == fate["__judged"]) & keyed[doc_id].eqNullSafe(fate["__id"]) & keyed[host].eqNullSafe(fate["__of"])
    left = keyed.join(fate, same, "left").filter(F.coalesce("__kept", F.lit(True)))
    return left.withColumn(text, without_lines(F.col(text), F.col("__gone"))).select(*docs.columns)
