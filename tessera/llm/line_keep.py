"""Line dedup by range-partitioned hashes (operator 13).

Every long line is a row of its key's hash, its document and its position.  The
rows are range-partitioned by hash and sorted within by document, largest
first, and position, so a key's rows stream by with the first occurrence, which
stays, at the head.  What goes on from there is not text but bits: a document
that loses lines gets one row with its keep bitmap.

Hashes spread evenly, so a range of hashes that holds many times its share of
rows holds a line that very many documents have.  Such ranges are found by a
count per range and dealt to segments by document; the heads of a key's
segments are then compared, and every segment is told the key's totals.  A line
in a third of all documents is sorted in many tasks that way.

A bitmap is cut in words of 32 lines; words that keep all their lines are left
out, so it takes eight bytes for each 32 lines with a loss among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, stage, text_key

MIN_CHARS = 40
MIN_DOCS = 5

#: Ranges are told apart by this many leading bits of the hash.
RANGE_BITS = 18
#: A range above this many times the mean of all ranges, and above this many
#: rows, is dealt to segments of about that size.
CROWDED = 4
SEGMENT_ROWS = 1000

#: Lines in a word of a bitmap.
WORD = 32
FULL = (1 << WORD) - 1

# --- fixed values: characters stripped at the ends of a line ---------------------
STRIPPED = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """Lines of ``text``, split at \\n; null or empty gives one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """``line`` without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(STRIPPED))
    # Without letters beyond ASCII, lower() changes A-Z alone, and is faster.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(lower_ascii(bare))


def long_lines(docs: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    """Rows ``h1, h2, doc, of, pos``: the 128-bit hash of every key of at least
    ``min_chars`` code points, its document, the text's key, and its place."""
    def hashed(line):
        key = line_key(line["x"])
        return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), line["pos"].alias("pos"))

    placed = F.transform(lines_of(F.col(text)), lambda x, i: F.struct(x.alias("x"), i.alias("pos")))
    longer = F.filter(placed, lambda line: (F.length(line["x"]) >= min_chars) & (F.length(F.btrim(line["x"], F.lit(STRIPPED))) >= min_chars))
    rows = docs.select(F.col(doc_id).alias("doc"), text_key(F.col(text)).alias("of"), F.explode(F.transform(longer, hashed)).alias("line"))
    return rows.select("line.h1", "line.h2", "doc", "of", "line.pos").distinct()


def segments(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``parts``, how many segments the row's hash range is dealt
    to (1 for all but crowded ranges), and ``seg``, the document's segment.

    By the limit on the mean, at most a ``CROWDED``-th of the ranges are
    crowded: at most 2 ** RANGE_BITS / CROWDED rows of two numbers, which is
    the bound of what is broadcast."""
    rows = rows.withColumn("range", F.call_function("shiftrightunsigned", F.col("h1"), F.lit(64 - RANGE_BITS)))
    sizes = stage(rows.groupBy("range").agg(F.count(F.lit(1)).alias("n")), "line_ranges")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    limit = max(CROWDED * total / (1 << RANGE_BITS), SEGMENT_ROWS)
    crowded = sizes.filter(F.col("n") > limit).select("range", F.ceil(F.col("n") / F.lit(float(limit))).cast("int").alias("parts"))
    dealt = rows.join(F.broadcast(crowded), "range", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return dealt.withColumn("seg", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")).drop("range")


def lost_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """Rows ``doc, of, pos`` of :func:`long_lines` that go: those of keys in at
    least ``min_docs`` documents, but for the largest document's."""
    dealt = segments(rows).repartitionByRange("h1", "h2", "seg")
    group = Window.partitionBy("h1", "h2", "seg")
    stream = group.orderBy(F.col("doc").desc_nulls_last(), "of", "pos")
    ranked = dealt.withColumn("place", F.dense_rank().over(group.orderBy(F.col("doc").desc_nulls_last())))
    ranked = ranked.withColumns({"head": F.row_number().over(stream) == 1, "n_docs": F.max("place").over(group)})
    # A segment of one document says nothing alone; whole keys below the limit end here.
    ranked = stage(ranked.filter((F.col("parts") > 1) | ((F.col("n_docs") >= min_docs) & (F.col("place") > 1))), "ranked_lines")
    whole = ranked.filter("parts = 1")

    cut = ranked.filter("parts > 1")
    heads = cut.filter("head").groupBy("h1", "h2", "parts").agg(
        F.sum("n_docs").alias("docs"), F.max(F.struct(F.col("doc").isNotNull().alias("known"), "doc")).alias("last"))
    told = heads.filter(F.col("docs") >= min_docs).select(
        "h1", "h2", F.col("last.doc").alias("last"), F.explode(F.expr("sequence(0, parts - 1)")).alias("seg"))
    both = cut.join(told, ["h1", "h2", "seg"]).filter(~F.col("doc").eqNullSafe(F.col("last")))
    return whole.select("doc", "of", "pos").unionByName(both.select("doc", "of", "pos"))


def keep_bitmaps(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows ``doc, of, n_dropped, keep`` of the documents of ``docs`` that lose
    lines: the id, :func:`~tessera.llm.common.text_key` of the text, and
    ``keep``, an array of structs ``word, kept`` in order.  Bit b of ``kept`` is
    line ``32 * word + b``, and a 1 keeps it; words that are not there, and
    documents that are not, keep all lines.

    Documents are told apart by id: rows of one id are one document of several
    texts, a null id is a document too, the smallest.  Repeated rows count
    once.  Null and empty texts have one empty line, which stays; an empty
    table gives an empty table; other columns are left out, so they cannot
    clash."""
    lost = lost_lines(stage(long_lines(docs, text, doc_id, min_chars), "long_lines"), min_docs)
    # Dealt by document, a word's lines and a document's words need no further shuffle.
    words = (lost.repartition("doc", "of").groupBy("doc", "of", F.expr(f"pos div {WORD}").cast("int").alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.expr(f"pos % {WORD}"))).alias("gone")))
    return words.groupBy("doc", "of").agg(
        F.sum(F.bit_count("gone")).alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", F.col("gone").bitwiseXOR(F.lit(FULL)).alias("kept")))).alias("keep"))


def kept_lines(lines: Column, keep: Column) -> Column:
    """The elements of ``lines`` that the bitmap ``keep`` keeps."""
    wide = F.transform(keep, lambda w: F.transform(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.when(
        F.call_function("getbit", w["kept"], b) == 0, w["word"] * WORD + b)))
    lost = F.filter(F.flatten(wide), lambda p: p.isNotNull())
    # Lines between one lost line and the next, so that no line looks all losses up.
    ends = F.concat(lost, F.array(F.size(lines)))
    pieces = F.zip_with(F.concat(F.array(F.lit(-1)), lost), ends, lambda a, z: F.slice(lines, a + 2, z - a - 1))
    return F.flatten(pieces)


def drop_lines(docs: DataFrame, bitmaps: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with :func:`keep_bitmaps` applied: ``text`` of documents that
    lose lines is the kept ones joined by \\n, every other value is unchanged.

    The columns ``__n_lines`` (lines before), ``__n_dropped`` and ``__keep``
    (null: all kept) follow those of ``docs``."""
    bits = bitmaps.select(F.col("doc").alias("__doc"), F.col("of").alias("__of"), F.col("n_dropped").alias("__n_dropped"), F.col("keep").alias("__keep"))
    keyed = docs.withColumn("__text_key", text_key(F.col(text)))
    both = keyed.join(bits, (keyed["__text_key"] == bits["__of"]) & keyed[doc_id].eqNullSafe(bits["__doc"]), "left")
    lines = lines_of(F.col(text))
    left = F.when(F.col("__keep").isNull(), F.col(text)).otherwise(F.array_join(kept_lines(lines, F.col("__keep")), "\n"))
    return (both.withColumns({"__n_lines": F.size(lines).cast("long"), "__n_dropped": F.coalesce("__n_dropped", F.lit(0)).cast("long")})
            .withColumn(text, left).select(*docs.columns, "__n_lines", "__n_dropped", "__keep"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows ``doc_id, n_lines, n_dropped, kept_sha256, keep``, one per row of
    ``docs``; see :func:`keep_bitmaps` for odd rows.  ``kept_sha256`` is that of
    the kept lines joined by \\n."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    left = drop_lines(rows, keep_bitmaps(rows, min_chars=min_chars, min_docs=min_docs))
    return left.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), F.col("__keep").alias("keep"))
