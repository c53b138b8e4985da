"""Token (BIO) file sources: admission, decoding, line parsing.

Files are read with the ``binaryFile`` source: one row per file, so a file's
line order is kept without any global ordering, and the content column is
only materialised when it is selected (a listing selects ``path``/``length``
only and the content is pruned).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import fixed_values as fv
from tessera.functions import text as tx
from tessera.operators.ordered import positions

LINE_BREAK = r"\r\n|\r|\n"
TASKS_PER_CORE = 4


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def folder_names(folders: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The names of the files in and below the folders of the first column, as
    they are met.  Like Spark, it passes over what ``_`` or ``.`` begins."""
    def files(folder: str) -> Iterator[str]:
        below = []
        with os.scandir(folder) as entries:
            for e in entries:
                if e.name.startswith(".") or e.name.startswith("_") and "=" not in e.name or e.name.endswith("._COPYING_"):
                    continue
                if e.is_dir():
                    below.append(e.path)
                else:
                    yield e.name
        for f in below:
            yield from files(f)

    for batch in folders:
        for folder in batch.column(0).to_pylist():
            found = files(folder)
            while some := list(islice(found, 10000)):
                yield pa.record_batch([pa.array(some, pa.string())], names=["name"])


def list_files(spark: SparkSession, directory: str, suffix: str | None = None) -> DataFrame:
    """Visible regular file names of a directory, optionally by suffix.
    Hidden names (``.``, ``._``) and common system files are skipped.

    A folder that all tasks see is listed by a task, which hands the names on as
    it meets them.  For other stores they come from the source's own file index
    (which Spark holds on the driver for any file source).  Either way no file
    is opened and zero-length files, for which Spark plans no input split, are
    listed too."""
    folder = directory.removeprefix("file://") if directory.startswith("file:///") else directory.removeprefix("file:")
    if os.path.isdir(folder) and not set("*?[]{}\\").intersection(folder + (suffix or "")):
        files = spark.createDataFrame([(folder,)], "folder string").mapInArrow(folder_names, "name string")
        files = files.where(F.endswith("name", F.lit(suffix or "")))
    else:
        reader = spark.read.format("binaryFile")
        if suffix:
            reader = reader.option("pathGlobFilter", f"*{suffix}")
        paths = spark.createDataFrame([(p,) for p in reader.load(directory).inputFiles()], "path string")
        files = paths.select(F.url_decode(F.replace(file_name(F.col("path")), F.lit("+"), F.lit("%2B"))).alias("name"))
    name = F.col("name")
    return files.where(
        ~name.startswith(".") & ~name.isin(fv.SYSTEM_FILE_NAMES)
    ).distinct()


def admitted(name: Column, length: Column, head: Column, suffix: str = fv.TOKEN_FILE_SUFFIX) -> Column:
    """A10: not hidden/AppleDouble/``PMC``-prefixed, right suffix, non-empty, and
    no AppleDouble marker in the first 50 bytes."""
    return (
        ~name.startswith("._") & ~name.startswith(".") & ~name.startswith("PMC")
        & name.endswith(suffix) & (length > 0)
        & ~F.contains(head, F.lit(fv.APPLEDOUBLE_TEXT_MARK))
        & ~F.contains(head, F.lit(fv.APPLEDOUBLE_MAGIC))
    )


def decode_text(content: Column) -> Column:
    """UTF-8 when the bytes are valid UTF-8, else Latin-1 (which never fails,
    so later fallbacks are unreachable)."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def _token_of(parts: Column, layout: str) -> tuple[Column, Column, Column]:
    """(kept, token, label) of a line's columns, see :func:`parse_token_lines`."""
    n = F.size(parts)
    if layout == "full":
        return n >= 4, F.get(parts, 3), F.get(parts, 0)
    if layout == "auto":
        return n >= 2, F.when(n >= 4, F.get(parts, 3)).otherwise(F.get(parts, 0)), F.when(n >= 4, F.get(parts, 0)).otherwise(F.get(parts, 1))
    raise ValueError(f"unknown layout {layout!r}")


def token_array(text: Column, layout: str = "auto") -> Column:
    """A5/A6 + G2 of a whole file's text: its kept lines in order as
    ``array<struct<ord, token, label, line_no, prev>>``, numbered and with the
    label before each, all inside the row."""
    numbered = F.transform(F.split(text, LINE_BREAK), lambda x, i: F.struct(tx.strip_ws(x).alias("s"), i.alias("line_no")))
    split = F.transform(F.filter(numbered, lambda x: x["s"].contains("\t")),
                        lambda x: F.struct(F.split(x["s"], "\t").alias("p"), x["line_no"].alias("line_no")))
    kept = F.transform(F.filter(split, lambda x: _token_of(x["p"], layout)[0]), lambda x: F.struct(
        _token_of(x["p"], layout)[1].alias("token"), _token_of(x["p"], layout)[2].alias("label"), x["line_no"].alias("line_no")))
    return tx.let(kept, lambda k: F.transform(k, lambda x, i: F.struct(
        (i + 1).alias("ord"), x["token"].alias("token"), x["label"].alias("label"), x["line_no"].alias("line_no"),
        F.get(k, i - 1)["label"].alias("prev"))))


def read_token_arrays(spark: SparkSession, directory: str, layout: str = "auto", suffix: str = fv.TOKEN_FILE_SUFFIX) -> DataFrame:
    """A7 + A10: ``(file, tokens)``, one row per admitted file (a file arrives
    as one row, so its lines never leave it).

    Spark counts a file as 4 MB at least, so a folder of small files would be a
    task per 32 of them, and again in whatever is done with them.  They are read
    by a few tasks per core, or as many as a shuffle has, one file after the other."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(directory)
    raw = raw.coalesce(max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    name = file_name(F.col("path"))
    ok = raw.where(admitted(name, F.col("length"), F.substring(F.col("content"), 1, 50), suffix))
    return ok.select(name.alias("file"), token_array(decode_text(F.col("content")), layout).alias("tokens"))


def read_token_files(spark: SparkSession, directory: str, layout: str = "auto", suffix: str = fv.TOKEN_FILE_SUFFIX) -> DataFrame:
    """A5/A6 + A7 + A10: ``(file, ord, token, label, line_no, prev)`` for every
    line of every admitted file, without a shuffle."""
    return read_token_arrays(spark, directory, layout, suffix).select("file", F.explode("tokens").alias("t")).select("file", "t.*")


def parse_token_lines(lines: DataFrame, layout: str = "auto", segment_size: int | None = None) -> DataFrame:
    """Parse ``(file, line_no, line)`` rows.

    Lines are stripped, blank lines dropped, and only lines with a tab kept.
    ``full`` layout (A5): at least 4 columns, label = col 0, token = col 3.
    ``auto`` layout (A6): as ``full`` for >= 4 columns; 2-3 columns mean
    token = col 0, label = col 1.  ``ord`` (G2) is the 1-based position among
    the kept lines of the file, not the raw line number.  With
    ``segment_size`` the numbering runs per ``line_no // segment_size`` block
    and is stitched (see :mod:`tessera.operators.ordered`), so one huge file
    is not a single task.
    """
    s = tx.strip_ws(F.col("line"))
    parsed = lines.select("file", "line_no", F.split(s, "\t").alias("parts"), s.alias("s")).where(
        (F.col("s") != "") & F.col("s").contains("\t"))
    kept, token, label = _token_of(F.col("parts"), layout)
    parsed = parsed.where(kept).select("file", "line_no", token.alias("token"), label.alias("label"))
    segment = F.floor(F.col("line_no") / segment_size) if segment_size else None
    return positions(parsed, "file", ["line_no"], segment=segment).select("file", "ord", "token", "label", "line_no")


def render_token_lines(tokens: DataFrame) -> DataFrame:
    """L5 helper: ``token<TAB>label`` lines in file order."""
    return tokens.select("file", "ord", F.concat_ws("\t", "token", "label").alias("line"))
