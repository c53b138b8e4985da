"""BIO label validation and repair.

Input rows: ``(file, ord, token, label)`` with ``ord`` the 1-based position of
the token among the file's kept lines.  The rules depend only on the previous
label of the same file, so validation is one ``lag`` plus a projection that
emits 0..2 error structs per row -- no per-file Python loop.

Rules (R1 stops the others):

* R1 ``INVALID_LABEL_FORMAT``: not ``O`` and not ``B-``/``I-`` prefixed -> fix ``O``
* R2 ``ORPHAN_I_TAG``: ``I-t`` on the first line or after ``O`` -> fix ``B-t``
* R2 ``ENTITY_TYPE_MISMATCH``: ``I-t`` after ``B-u``/``I-u`` with u != t -> fix ``B-t``
  (after an *invalid* previous label nothing is flagged)
* R3 ``EMPTY_ENTITY_TYPE``: ``B-``/``I-`` without a type -> fix ``O``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import fixed_values as fv
from tessera.operators.ordered import previous_value

ERROR_STRUCT = "struct<rule:int,error_type:string,description:string,suggested_fix:string>"


# ---------------------------------------------------------------- J12
def is_begin(label: Column) -> Column:
    return label.startswith("B-")


def is_inside(label: Column) -> Column:
    return label.startswith("I-")


def entity_type(label: Column) -> Column:
    """``label[2:]`` for ``B-``/``I-`` labels, else null."""
    return F.when(is_begin(label) | is_inside(label), F.substring(label, 3, 1 << 30))


# ---------------------------------------------------------------- G1
def _err(rule: int, error_type: str, description: Column, fix: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"), F.lit(error_type).alias("error_type"),
        description.alias("description"), fix.alias("suggested_fix"),
    )


def line_errors(label: Column, prev: Column) -> Column:
    """Array of error structs of one line given the previous label (null on the first line)."""
    bi = is_begin(label) | is_inside(label)
    r1 = (label != "O") & ~bi
    t = F.substring(label, 3, 1 << 30)
    inside = ~r1 & is_inside(label)
    prev_bi = is_begin(prev) | is_inside(prev)
    begin_t = F.concat(F.lit("B-"), t)
    errs = F.array(
        F.when(r1, _err(1, fv.ERR_INVALID_FORMAT,
                        F.format_string("label '%s' does not follow the BIO scheme", label), F.lit("O"))),
        F.when(inside & prev.isNull(), _err(2, fv.ERR_ORPHAN_I,
               F.format_string("I-%s without a preceding B-%s (first line)", t, t), begin_t)),
        F.when(inside & (prev == "O"), _err(3, fv.ERR_ORPHAN_I,
               F.format_string("I-%s without a preceding B-%s (after O)", t, t), begin_t)),
        F.when(inside & prev_bi & (F.substring(prev, 3, 1 << 30) != t), _err(4, fv.ERR_TYPE_MISMATCH,
               F.format_string("I-%s after %s", t, prev), begin_t)),
        F.when(~r1 & bi & (t == ""), _err(5, fv.ERR_EMPTY_TYPE,
               F.format_string("label '%s' has no entity type", label), F.lit("O"))),
    )
    return F.array_compact(errs)


def with_previous_label(tokens: DataFrame, segment: Column | None = None) -> DataFrame:
    """Add ``prev`` = label of the previous line of the same file."""
    return previous_value(tokens, "file", ["ord"], "label", segment=segment, out="prev")


def validate_tokens(tokens: DataFrame, segment: Column | None = None) -> DataFrame:
    """G1: long error table
    ``(file, line_number, token, label, rule, error_type, description, suggested_fix)``.
    A ``prev`` column already present (from
    :func:`tessera.operators.ordered.positions_and_previous`) is used as is."""
    t = tokens if "prev" in tokens.columns else with_previous_label(tokens, segment)
    return (
        t.select("file", F.col("ord").alias("line_number"), "token", "label",
                 F.explode(line_errors(F.col("label"), F.col("prev"))).alias("e"))
        .select("file", "line_number", "token", "label", "e.*")
    )


# ---------------------------------------------------------------- K13
def repair_labels(tokens: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One pass on the original labels; when a line has several errors the
    last rule's fix wins.  Output ``(file, ord, token, label, fixed_label)``.

    With ``prev`` on the token rows the fix is taken from the line's own error
    array (its last element) -- no error table, no join; otherwise the error
    table is reduced per line and joined back."""
    if "prev" in tokens.columns:
        last = F.try_element_at(line_errors(F.col("label"), F.col("prev")), F.lit(-1))
        return tokens.withColumn("fixed_label", F.coalesce(last["suggested_fix"], F.col("label"))).drop("prev")
    fixes = errors.where(F.col("suggested_fix").isNotNull()).groupBy("file", "line_number").agg(
        F.max_by("suggested_fix", "rule").alias("fix"))
    return (
        tokens.join(fixes.withColumnRenamed("line_number", "ord"), ["file", "ord"], "left")
        .withColumn("fixed_label", F.coalesce("fix", "label"))
        .drop("fix")
    )


def settled_label(label: Column, prev: Column) -> Column:
    """Label of a line after repeated repair, from the labels as they are.

    A fix makes a line ``O`` (no BIO label, or no type) or turns ``I-t`` into
    ``B-t``; it never gives a line another type.  So an ``I-t`` stays if the
    line before has type ``t``, which no pass takes from it, and in every other
    case becomes ``B-t`` sooner or later: at once after another type, ``O`` or
    nothing, and after a label that is not BIO once that is ``O``."""
    typed = entity_type(label)
    return (F.when(label.isNull() | (label == "O"), label).when(typed.isNull() | (typed == ""), F.lit("O"))
            .when(is_inside(label) & ~F.coalesce(entity_type(prev) == typed, F.lit(False)), F.concat(F.lit("B-"), typed)).otherwise(label))


def repair_until_clean(tokens: DataFrame, segment: Column | None = None) -> DataFrame:
    """K13 option: the labels that repeated validate + repair ends in (a single
    pass can create a new orphan, e.g. ``X I-a`` -> ``O I-a``), in one pass over
    the lines and their previous labels; see :func:`settled_label`.  With
    ``segment`` a long file is dealt to several tasks.  A ``prev`` column
    already present is used as is."""
    t = tokens if "prev" in tokens.columns else with_previous_label(tokens, segment)
    return t.select("file", "ord", "token", settled_label(F.col("label"), F.col("prev")).alias("label"))


# ---------------------------------------------------------------- D17-D20
def entity_counts(tokens: DataFrame) -> DataFrame:
    """``B-`` labels per (file, entity type)."""
    return tokens.where(is_begin(F.col("label"))).groupBy(
        "file", entity_type(F.col("label")).alias("entity_type")).agg(F.count("*").alias("count"))


def error_statistics(errors: DataFrame) -> DataFrame:
    """Errors per type, most frequent first."""
    return errors.groupBy("error_type").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "error_type")


def file_verdicts(tokens: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Per file ``total_lines, total_errors, is_valid`` and the entity counts map.

    When the token rows carry ``prev`` (the previous label), the errors of a
    line are counted in the row and summed in the same aggregation as the
    line counts -- one shuffle less than aggregating the error table."""
    if "prev" in tokens.columns:
        lines = tokens.groupBy("file").agg(
            F.count("*").alias("total_lines"),
            F.count_if(is_begin(F.col("label"))).alias("total_entities"),
            F.sum(F.size(line_errors(F.col("label"), F.col("prev")))).alias("total_errors"),
        )
        errs = None
    else:
        lines = tokens.groupBy("file").agg(
            F.count("*").alias("total_lines"),
            F.count_if(is_begin(F.col("label"))).alias("total_entities"),
        )
        errs = errors.groupBy("file").agg(F.count("*").alias("total_errors"))
    ents = entity_counts(tokens).groupBy("file").agg(
        F.map_from_entries(F.collect_list(F.struct("entity_type", "count"))).alias("entity_counts"))
    joined = lines if errs is None else lines.join(errs, "file", "left")
    return (
        joined.join(ents, "file", "left")
        .select(
            "file", "total_lines", F.coalesce("total_errors", F.lit(0)).alias("total_errors"),
            (F.coalesce("total_errors", F.lit(0)) == 0).alias("is_valid"),
            "total_entities",
            F.coalesce("entity_counts", F.create_map().cast("map<string,bigint>")).alias("entity_counts"),
        )
    )


def validation_summary(verdicts: DataFrame) -> DataFrame:
    """Files, errors, files with errors."""
    return verdicts.agg(
        F.count("*").alias("total_files"),
        F.coalesce(F.sum("total_errors"), F.lit(0)).alias("total_errors"),
        F.count_if(~F.col("is_valid")).alias("files_with_errors"),
    )


# ---------------------------------------------------------------- G4
def top_errors_per_file(errors: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` errors of each file (by line, then rule) and how many
    more there are.  The rank filter alone over the window lets Spark insert a
    per-partition group limit before the shuffle; the per-file totals come
    from a partially aggregated ``groupBy``, so a file with huge error counts
    never moves more than ``k`` rows per map task."""
    w = Window.partitionBy("file").orderBy("line_number", "rule")
    top = errors.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    totals = errors.groupBy("file").agg(F.count("*").alias("file_errors"))
    return top.join(totals, "file").withColumn(
        "more", F.greatest(F.col("file_errors") - F.lit(k), F.lit(0)))
