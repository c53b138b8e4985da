"""Corpus pipeline: STAGES applied to `documents` one after the other.

Every stage takes all that the one before kept, as Parquet read again, and
returns the columns of `documents`; the last one returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import line_quality, mixing, packing, secret_links, simhash_blocks
from tessera.llm.common import stage, table


def with_lengths(docs, changed):
    """``changed`` with ``n_chars`` counted anew and the columns of ``docs``."""
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def quality_rules(spark, docs, sf_dir):
    """Cuts out lines that too many documents of their host share, and drops
    documents that fail the base rules or are depleted by that.

    Null and empty texts fail the base rules and go; a null host is a host;
    repeated rows share one fate; of an empty table nothing is left; columns
    other than text and n_chars stay as they are, whatever their names."""
    return with_lengths(docs, line_quality.reject_documents(docs, **line_quality.NOTICES))


def near_duplicates(spark, docs, sf_dir):
    """Keeps the document of smallest id of every SimHash component.

    Texts without a word (null, empty) are alike; of rows with the same id and
    text one stays; a component without any id keeps a row for each
    fingerprint; an empty table stays empty; no column is changed."""
    return simhash_blocks.keep_one(docs, shingle=3, distance=3)


def secret_scan(spark, docs, sf_dir):
    """Replaces every reported secret by a mark; no document is dropped.

    Null texts stay null, empty ones empty; repeated rows are changed alike; an
    empty table stays empty; columns other than text and n_chars are kept."""
    return with_lengths(docs, secret_links.redact(docs))


def source_mixing(spark, docs, sf_dir):
    """Keeps the documents sampled by the raked weights of their cells.

    Texts without a word cost nothing and stay; null sources and languages are
    values; rows of equal id and text are drawn alike; an empty table stays
    empty.  The operator works on columns under names of its own, so that it
    replaces none of the input's."""
    own = {c: f"__in{i}" for i, c in enumerate(docs.columns)}
    drawn = mixing.sample_documents(docs.withColumnsRenamed(own), text=own["text"], doc_id=own["doc_id"], source=own["source"], lang=own["lang"], rate=mixing.RATE)
    return drawn.filter("sampled").select(*(F.col(name).alias(c) for c, name in own.items()))


def sequence_packing(spark, docs, sf_dir):
    """Token pieces of every document with their ids and their places in the
    sequences, which packing.assemble puts together.

    Null and empty texts are one piece with the closing id; long ones are cut;
    repeated rows and null ids are packed each by itself; of an empty table
    there are no pieces; other columns of the documents are left out."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: Hash sampling and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
