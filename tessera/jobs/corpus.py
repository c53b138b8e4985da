"""Batch jobs composed from the operators (3.1-3.4 of the blueprint).

Each job reads landed files, runs one Spark plan per output and writes
folders of part files.  Actions inside a job are limited to the writes and
to small bounded checks (emptiness, a label vocabulary).  Intermediate
results reused by several outputs are cut with ``checkpoint()`` in the
shared checkpoint folder, so a lost executor recomputes from the
checkpoint rather than from the raw input.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import bio, chunking, compare, profile, quality, requests, splits, textprep, thesaurus, translate
from tessera.session import reusable
from tessera.sinks import writers
from tessera.sources import articles as art
from tessera.sources import thesaurus as ts
from tessera.sources import tokens as tk

CATEGORY_CSV_SCHEMA = (
    "pmid string, title string, year int, spanish_abstract string, level1_codes string, level1_names string, "
    "level2_codes string, level2_names string, major_subjects_count int, level1_categories_str string, "
    "level2_categories_str string"
)


# ---------------------------------------------------------------- 3.1 corpus collection
def one_per_id(records: DataFrame, id_col: str, text: Column) -> DataFrame:
    """One record per id: that of the longest ``text``, of those the last one by
    its JSON.  Records without an id are no copies of each other; all stay."""
    named = F.coalesce(F.col(id_col), F.lit("")) != ""
    whole = F.struct(*records.columns)
    best = records.where(named).groupBy(id_col).agg(F.max_by(whole, F.struct(F.coalesce(F.length(text), F.lit(0)), F.to_json(whole))).alias("best"))
    return best.select("best.*").unionByName(records.where(~named))


def collect_corpus(spark: SparkSession, xml_path: str, out_dir: str, metadata: dict | None = None) -> dict:
    """A2 -> B1-B9 -> C4 -> L1: one article per pmid, written by year, with the
    D7 statistics, the metadata record and the D8 stage counters."""
    good, bad = art.gate_records(reusable(art.parse_records(art.read_xml_records(spark, xml_path))))
    extracted = art.extract_articles(good).withColumn("year", art.publication_year(F.col("publication_info")))
    extracted = reusable(one_per_id(extracted, "pmid", F.col("abstract.full_text")))
    kept = quality.quality_filter(extracted)
    counters = quality.stage_counters(extracted, quality.quality_rules()).first().asDict()
    counters["malformed"] = bad.count()
    stats = profile.corpus_statistics(kept, year="year", stage_counts=counters)
    info = {"collection_method": "records files", "filters_applied": art.QUALITY_FILTERS, "search_strategies": [], **(metadata or {})}
    about = spark.createDataFrame([(info["collection_method"], int(counters["final"]), list(info["filters_applied"]), list(info["search_strategies"]))],
                                  "collection_method string, total_articles long, filters_applied array<string>, search_strategies array<string>")
    about = about.withColumn("creation_date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    writers.write_article_dataset(kept, out_dir, metadata=about, statistics=stats, year="year" if counters["final"] else None)
    return counters


# ---------------------------------------------------------------- 3.2 thesaurus labelling
def label_dataset(spark: SparkSession, articles_path: str, thesaurus_xml: str, thesaurus_dir: str,
                  out_csv: str, articles_format: str = "document") -> DataFrame:
    """A12 -> A1 -> F7 -> L3; returns the D11/D12 coverage row."""
    _, dtree, names = ts.load_or_build_thesaurus(spark, thesaurus_xml, thesaurus_dir)
    arts = art.require_articles(art.read_articles(spark, articles_path, articles_format), articles_path)
    labelled = thesaurus.label_articles(
        arts.withColumn("publication_info", F.struct(
            art.publication_year(F.col("publication_info")).alias("year"))), dtree, names)
    labelled = reusable(labelled)
    writers.write_category_csv(labelled, out_csv)
    return profile.coverage_stats(labelled)


# ---------------------------------------------------------------- 3.3 splits
def create_split(spark: SparkSession, csv_path: str, out_dir: str, min_length: int = 2,
                 extra_cleaning: bool = False, remove_stopwords: bool = True, mode: str = "basic",
                 lemma_table: DataFrame | None = None, stem_fn: Callable[[str], str] | None = None) -> DataFrame:
    """K7: C12 -> K3 in one of its modes -> K4 + K5 (same membership) -> L7, and
    L8: preprocessing info, label counts (D16), single labels (D15) and text
    profiles (D14); returns K8 sizes."""
    columns = ["title", "spanish_abstract"]
    df = writers.read_category_csv(spark, csv_path, CATEGORY_CSV_SCHEMA).where(quality.has_categories())
    df = textprep.preprocess_columns(df, columns, remove_stopwords=remove_stopwords, min_length=min_length,
                                     extra_cleaning=extra_cleaning, mode=mode, lemma_table=lemma_table, stem_fn=stem_fn)
    df = reusable(splits.assign_splits(df, "pmid"))
    single = splits.single_label(df)
    writers.write_splits(single, os.path.join(out_dir, "traditional"))
    writers.write_splits(splits.multilabel_matrix(df, splits.label_classes(df)), os.path.join(out_dir, "multilabel"))
    info = spark.createDataFrame(
        [(mode, remove_stopwords, min_length, extra_cleaning, [f"{c}_processed" for c in columns], columns)],
        "text_processing_type string, remove_stopwords boolean, min_length int, extra_cleaning boolean, "
        "processed_columns array<string>, original_columns array<string>")
    for name, table in (("preprocessing_info", info), ("multilabel_info", splits.label_counts(df)),
                        ("traditional_info", profile.group_counts(single, "single_category", "category").orderBy(F.desc("count"), "category")),
                        ("text_profile", textprep.processing_profile(df, columns))):
        writers.write_info(table, os.path.join(out_dir, name))
    return splits.split_sizes(df)


# ---------------------------------------------------------------- translation
def article_queue(articles: DataFrame, done_abstracts: DataFrame | None = None, titles_only: bool = False,
                  translate_titles: bool = True, done_titles: DataFrame | None = None) -> DataFrame:
    """C9 + C10 + I6: the work items of ``articles``."""
    if titles_only and not translate_titles:  # C15
        raise ValueError("titles only and no titles exclude each other")
    return translate.translation_queue(
        articles, "pmid", abstract=F.col("abstract.full_text"), language=F.col("abstract_language"),
        has_content=F.col("abstract.has_content"), title=F.col("title"),
        abstract_ok=F.col("abstract.spanish_translation.success"),
        title_ok=F.col("title_spanish_translation.success"),
        done_abstracts=done_abstracts, done_titles=done_titles, titles_only=titles_only, translate_titles=translate_titles)


def with_translations(articles: DataFrame, results: DataFrame) -> DataFrame:
    """E5: ``articles`` with the translation records of ``results`` in place."""
    abstract_of = F.when(F.col("kind") == "abstract", F.col("translation").withField(
        "translation_date", F.col("translation.translation_date").cast("string")))
    title_of = F.when(F.col("kind") == "title", F.struct(
        F.col("original_title"), F.col("source_text").alias("cleaned_title"),
        F.col("translation.text").alias("translated_title"), F.col("translation.success"),
        F.col("translation.model_used"), F.col("translation.batch_size_used"),
        F.col("translation.translation_date").cast("string").alias("translation_date"), F.col("translation.error")))
    found = results.groupBy("pmid").agg(F.first(abstract_of, ignorenulls=True).alias("_abs_tr"), F.first(title_of, ignorenulls=True).alias("_tit_tr"))
    return (articles.join(found, "pmid", "left")
            .withColumn("abstract", F.col("abstract").withField(
                "spanish_translation", F.coalesce("_abs_tr", "abstract.spanish_translation")))
            .withColumn("title_spanish_translation", F.coalesce("_tit_tr", "title_spanish_translation"))
            .drop("_abs_tr", "_tit_tr"))


def translate_dataset(spark: SparkSession, articles: DataFrame, factory: Callable, model: str, **options) -> tuple[DataFrame, DataFrame]:
    """C9/C10 queue -> K11/K10 -> E5 write-back by id -> D13 summary; the
    options are those of :func:`article_queue`.  Returns
    ``(articles_with_translations, summary)``."""
    queue = article_queue(articles, **options)
    results = reusable(translate.translation_struct(translate.translate_items(queue, "pmid", factory), model))
    return with_translations(articles, results), translate.translation_summary(results)


def read_if_there(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A table that may not have been written yet (then without rows)."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def translate_in_parts(spark: SparkSession, articles: DataFrame, factory: Callable, model: str, work_dir: str, n_parts: int = 16,
                       **options) -> tuple[DataFrame, DataFrame]:
    """K12 that can be taken up again (E8, L10): as :func:`translate_dataset`,
    with the queue written once, dealt to ``n_parts`` parts by id, and translated
    part by part.

    A part's results are one folder, replaced if it is written again, and its
    record in the log is the commit: a file of the part's own, written after
    the results.  A run that finds records skips their parts, so what a
    failed run had finished is not translated again, and nothing is there
    twice.  The queue is that of the first run; later articles go into another
    ``work_dir``, with what is done here as ``done_abstracts``/``done_titles``."""
    at = {name: os.path.join(work_dir, name) for name in ("queue", "parts", "results", "log")}
    about = read_if_there(spark, at["parts"], "n_parts int", "json").first()
    if about is None:
        queue = article_queue(articles, **options)
        queue.withColumn("part", F.pmod(F.xxhash64("pmid"), F.lit(n_parts)).cast("int")).repartition("part", F.xxhash64("pmid") % 64).write.mode(
            "overwrite").partitionBy("part").parquet(at["queue"])
        spark.createDataFrame([(n_parts,)], "n_parts int").coalesce(1).write.mode("overwrite").json(at["parts"])  # the queue is whole now
    else:
        n_parts = about["n_parts"]
    committed = {r["part"] for r in read_if_there(spark, at["log"], "part int", "json").collect()}  # n_parts records at most
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in article_queue(articles, **options).schema.fields)
    whole = read_if_there(spark, at["queue"], f"{fields}, part int")

    def translated(part: int) -> DataFrame:
        items = whole.where(F.col("part") == part).drop("part")
        return translate.translation_struct(translate.translate_items(items, "pmid", factory), model)

    schema = translated(0).schema
    folder = {part: os.path.join(at["results"], f"part={part}") for part in range(n_parts)}
    for part in sorted(set(folder).difference(committed)):
        translated(part).write.mode("overwrite").parquet(folder[part])
        record = spark.read.schema(schema).parquet(folder[part]).agg(
            F.lit(part).alias("part"), F.lit(model).alias("model_used"), F.count(F.lit(1)).alias("items"), F.count_if(~F.col("success")).alias("failed"))
        writers.write_records(record, at["log"], F.format_string("part_%05d.json", F.col("part").cast("long")))
    results = spark.read.schema(schema).parquet(*folder.values())
    return with_translations(articles, results), translate.translation_summary(results)


def translate_corpus(spark: SparkSession, articles: DataFrame, factory: Callable, model: str, out_dir: str, **options) -> dict:
    """:func:`translate_dataset` written to ``out_dir`` with its
    translation info (counts per kind, minutes, items per minute).  With
    nothing to translate nothing is written and ``items`` is 0."""
    start = time.monotonic()
    out, summary = translate_dataset(spark, articles, factory, model, **options)
    kinds = {r["kind"]: r for r in summary.collect()}  # two kinds at most
    items = sum(r["total"] for r in kinds.values())
    info = {"model_used": model, "titles_only_mode": bool(options.get("titles_only")), "items": items}
    if items:
        minutes = (time.monotonic() - start) / 60
        counts = spark.createDataFrame(
            [(k, r["successful"], r["failed"], r["total"]) for k, r in kinds.items()], "kind string, successful long, failed long, total long")
        record = counts.agg(F.collect_list(F.struct("kind", "successful", "failed", "total")).alias("translation_stats")).select(
            *[F.lit(v).alias(k) for k, v in info.items()], "translation_stats", F.lit(minutes).alias("total_time_minutes"),
            F.lit(items / max(minutes, 1e-9)).alias("items_per_minute"))
        writers.write_article_dataset(out, out_dir)
        writers.write_info(record, os.path.join(out_dir, "translation_info"))
    return info


# ---------------------------------------------------------------- 3.4 token files
def report_directory(toks: DataFrame, report_dir: str) -> DataFrame:
    """G1 -> D17-D20 -> L6 of token rows with ``prev``; returns the verdicts per
    file.  Each of the report's outputs reads errors and verdicts made once."""
    errs = reusable(bio.validate_tokens(toks))
    verdicts = reusable(bio.file_verdicts(toks, errs))
    writers.write_validation_report(verdicts, errs, report_dir)
    return verdicts


def validate_directory(spark: SparkSession, token_dir: str, report_dir: str, fix_dir: str | None = None) -> DataFrame:
    """A6 -> G1 -> D17-D20 -> L6; with ``fix_dir``, K13 repairs are
    written as new files and validated again.  Returns the D20 summary."""
    toks = reusable(tk.read_token_files(spark, token_dir, layout="auto"))
    verdicts = report_directory(toks, report_dir)
    if fix_dir is not None:
        fixed = bio.repair_labels(toks)
        writers.write_token_files(fixed, fix_dir, label_col="fixed_label")
        re_toks = fixed.select("file", "ord", "token", F.col("fixed_label").alias("label"))
        report_directory(reusable(bio.with_previous_label(re_toks)), os.path.join(report_dir, "after_fix"))
    return bio.validation_summary(verdicts)


def read_token_documents(spark: SparkSession, token_dir: str) -> DataFrame:
    """Admitted token files as one row per file with the ordered token array."""
    return tk.read_token_arrays(spark, token_dir, layout="full").select("file", F.transform(
        "tokens", lambda t: F.struct(t["token"].alias("token"), t["label"].alias("label"))).alias("tokens"))


def make_requests(spark: SparkSession, token_dir: str, out_dir: str, model: str, max_lines: int,
                  batch_size: int = 100, temperature: float = 0.1, max_tokens: int = 4000) -> DataFrame:
    """K16, first half: A10 -> A5 -> K9 -> G6 -> L4; returns D21 batch info."""
    docs = read_token_documents(spark, token_dir)
    chunks = chunking.split_documents(docs, "file", "tokens", max_lines)
    reqs = chunking.build_requests(chunks, model, temperature, max_tokens)
    batched = reusable(chunking.assign_batches(reqs, ["source_file", "chunk_index"], batch_size))
    writers.write_request_files(batched, os.path.join(out_dir, "requests"))
    info = chunking.batch_info(batched)
    writers.write_records(info, os.path.join(out_dir, "batch_info"), F.format_string("batch_info_%05d.json", F.col("batch_no").cast("long")))
    return info


def ingest_results(spark: SparkSession, results_path: str, requests_dir: str, out_dir: str) -> DataFrame:
    """K16, second half: A9 -> C14 -> J13 -> D23 -> L5, plus the E9 retry set
    (next request file).  Returns per-file chunk coverage."""
    res = requests.read_results(spark, results_path)
    ok, failed = requests.split_results(res)
    reqs = spark.read.schema("value string").text(requests_dir).select(
        F.from_json("value", "custom_id string").alias("r"), "value").select("r.custom_id", "value")
    totals = reqs.groupBy(chunking.custom_id_file(F.col("custom_id")).alias("source_file")).agg(F.count_distinct("custom_id").alias("total_chunks"))
    covered = reusable(requests.reassemble(requests.translated_chunks(ok), totals))
    docs = covered.where(F.col("tokens").isNotNull())
    tokens = docs.select(F.col("source_file").alias("file"),
                         F.posexplode("tokens").alias("pos", "t")).select(
        "file", (F.col("pos") + 1).alias("ord"), F.col("t.token").alias("token"), F.col("t.label").alias("label"))
    writers.write_token_files(tokens, os.path.join(out_dir, "translated"))
    retry = requests.retry_set(reqs, ok)
    retry.select("value").write.mode("overwrite").text(os.path.join(out_dir, "retry_requests"))
    failed.select("custom_id", F.col("response.status_code").alias("status_code")).write.mode("overwrite").json(
        os.path.join(out_dir, "failed"))
    writers.write_info(covered.agg(F.sum("total_chunks").alias("chunks"), F.sum(F.size("missing")).alias("missing_chunks"),
                                   F.count_if(F.size("missing") > 0).alias("incomplete_files")), os.path.join(out_dir, "retry_info"))
    return docs.select("source_file", F.size("chunk_indexes").alias("chunks"), F.size("tokens").alias("tokens"), "missing")


def compare_datasets(spark: SparkSession, dir_a: str, dir_b: str, out_dir: str, suffix: str | None = None) -> DataFrame:
    """D22 + E10 + L9: completeness row; missing names written per side."""
    m = reusable(compare.membership(tk.list_files(spark, dir_a, suffix), tk.list_files(spark, dir_b, suffix)))
    writers.write_names(compare.missing(m, "only_a"), os.path.join(out_dir, "missing_in_b"))
    writers.write_names(compare.missing(m, "only_b"), os.path.join(out_dir, "missing_in_a"))
    return compare.completeness(m)


__all__ = [
    "collect_corpus", "label_dataset", "create_split", "translate_corpus", "translate_dataset", "translate_in_parts", "validate_directory",
    "make_requests", "ingest_results", "compare_datasets",
]
