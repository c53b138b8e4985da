"""Driver queries Q01-Q61: each is ``(spark, sf_dir) -> DataFrame`` over the
driver's parquet tables, composed from the library operators through the
stand-in mappings of :mod:`tessera.plans.mappings`.

Arrays whose order is free are rendered as delimited strings so that results
compare by value against the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import thesaurus as th
from tessera.plans import mappings as mp
from tessera.session import reusable
from tessera.sources.tables import Tables


def _codes_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "level1_codes": F.array_join("level1_codes", ","),
        "level1_names": F.array_join("level1_names", "; "),
        "level2_codes": F.array_join("level2_codes", ","),
        "level2_names": F.array_join("level2_names", "; "),
    })


def label_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 over the order stand-ins, arrays kept."""
    t = Tables(spark, sf_dir)
    nation = t.nation
    dtree = mp.nation_descriptor_tree(nation)
    names = th.tree_names(mp.nation_descriptor(nation), dtree)
    return th.label_from_terms(
        mp.order_articles(t.orders), mp.order_terms(t.lineitem, t.supplier), dtree, names, "pmid"
    )


def category_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled articles per distinct (category string, has a translation),
    with their number ``n``: what all label statistics need, written once."""
    labelled = label_orders(spark, sf_dir)
    translated = F.when(F.length("spanish_abstract") > 0, F.lit("x")).otherwise(F.lit(""))
    return reusable(labelled.groupBy("level1_categories_str", translated.alias("spanish_abstract")).agg(F.count("*").alias("n")))


def q05_label_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes_as_text(label_orders(spark, sf_dir))


QUERIES = {
    "q05_label_articles": q05_label_articles,
}


# ---------------------------------------------------------------- Q01-Q04
from tessera import fixed_values as fv  # noqa: E402
from tessera.functions import text as tx  # noqa: E402
from tessera.operators import profile as pf  # noqa: E402
from tessera.operators import quality as ql  # noqa: E402

# Indicator lists for the test documents (the medical indicator words occur in
# none of them, so the vote is exercised with common function words).
ES_WORDS = ["de", "que", "los", "las", "para"]
EN_WORDS = ["the", "of", "and", "that", "with"]


def documents_as_abstracts(documents: DataFrame) -> DataFrame:
    """Document -> abstract stand-in: text, has_content, word_count."""
    return documents.select(
        "doc_id", "text",
        tx.has_content("text").alias("has_content"),
        tx.word_count("text").alias("word_count"),
    )


def q01_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents_as_abstracts(Tables(spark, sf_dir).dealt("documents", "doc_id", "text"))
    kept = ql.quality_filter(docs, has_content="has_content", word_count="word_count", terms=None)
    return kept.select("doc_id", F.col("word_count").cast("long").alias("word_count"))


def q02_language_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).dealt("documents", "doc_id", "text")
    return docs.select("doc_id", tx.detect_language("text", ES_WORDS, EN_WORDS).alias("abstract_language"))


def q03_corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    prof = pf.corpus_profile(
        o, year=F.year("o_orderdate"), word_count="o_totalprice", structured=F.col("o_orderstatus") == "F"
    )
    return prof.withColumns({
        "year_earliest": F.col("year_earliest").cast("int"),
        "year_latest": F.col("year_latest").cast("int"),
        "avg_abstract_length": F.round("avg_abstract_length", 2),
    })


def q04_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    langs = pf.language_distribution(t.documents, "lang").select(
        F.lit("language").alias("stat"), F.col("language").alias("key"), F.col("count").alias("n"))
    years = pf.top_k(pf.year_counts(t.orders, F.year("o_orderdate")), 10, "count", "year").select(
        F.lit("year").alias("stat"), F.col("year").cast("string").alias("key"), F.col("count").alias("n"))
    journals = pf.top_k(pf.journal_counts(t.orders, "o_orderpriority"), 20, "count", "journal").select(
        F.lit("journal").alias("stat"), F.col("journal").alias("key"), F.col("count").alias("n"))
    return langs.unionByName(years).unionByName(journals)


def q06_coverage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = category_groups(spark, sf_dir)
    cov = pf.coverage_stats(labelled, weight="n").select(F.expr(
        "stack(7, 'total_articles', cast(total_articles as double), "
        "'articles_with_categories', cast(articles_with_categories as double), "
        "'articles_with_translation', cast(articles_with_translation as double), "
        "'coverage_percentage', coverage_percentage, "
        "'translation_percentage', translation_percentage, "
        "'articles_without_categories', cast(articles_without_categories as double), "
        "'without_categories_percentage', without_categories_percentage) as (metric, value)"
    )).select("metric", F.lit(None).cast("string").alias("key"), "value")
    freq = pf.category_frequencies(labelled, weight="n")
    unique = freq.agg(F.count("*").cast("double").alias("value")).select(
        F.lit("unique_level1_categories").alias("metric"), F.lit(None).cast("string").alias("key"), "value")
    top = pf.top_k(freq, 10, "count", "category").select(
        F.lit("top_category").alias("metric"), F.col("category").alias("key"), F.col("count").cast("double").alias("value"))
    return cov.unionByName(unique).unionByName(top)


def q09_stage_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 over three id 'strategies' (union all, then distinct), then the
    quality rules with the first-failed-rule attribution."""
    t = Tables(spark, sf_dir)
    docs, labels = t.documents, t.labels
    s1 = docs.where(F.col("lang") == "en").select("doc_id")
    s2 = labels.select("doc_id")
    s3 = docs.where(F.col("n_chars") > 5000).select("doc_id")
    searched = s1.unionAll(s2).unionAll(s3)
    found = searched.distinct()
    abstracts = documents_as_abstracts(docs).select("doc_id", "has_content", "word_count")
    has_terms = labels.groupBy("doc_id").agg(F.lit(True).alias("has_terms"))
    rows = found.join(abstracts, "doc_id", "left").join(has_terms, "doc_id", "left")
    rules = [
        ("no_abstract", F.coalesce(F.col("has_content"), F.lit(False))),
        ("no_terms", F.coalesce(F.col("has_terms"), F.lit(False))),
        ("too_short", F.coalesce(F.col("word_count") >= fv.MIN_ABSTRACT_WORDS, F.lit(False))),
    ]
    counts = ql.stage_counters(rows, rules)
    searched_n = searched.agg(F.count("*").alias("searched"))
    return searched_n.unionByName(counts, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ["searched", "total", "dropped_no_abstract", "dropped_no_terms",
                                      "dropped_too_short", "final"]]
    ).withColumnRenamed("total", "found")


QUERIES.update({
    "q01_quality_filter": q01_quality_filter,
    "q02_language_detect": q02_language_detect,
    "q03_corpus_profile": q03_corpus_profile,
    "q04_top_groups": q04_top_groups,
    "q06_coverage_stats": q06_coverage_stats,
    "q09_stage_counters": q09_stage_counters,
})


# ---------------------------------------------------------------- Q07, Q08, Q27
from tessera.operators import collection as co  # noqa: E402


def q07_prefix_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = Tables(spark, sf_dir).nation
    return th.tree_names(mp.nation_descriptor(nation), mp.nation_descriptor_tree_multi(nation))


def order_strategies(t: Tables) -> list[tuple[str, DataFrame]]:
    """Three id 'search strategies' over orders: a year range, a customer
    segment list (semi join) and a priority."""
    o = t.orders.select(F.col("o_orderkey").alias("id"), "o_orderdate", "o_custkey", "o_orderpriority")
    by_year = o.where(ql.date_in_years("o_orderdate", 1995, 1997)).select("id")
    segments = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").alias("o_custkey"))
    by_segment = ql.member_of(o, "o_custkey", segments, "o_custkey").select("id")
    by_priority = o.where(F.col("o_orderpriority") == "1-URGENT").select("id")
    return [("date_range", by_year), ("journals", by_segment), ("subjects", by_priority)]


def q08_union_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.union_strategies(order_strategies(Tables(spark, sf_dir)), "id").select(
        F.col("id").alias("pmid"), "strategy", F.col("rank").cast("int").alias("rank"))


def q27_membership_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AND of a year range, a priority list and region membership of
    the customer's nation (semi joins through small dimension lists)."""
    t = Tables(spark, sf_dir)
    regions = t.region.where(F.col("r_name").isin("EUROPE", "ASIA")).select(F.col("r_regionkey").alias("n_regionkey"))
    nations = ql.member_of(t.nation, "n_regionkey", regions, "n_regionkey").select(
        F.col("n_nationkey").alias("c_nationkey"))
    customers = ql.member_of(t.customer, "c_nationkey", nations, "c_nationkey").select(
        F.col("c_custkey").alias("o_custkey"))
    orders = t.orders.where(ql.all_of([
        ql.date_in_years("o_orderdate", 1994, 1996),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
    ]))
    kept = ql.member_of(orders, "o_custkey", customers, "o_custkey")
    return kept.select(F.col("o_orderkey").alias("pmid"), "o_custkey", F.year("o_orderdate").alias("year"))


QUERIES.update({
    "q07_prefix_closure": q07_prefix_closure,
    "q08_union_strategies": q08_union_strategies,
    "q27_membership_filters": q27_membership_filters,
})


# ---------------------------------------------------------------- Q10-Q13, Q30
from tessera.operators import textprep as tp  # noqa: E402
from tessera.operators import vocabulary as vc  # noqa: E402


def part_titles(part: DataFrame) -> DataFrame:
    """Title variants per part: plain, one bracket wrap with dots, nested
    wraps with spaces, parenthesised bracket, and two parenthesised groups."""
    n = F.col("p_name")
    variants = F.array(
        F.struct(F.lit(0).alias("variant"), n.alias("title")),
        F.struct(F.lit(1).alias("variant"), F.concat(F.lit("["), n, F.lit("].")).alias("title")),
        F.struct(F.lit(2).alias("variant"), F.concat(F.lit("  [[ "), n, F.lit(" ] ]..  ")).alias("title")),
        F.struct(F.lit(3).alias("variant"), F.concat(F.lit("(["), n, F.lit("])")).alias("title")),
        F.struct(F.lit(4).alias("variant"), F.concat(F.lit("("), n, F.lit(") and ("), F.col("p_brand"), F.lit(")")).alias("title")),
    )
    return part.select("p_partkey", F.inline(variants))


def q10_clean_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = part_titles(Tables(spark, sf_dir).dealt("part", "p_partkey", "p_name", "p_brand"))
    return titles.select("p_partkey", "variant", "title", tx.clean_title("title").alias("cleaned_title"))


def q11_sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).dealt("documents", "doc_id", "text")
    s = docs.select("doc_id", tx.split_sentences("text").alias("sentences"))
    return s.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"),
                    tx.join_sentences("sentences").alias("rejoined"))


def q12_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).dealt("documents", "doc_id", "text")
    out = tp.preprocess_columns(docs, ["text"], min_length=2)
    return out.select("doc_id", tx.clean_text("text").alias("cleaned"), "text_processed")


def q13_text_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).dealt("documents", "doc_id", "text")
    out = tp.preprocess_columns(docs, ["text"], min_length=2)
    prof = tp.processing_profile(out, ["text"])
    return prof.withColumns({
        "avg_length_before": F.round("avg_length_before", 4),
        "avg_length_after": F.round("avg_length_after", 4),
    })


def q30_normalise_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).dealt("documents", "doc_id", "text")
    toks = docs.select("doc_id", tx.tokenize(tx.clean_text("text")).alias("tokens"))
    out = vc.normalise_tokens(toks, "tokens", "normalised", lemma_table=vc.plural_lemma_table, mode="lemmatize")
    return out.select("doc_id", F.array_join("normalised", " ").alias("normalised"))


QUERIES.update({
    "q10_clean_title": q10_clean_title,
    "q11_sentence_split": q11_sentence_split,
    "q12_clean_text": q12_clean_text,
    "q13_text_profile": q13_text_profile,
    "q30_normalise_vocab": q30_normalise_vocab,
})


# ---------------------------------------------------------------- Q18-Q21, Q28
from tessera.operators import bio  # noqa: E402
from tessera.operators.ordered import positions  # noqa: E402


def event_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token rows ``(file, ord, token, label, prev)``; positions and previous
    labels are computed per (user, day) and stitched, so a very active user
    is not one task."""
    from tessera.operators.ordered import positions_and_previous

    ev = mp.event_tokens(Tables(spark, sf_dir).events)
    day = F.date_trunc("day", F.col("ts"))
    return positions_and_previous(ev, "file", ["ts", "event_id"], "label", segment=day).select(
        "file", "ord", "token", "label", "prev")


def _event_errors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    toks = event_token_rows(spark, sf_dir)
    errs = bio.validate_tokens(toks)
    return toks.drop("prev"), errs


def q18_bio_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, errs = _event_errors(spark, sf_dir)
    return errs.select("file", "line_number", "token", "label", "rule", "error_type", "description", "suggested_fix")


def q19_bio_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = bio.file_verdicts(event_token_rows(spark, sf_dir))
    return v.select(
        "file", "total_lines", "total_errors", "is_valid", "total_entities",
        F.array_join(F.transform(F.sort_array(F.map_entries("entity_counts")),
                                 lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",").alias("entity_counts"),
    )


def q20_bio_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bio.repair_labels(event_token_rows(spark, sf_dir)).select("file", "ord", "token", "label", "fixed_label")


def q21_bio_top_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, errs = _event_errors(spark, sf_dir)
    return bio.top_errors_per_file(errs, 10).select(
        "file", "line_number", "rule", "error_type", F.col("rank").cast("int").alias("rank"),
        "file_errors", "more")


QUERIES.update({
    "q18_bio_errors": q18_bio_errors,
    "q19_bio_stats": q19_bio_stats,
    "q20_bio_repair": q20_bio_repair,
    "q21_bio_top_errors": q21_bio_top_errors,
})


from tessera.sources import tokens as tk  # noqa: E402


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as token-file lines by event type: full layout (4
    columns) for signups and views, simple layout (2 columns) for clicks,
    leading-tab or 3-column simple lines for purchases, and blank lines or
    lines without a tab for errors."""
    ev = mp.event_tokens(Tables(spark, sf_dir).events).withColumn("value", F.col("value"))
    day = F.date_trunc("day", F.col("ts"))
    ev = positions(ev, "file", ["ts", "event_id"], segment=day, out="line_no")
    tok = F.col("token")
    line = (
        F.when(tok.isin("signup", "view"), F.concat_ws("\t", "label", F.lit("x"), F.lit("y"), "token"))
        .when(tok == "click", F.concat_ws("\t", "token", "label"))
        .when((tok == "purchase") & (F.col("value") < 10), F.concat(F.lit("\t"), tok, F.lit("\t"), F.col("label")))
        .when(tok == "purchase", F.concat_ws("\t", "token", "label", F.lit("extra")))
        .when(F.col("value") < 5, F.lit("   "))
        .otherwise(tok)
    )
    return ev.select("file", "line_no", line.alias("line"))


def q28_bio_tokens_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = event_lines(spark, sf_dir)
    return tk.parse_token_lines(lines, "auto", segment_size=16).select(
        "file", "ord", "token", "label", F.col("line_no").cast("int").alias("line_no"))


QUERIES.update({"q28_bio_tokens_parse": q28_bio_tokens_parse})


# ---------------------------------------------------------------- Q14, Q15
from tessera.operators import translate as trn  # noqa: E402


def document_articles(documents: DataFrame) -> DataFrame:
    """Documents as articles: abstract = text, title = first line (French
    documents' titles wrapped as ``[title].`` so title cleaning matters)."""
    first_line = F.substring_index("text", "\n", 1)
    title = F.when(F.col("lang") == "fr", F.concat(F.lit("["), first_line, F.lit("]."))).otherwise(first_line)
    return documents.select(
        "doc_id", "text", title.alias("title"),
        tx.detect_language("text", ES_WORDS, EN_WORDS).alias("abstract_language"),
        tx.has_content("text").alias("has_content"),
    )


def document_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    arts = document_articles(t.dealt("documents", "doc_id", "text", "lang"))
    done_abs = t.labels.where(F.col("quality") == 1).select("doc_id")
    done_titles = t.labels.where(F.col("toxic") == 1).select("doc_id")
    return trn.translation_queue(
        arts, "doc_id", abstract=F.col("text"), language=F.col("abstract_language"),
        has_content=F.col("has_content"), title=F.col("title"),
        done_abstracts=done_abs, done_titles=done_titles,
    )


def q14_translate_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_queue(spark, sf_dir)


class MarkerTranslator:
    """Deterministic stand-in translator: prefixes ``[es] ``; refuses items
    containing ``@`` (so per-item failure handling is exercised)."""

    def __call__(self, texts: list[str]) -> list[str]:
        for t in texts:
            if "@" in t:
                raise ValueError("untranslatable item")
        return ["[es] " + t for t in texts]


def q15_translate_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = document_queue(spark, sf_dir)
    res = trn.translate_items(queue, "doc_id", MarkerTranslator)
    return res.select("doc_id", "kind", "text", "success", "error")


QUERIES.update({
    "q14_translate_queue": q14_translate_queue,
    "q15_translate_apply": q15_translate_apply,
})


# ---------------------------------------------------------------- Q16, Q17
from tessera.operators import splits as sp  # noqa: E402


def q16_multilabel_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 over the labelled orders that have categories."""
    labelled = label_orders(spark, sf_dir).where(ql.has_categories("level1_categories_str"))
    rows = labelled.select("pmid", "level1_categories_str")
    classes = sp.label_classes(category_groups(spark, sf_dir).where(ql.has_categories("level1_categories_str")))
    m = sp.multilabel_matrix(rows, classes)
    return m.withColumn("n_labels", F.size(sp.category_list("level1_categories_str")).cast("int")).drop(
        "level1_categories_str")


def q17_split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents.select(
        "doc_id", F.concat_ws("; ", "lang", "source").alias("categories"))
    out = sp.assign_splits(sp.single_label(docs, "categories"), "doc_id")
    return out.select("doc_id", "single_category", "bucket", "split")


QUERIES.update({
    "q16_multilabel_matrix": q16_multilabel_matrix,
    "q17_split_assign": q17_split_assign,
})


# ---------------------------------------------------------------- Q22-Q25
from tessera.operators import chunking as ch  # noqa: E402
from tessera.operators import requests as rq  # noqa: E402

DOC_CHUNK_LINES = 200
TURN_CHUNK_LINES = 50
REQUEST_BATCH = 100
MODEL = "translator-model"


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).dealt("documents", "doc_id", "text").select(
        F.col("doc_id").cast("string").alias("doc_id"), ch.text_tokens(F.col("text")).alias("tokens"))
    return ch.split_documents(docs, "doc_id", "tokens", DOC_CHUNK_LINES)


def q23_chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chunks(spark, sf_dir)
    return c.select(
        "source_file", "chunk_index", "total_chunks", "start", "end",
        F.size("tokens").alias("n_tokens"),
        F.try_element_at("tokens", F.lit(1))["token"].alias("first_token"),
        F.try_element_at("tokens", F.lit(-1))["token"].alias("last_token"),
    )


def turn_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = Tables(spark, sf_dir).dealt("conversations", "conv_id", "turn", "text")
    files = conv.select(
        F.format_string("c%05d_t%03d", "conv_id", "turn").alias("file"),
        ch.text_tokens(F.col("text")).alias("tokens"))
    return ch.split_documents(files, "file", "tokens", TURN_CHUNK_LINES)


def q22_request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    reqs = ch.build_requests(turn_chunks(spark, sf_dir), MODEL)
    batched = ch.assign_batches(reqs, ["source_file", "chunk_index"], REQUEST_BATCH)
    r = F.col("request")
    return batched.select(
        r["custom_id"].alias("custom_id"), "batch_no", r["method"].alias("method"), r["url"].alias("url"),
        r["body"]["model"].alias("model"), F.size(r["body"]["messages"]).alias("n_messages"),
        r["body"]["messages"][1]["content"].alias("prompt"), "total_chunks",
        tx.estimate_tokens(r["body"]["messages"][1]["content"]).alias("est_tokens"),
    )


def conversation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines for every (conversation, turn) chunk, as JSON text parsed
    back with the declared schema: the turn text with spaces turned into tabs
    is the response content; system turns answer 500."""
    conv = Tables(spark, sf_dir).conversations
    status = F.when(F.col("role") == "system", F.lit(500)).otherwise(F.lit(200))
    rec = F.struct(
        ch.chunk_custom_id(F.col("conv_id"), F.col("turn")).alias("custom_id"),
        F.struct(
            status.alias("status_code"),
            F.struct(F.array(F.struct(F.struct(F.replace("text", F.lit(" "), F.lit("\t")).alias("content")).alias("message"))).alias("choices")).alias("body"),
        ).alias("response"),
    )
    return rq.parse_result_json(conv.select(F.to_json(rec).alias("value")))


def q24_reassemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = rq.split_results(conversation_results(spark, sf_dir))
    docs = rq.reassemble(rq.translated_chunks(ok))
    return docs.select(
        F.col("source_file").cast("long").alias("conv_id"),
        F.array_join(F.transform("chunk_indexes", lambda i: i.cast("string")), ",").alias("chunk_indexes"),
        F.size("tokens").alias("n_tokens"),
        tx.tokens_to_text(F.col("tokens")).alias("text"),
    )


def q25_retry_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = Tables(spark, sf_dir).conversations
    reqs = conv.select(ch.chunk_custom_id(F.col("conv_id"), F.col("turn")).alias("custom_id"))
    ok, _ = rq.split_results(conversation_results(spark, sf_dir))
    retry = rq.retry_set(reqs, ok)
    return retry.select("custom_id", ch.custom_id_file(F.col("custom_id")).cast("long").alias("conv_id"),
                        ch.custom_id_index(F.col("custom_id")).alias("turn"))


QUERIES.update({
    "q22_request_lines": q22_request_lines,
    "q23_chunk_documents": q23_chunk_documents,
    "q24_reassemble": q24_reassemble,
    "q25_retry_set": q25_retry_set,
})


# ---------------------------------------------------------------- Q26, Q29
from tessera.functions import markup as mk  # noqa: E402
from tessera.operators import compare as cmp  # noqa: E402


def _file_names(df: DataFrame) -> DataFrame:
    return df.select(F.format_string("doc_%06d.nersuite", "doc_id").alias("name"))


def dataset_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    a = _file_names(t.documents)
    b = _file_names(t.labels)
    return cmp.membership(a, b)


def q26_dataset_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmp.completeness(dataset_members(spark, sf_dir))


def q26b_missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the membership table feeds four top-k scans: computed once
    m = reusable(dataset_members(spark, sf_dir))
    a = cmp.missing_preview(m, "only_a").withColumn("side", F.lit("only_a"))
    b = cmp.missing_preview(m, "only_b").withColumn("side", F.lit("only_b"))
    return a.unionByName(b).select("side", "name", "part")


def q29_page_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).dealt("pages", "page_id", "html")
    h = F.col("html")
    return p.select(
        "page_id",
        mk.first_element_text(h, "title").alias("title"),
        mk.first_element_text(h, "h1").alias("heading"),
        mk.attribute_value(h, "html", "lang").alias("lang"),
        mk.attribute_value(h, "meta", "charset").alias("charset"),
        mk.count_elements(h, "a").alias("n_links"),
    )


QUERIES.update({
    "q26_dataset_compare": q26_dataset_compare,
    "q26b_missing_files": q26b_missing_files,
    "q29_page_extract": q29_page_extract,
})


# ---------------------------------------------------------------- Q31-Q38: summaries
def q31_language_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 over the document language vote."""
    docs = Tables(spark, sf_dir).dealt("documents", "doc_id", "text")
    langs = docs.select(tx.detect_language("text", ES_WORDS, EN_WORDS).alias("abstract_language"))
    return pf.language_summary(langs)


def q32_thesaurus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 over the hierarchy of Q07."""
    nation = Tables(spark, sf_dir).nation
    d, t = mp.nation_descriptor(nation), mp.nation_descriptor_tree_multi(nation)
    return th.thesaurus_stats(d, t, th.tree_names(d, t))


def q33_translation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D13 over the translated document queue of Q15."""
    res = trn.translate_items(document_queue(spark, sf_dir), "doc_id", MarkerTranslator)
    return trn.translation_summary(res)


def q34_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D16 + H4: top 10 level-1 labels with their share of labelled articles."""
    labelled = category_groups(spark, sf_dir).where(ql.has_categories("level1_categories_str"))
    counts = sp.label_counts(labelled, weight="n")
    return pf.top_k(counts, 10, "count", "category")


def q35_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: rows per split."""
    docs = Tables(spark, sf_dir).documents.select("doc_id")
    return sp.split_sizes(sp.assign_splits(docs, "doc_id"))


def q36_batch_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks and distinct source files per request batch."""
    reqs = ch.build_requests(turn_chunks(spark, sf_dir), MODEL)
    batched = ch.assign_batches(reqs, ["source_file", "chunk_index"], REQUEST_BATCH)
    info = ch.batch_info(batched)
    return info.select("batch_no", "chunks", F.array_join("files", ",").alias("files"))


def q37_bio_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D18 + D20 + H5: errors per type and the validation summary, long form."""
    toks, errs = _event_errors(spark, sf_dir)
    by_type = bio.error_statistics(errs).select(
        F.lit("error_type").alias("metric"), F.col("error_type").alias("key"), F.col("count").alias("value"))
    summ = bio.validation_summary(bio.file_verdicts(event_token_rows(spark, sf_dir))).select(F.expr(
        "stack(3, 'total_files', total_files, 'total_errors', total_errors, "
        "'files_with_errors', files_with_errors) as (metric, value)")).select(
        "metric", F.lit(None).cast("string").alias("key"), "value")
    return by_type.unionByName(summ)


def q38_strategy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 + D8: ids searched per strategy and ids new to the union."""
    c = co.strategy_counts(order_strategies(Tables(spark, sf_dir)), "id")
    return c.select("strategy", F.col("rank").cast("int").alias("rank"), "searched", "new")


QUERIES.update({
    "q31_language_summary": q31_language_summary,
    "q32_thesaurus_stats": q32_thesaurus_stats,
    "q33_translation_summary": q33_translation_summary,
    "q34_label_counts": q34_label_counts,
    "q35_split_sizes": q35_split_sizes,
    "q36_batch_info": q36_batch_info,
    "q37_bio_summary": q37_bio_summary,
    "q38_strategy_counts": q38_strategy_counts,
})


# ---------------------------------------------------------------- Q39: XML records
from tessera.sources import articles as art  # noqa: E402


def order_xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article record per order, rendered from the tables: mixed-content
    title; a section that closes itself, a section with ``>`` in its label and
    a CDATA part, an unlabelled one with a comment; the order's lineitems as
    headings (major when returned), the clerk as author beside a group, ids of
    the article and of a cited work, a keyword that is empty, a journal and a
    date.  Records of low-priority pending orders are left unclosed.  The records
    are dealt out by key, so that their parser runs in every task."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.format_string('<MeshHeading><DescriptorName UI="S%d" MajorTopicYN="%s">supplier %d</DescriptorName>'
                        '<QualifierName UI="Q%d" MajorTopicYN="N">line</QualifierName></MeshHeading>',
                        "l_suppkey", F.when(F.col("l_returnflag") == "R", "Y").otherwise("N"), "l_suppkey",
                        "l_linenumber").alias("h"))
    heads = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "h"))), lambda s: s["h"]), "")
        .alias("headings"))
    o = t.orders.join(heads, "o_orderkey", "left")
    key, cust, status = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    cents = F.floor(F.col("o_totalprice") * 100).cast("string")
    parts = [
        '<PubmedArticle><MedlineCitation><PMID Version="1"> ', key, " </PMID><Article><Journal><ISSN IssnType='Print'>", cust,
        "</ISSN><JournalIssue><PubDate><Year>", F.year("o_orderdate").cast("string"), "</Year></PubDate></JournalIssue><Title>",
        F.col("o_orderpriority"), "</Title></Journal><ArticleTitle>Order <i>", status, "</i> &amp; <b/>more &#60;x></ArticleTitle>",
        '<Abstract><AbstractText Label="AIM" NlmCategory="X"/><AbstractText Label="TOTAL > ', status, '"><![CDATA[<', cents,
        ">]]> cents</AbstractText><AbstractText>", F.col("o_orderpriority"), "<!-- <b> --> text</AbstractText></Abstract>",
        "<AuthorList><Author><CollectiveName>Group</CollectiveName></Author><Author><LastName>", cust,
        "</LastName><ForeName/></Author></AuthorList></Article><MeshHeadingList>", F.coalesce("headings", F.lit("")),
        "</MeshHeadingList><KeywordList><Keyword/><Keyword> ", status, " &lt; 1</Keyword></KeywordList></MedlineCitation><PubmedData><ArticleIdList>",
        '<ArticleId IdType="doi">old</ArticleId><ArticleId IdType="doi">10/', key, "</ArticleId></ArticleIdList><ReferenceList><Reference>",
        '<ArticleIdList><ArticleId IdType="doi">cited</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData>',
        F.when((F.col("o_orderpriority") == "5-LOW") & (status == "P"), F.lit("")).otherwise(F.lit("</PubmedArticle>")),
    ]
    xml = o.select("o_orderkey", F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts]).alias("xml"))
    return xml.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey").select("xml")


def q39_xml_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 gate + B1-B9 extraction + C1/C2 over XML records rendered from the tables."""
    a = art.extract_articles(order_xml_records(spark, sf_dir))
    return a.where(ql.require_abstract("abstract.has_content") & ql.require_terms("mesh_terms")).select(
        F.col("pmid").cast("long").alias("pmid"), "title",
        F.col("abstract.full_text").alias("full_text"), F.col("abstract.word_count").alias("word_count"),
        F.col("abstract.structured").alias("structured"),
        F.size("mesh_terms").alias("n_terms"),
        F.size(ql.major_terms_only("mesh_terms")).alias("n_major"),
        F.col("journal.title").alias("journal_title"), F.col("journal.issn").alias("issn"),
        F.array_join(F.transform("authors", lambda x: F.concat_ws("/", x["last_name"], F.coalesce(x["first_name"], F.lit("-")))), ";").alias("authors"),
        F.array_join("keywords", ";").alias("keywords"), F.col("identifiers")["doi"].alias("doi"),
        art.publication_year(F.col("publication_info")).alias("year"),
    )


QUERIES.update({"q39_xml_extract": q39_xml_extract})


# ---------------------------------------------------------------- Q40-Q49: operators met by no other query
import os  # noqa: E402
import uuid  # noqa: E402

from tessera.session import ensure_checkpoint_dir  # noqa: E402
from tessera.sinks import writers as wr  # noqa: E402


def q40_gated_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strategies run until half of all orders are found."""
    t = Tables(spark, sf_dir)
    union, _ = co.gated_union(order_strategies(t), t.orders.count() // 2, "id")
    return union.select(F.col("id").alias("pmid"), "strategy", F.col("rank").cast("int").alias("rank"))


def q41_subject_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 + H8: the first orders with a heading among the subjects."""
    t = Tables(spark, sf_dir)
    sup = t.supplier.join(t.nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("name"))
    terms = t.lineitem.select("l_orderkey", "l_suppkey").join(sup, "l_suppkey").groupBy(F.col("l_orderkey").alias("pmid")).agg(
        F.collect_set(F.struct(F.struct("name").alias("descriptor"))).alias("mesh_terms"))
    return pf.sample_first(terms.where(ql.any_term_in("mesh_terms", ["NATION_3", "NATION_7"])).select("pmid"), 20, "pmid")


def q42_new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order in 1998 and none before 1997."""
    o = Tables(spark, sf_dir).orders
    seen = o.where(ql.date_in_years("o_orderdate", 1900, 1996)).select(F.col("o_custkey").alias("id"))
    return co.new_ids(o.where(ql.date_in_years("o_orderdate", 1998, 1998)).select(F.col("o_custkey").alias("id")), seen, "id")


def q43_single_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per single label."""
    docs = Tables(spark, sf_dir).documents.select(F.concat_ws("; ", "source", "lang").alias("categories"))
    return pf.group_counts(sp.single_label(docs, "categories"), "single_category", "category")


def q44_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J14 + J16: report texts; a missing nested field yields the default."""
    docs = Tables(spark, sf_dir).documents.select(
        F.struct(F.when(F.col("n_chars") > 1000, F.col("lang")).alias("title")).alias("journal"))
    total = docs.count()
    counts = pf.group_counts(docs, tx.nested_get("journal.title", "Unknown"), "journal")
    return pf.report_format(counts.withColumn("share", F.col("count") * 100.0 / F.lit(max(total, 1))), ["count"], ["share"])


def q45_stem_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: Spanish stems, and stems of lemmas."""
    docs = Tables(spark, sf_dir).dealt("documents", "doc_id", "text")
    toks = docs.select("doc_id", tx.tokenize(tx.clean_text("text")).alias("tokens"))
    out = vc.normalise_modes(toks, "tokens", {"stemmed": "stem", "lemma_stemmed": "both"}, vc.plural_lemma_table)
    return out.select("doc_id", F.array_join("stemmed", " ").alias("stemmed"), F.array_join("lemma_stemmed", " ").alias("lemma_stemmed"))


def q46_split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 at exact sizes, every id twice."""
    docs = Tables(spark, sf_dir).documents.select("doc_id")
    twice = docs.withColumn("copy", F.lit(0)).unionByName(docs.withColumn("copy", F.lit(1)))
    return sp.assign_splits_exact(twice, "doc_id").groupBy("split").agg(F.count("*").alias("n"), F.max("bucket").alias("last_bucket"))


def q47_chunk_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every result delivered twice; the missing chunks of each file."""
    conv = Tables(spark, sf_dir).conversations
    ok, _ = rq.split_results(conversation_results(spark, sf_dir))
    totals = conv.groupBy(F.col("conv_id").cast("string").alias("source_file")).agg((F.max("turn") + 1).alias("total_chunks"))
    chunks = rq.translated_chunks(ok)
    docs = rq.reassemble(chunks.unionByName(chunks), totals)
    return docs.select(F.col("source_file").cast("long").alias("conv_id"), "total_chunks",
                       F.coalesce(F.size("tokens"), F.lit(0)).alias("n_tokens"),
                       F.array_join(F.transform("missing", lambda i: i.cast("string")), ",").alias("missing"))


def q48_category_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 + A8: the category table written as CSV and read back."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"categories-{uuid.uuid4().hex}.csv")
    quoted = label_orders(spark, sf_dir).withColumn("title", F.concat_ws("\n", F.lit('said "hi", ok'), "title"))
    wr.write_category_csv(quoted, path)
    from tessera.jobs.corpus import CATEGORY_CSV_SCHEMA

    back = wr.read_category_csv(spark, path, CATEGORY_CSV_SCHEMA)
    return back.select(F.col("pmid").cast("long").alias("pmid"), "title", "year", "level1_codes", "major_subjects_count", "level1_categories_str")


def q49_corpus_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics record, maps as sorted text."""
    o = Tables(spark, sf_dir).orders
    stats = pf.corpus_statistics(o, year=F.year("o_orderdate"), journal="o_orderpriority", language="o_orderstatus",
                                 word_count="o_totalprice", structured=F.col("o_orderstatus") == "F", stage_counts={"final": 1})

    def text(c: str):
        return F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))), ",").alias(c)

    return stats.select("total_articles", "year_earliest", "year_latest", F.round("avg_abstract_length", 2).alias("avg_abstract_length"),
                        "structured_abstracts", text("language_distribution"), text("top_years"), text("top_journals"), text("collection_stats"))


def q50_status_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14: orders as batch jobs, by the class of their status."""
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderpriority") == "5-LOW", "expired").otherwise("validating")
    return pf.group_counts(Tables(spark, sf_dir).orders, ql.status_class(status), "status")


QUERIES.update({
    "q50_status_classes": q50_status_classes,
    "q40_gated_union": q40_gated_union,
    "q41_subject_filter": q41_subject_filter,
    "q42_new_ids": q42_new_ids,
    "q43_single_labels": q43_single_labels,
    "q44_report": q44_report,
    "q45_stem_modes": q45_stem_modes,
    "q46_split_exact": q46_split_exact,
    "q47_chunk_redelivery": q47_chunk_redelivery,
    "q48_category_csv": q48_category_csv,
    "q49_corpus_statistics": q49_corpus_statistics,
})


# ---------------------------------------------------------------- Q51-Q61: files written and read back
from tessera.plans import roundtrips  # noqa: E402

QUERIES.update(roundtrips.QUERIES)
