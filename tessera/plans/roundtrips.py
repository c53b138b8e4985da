"""Driver queries Q51-Q62: files written from the driver's tables and read back
by the library's own sources, sinks and jobs, with their DuckDB SQL.

Every query writes into a folder of its own under the shared checkpoint folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.jobs import corpus
from tessera.operators import bio
from tessera.operators import chunking as ch
from tessera.operators import profile as pf
from tessera.operators import quality as ql
from tessera.operators import requests as rq
from tessera.plans import mappings as mp
from tessera.plans import oracle as orc
from tessera.session import ensure_checkpoint_dir, reusable
from tessera.sinks import writers as wr
from tessera.sinks.files import write_named_files
from tessera.sources import articles as art
from tessera.sources import thesaurus as ts
from tessera.sources import tokens as tk
from tessera.sources.tables import Tables
from tessera.streaming import reassembly as ra
from tessera.streaming.results import result_stream


def new_folder(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- Q51
def conversation_chunks(spark: SparkSession, sf_dir: str, failing: bool) -> DataFrame:
    """Result lines of every (conversation, turn) chunk; with ``failing``, those
    of system turns have status 500."""
    conv = Tables(spark, sf_dir).conversations
    status = F.when((F.col("role") == "system") & F.lit(failing), F.lit(500)).otherwise(F.lit(200))
    message = F.struct(F.struct(F.replace("text", F.lit(" "), F.lit("\t")).alias("content")).alias("message"))
    return conv.select(ch.chunk_custom_id(F.col("conv_id"), F.col("turn")).alias("custom_id"), F.struct(
        status.alias("status_code"), F.struct(F.array(message).alias("choices")).alias("body")).alias("response"))


def q51_stream_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K16 + D23: results land in three parts, shuffled, some of them failed;
    then the retry set's land, and the stream goes on from its checkpoint."""
    base = new_folder(spark, "reassembly")
    landing, out, checkpoint = (os.path.join(base, x) for x in ("landing", "files", "checkpoint"))
    first = conversation_chunks(spark, sf_dir, True)
    totals = Tables(spark, sf_dir).conversations.groupBy(F.col("conv_id").cast("string").alias("source_file")).agg((F.max("turn") + 1).alias("total_chunks"))

    def land(results: DataFrame, parts: int) -> None:
        lines = results.select(F.to_json(F.struct("custom_id", "response")).alias("value"), "custom_id")
        lines.repartition(parts, F.md5("custom_id")).select("value").write.mode("append").text(landing)
        ra.ingest_files(result_stream(spark, landing, 1), totals, out, checkpoint)

    land(first, 3)
    ok, _ = rq.split_results(first)
    land(rq.retry_set(conversation_chunks(spark, sf_dir, False), ok), 1)
    done = ra.complete_files(spark.read.schema(ra.FILE_SCHEMA).parquet(out))
    return done.select(F.col("source_file").cast("long").alias("conv_id"), "total_chunks",
                       F.array_join(F.transform("chunk_indexes", lambda i: i.cast("string")), ",").alias("chunk_indexes"),
                       F.size("tokens").alias("n_tokens"),
                       F.md5(F.array_join(F.transform("tokens", lambda t: F.concat_ws("\t", t["token"], t["label"])), "\n")).alias("tokens_md5"))


Q51 = orc.Q24.replace("WHEN role = 'system' THEN 500", "WHEN false THEN 500")
Q51 = f"""
WITH files AS ({Q51}),
t AS (SELECT conv_id, CAST(max(turn) + 1 AS INTEGER) AS total_chunks FROM conversations GROUP BY conv_id HAVING count(DISTINCT turn) = max(turn) + 1)
SELECT f.conv_id, total_chunks, chunk_indexes, n_tokens, md5(text) AS tokens_md5 FROM files f JOIN t USING (conv_id)
"""


# ---------------------------------------------------------------- Q52-Q54: token files
def event_files(spark: SparkSession, sf_dir: str, layout: str) -> str:
    """A folder with a token file per user: ``token, label`` lines through L5, or
    (``full``) lines of four columns with the label first."""
    from tessera.plans.driver import event_token_rows

    folder = new_folder(spark, "token-files")
    toks = event_token_rows(spark, sf_dir).select(F.concat("file", F.lit(".nersuite")).alias("file"), "ord", "token", "label")
    if layout == "full":
        write_named_files(toks.select("file", "ord", F.concat_ws("\t", "label", F.lit("0"), F.lit("0"), "token").alias("line")), folder)
    else:
        wr.write_token_files(toks, folder)
    return folder


def q52_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5, then A5/A6 + A7 + A10 + G2: token files written under their users'
    names and read back by the jobs' own path."""
    back = tk.read_token_files(spark, event_files(spark, sf_dir, "auto"))
    return back.select(F.regexp_replace("file", r"\.nersuite$", "").alias("file"), "ord", "token", "label", "prev")


def q53_validate_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K14 + L6 + K13: the validation job over token files; its reports per
    file, read back, and the errors left in the repaired files."""
    base = new_folder(spark, "validation")
    corpus.validate_directory(spark, event_files(spark, sf_dir, "auto"), os.path.join(base, "report"), os.path.join(base, "fixed"))
    told = spark.read.schema("file string, total_lines long, total_errors long, is_valid boolean, errors array<struct<line:int,type:string>>").json(
        os.path.join(base, "report", "files"))
    fixed = tk.read_token_files(spark, os.path.join(base, "fixed"))
    clean = reusable(bio.repair_until_clean(fixed))
    left = bio.validate_tokens(clean).groupBy("file").agg(F.count(F.lit(1)).alias("left"))
    lines = clean.groupBy("file").agg(F.count(F.lit(1)).alias("fixed_lines"), F.count_if(F.col("label") == "O").alias("fixed_outside"))
    return told.join(lines, "file").join(left, "file", "left").select(
        F.regexp_replace("file", r"\.nersuite$", "").alias("file"), "total_lines", "total_errors", "is_valid",
        F.coalesce(F.size("errors"), F.lit(0)).alias("listed_errors"), "fixed_lines", "fixed_outside", F.coalesce("left", F.lit(0)).alias("errors_left"))


Q52 = "WITH" + orc.BIO_CTES.rstrip().rstrip(",") + "\nSELECT file, ord, token, label, prev FROM prevs"
Q53 = "WITH" + orc.BIO_CTES.rstrip().rstrip(",") + """,
e AS (SELECT file, count(*) AS n FROM errs GROUP BY file)
SELECT p.file, count(*) AS total_lines, coalesce(max(e.n), 0) AS total_errors, max(e.n) IS NULL AS is_valid,
       CAST(coalesce(max(e.n), 0) AS INTEGER) AS listed_errors, count(*) AS fixed_lines,
       count(*) FILTER (WHERE label = 'O' OR NOT (starts_with(label, 'B-') OR starts_with(label, 'I-')) OR length(label) = 2) AS fixed_outside,
       CAST(0 AS BIGINT) AS errors_left
FROM prevs p LEFT JOIN e USING (file) GROUP BY p.file
"""


def q54_request_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K16 + L4 + L10, then A9 + D23 + E9 + L5: requests made of token files are
    answered with their own lines, all but the first chunk of every third
    file; the jobs' outputs, read back."""
    base = new_folder(spark, "requests")
    corpus.make_requests(spark, event_files(spark, sf_dir, "full"), base, "m", max_lines=60, batch_size=50)
    sent = spark.read.schema("custom_id string, body struct<messages:array<struct<content:string>>>").json(os.path.join(base, "requests"))
    own = F.regexp_extract(F.col("body.messages")[1]["content"], r"(?s)INPUT:\n(.*?)(?:\nNOTE:[^\n]*)?\n\nOUTPUT:", 1)
    user = F.regexp_extract("custom_id", r"^(\d+)\.", 1).cast("long")
    failed = (user % 3 == 0) & F.col("custom_id").endswith("__chunk_0")
    message = F.struct(F.struct(own.alias("content")).alias("message"))
    answers = sent.select("custom_id", F.struct(F.when(failed, 500).otherwise(200).alias("status_code"),
                                                F.struct(F.array(message).alias("choices")).alias("body")).alias("response"))
    answers.write.json(os.path.join(base, "results"))
    corpus.ingest_results(spark, os.path.join(base, "results"), os.path.join(base, "requests"), os.path.join(base, "ingested"))
    back = tk.read_token_files(spark, os.path.join(base, "ingested", "translated"))
    again = spark.read.schema("custom_id string").json(os.path.join(base, "ingested", "retry_requests"))
    retried = again.groupBy(ch.custom_id_file(F.col("custom_id")).alias("file")).agg(F.count(F.lit(1)).alias("retried"))
    files = back.groupBy("file").agg(F.count(F.lit(1)).alias("n_tokens"))
    infos = spark.read.schema("batch_no int, chunks long").json(os.path.join(base, "batch_info")).agg(F.sum("chunks").alias("chunks_sent"))
    return files.join(retried, "file", "full").crossJoin(F.broadcast(infos)).select(
        F.regexp_replace("file", r"\.nersuite$", "").cast("long").alias("user_id"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        F.coalesce("retried", F.lit(0)).alias("retried"), "chunks_sent")


# ---------------------------------------------------------------- Q55: translation in parts
def upper_translator():
    return lambda texts: [t.upper() for t in texts]


def document_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).dealt("documents", "doc_id", "lang", "source", "n_chars")
    whole = F.struct(F.col("doc_id").cast("string").alias("pmid"), F.concat_ws(" ", F.lit("A text from"), "source", F.lit("in"), "lang").alias("title"), F.struct(
        F.concat(F.lit("One of "), F.col("n_chars").cast("string"), F.lit(" characters. Two! Three?")).alias("full_text"), F.lit(True).alias("has_content")).alias("abstract"),
        F.when(F.col("lang") == "es", "spanish").otherwise("english").alias("abstract_language"))
    return docs.select(F.from_json(F.to_json(whole), art.ARTICLE_SCHEMA).alias("a")).select("a.*")


def q55_translate_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K12 + E8 + E5 + L10, then B10 + L1: translation in committed parts, taken
    up once more (nothing is left to do); written, read back and projected."""
    base = new_folder(spark, "translation")
    arts = document_articles(spark, sf_dir)
    corpus.translate_in_parts(spark, arts, upper_translator, "upper", os.path.join(base, "work"), n_parts=4)
    out, _ = corpus.translate_in_parts(spark, arts, upper_translator, "upper", os.path.join(base, "work"))
    wr.write_article_dataset(out, base)
    from tessera.operators import thesaurus as th

    log = spark.read.schema("part int, items long, failed long").json(os.path.join(base, "work", "log")).agg(F.count(F.lit(1)).alias("parts"), F.sum("items").alias("items"))
    rows = th.article_row_projection(art.read_articles(spark, os.path.join(base, "articles"), "parquet"))
    return rows.crossJoin(F.broadcast(log)).select(F.col("pmid").cast("long").alias("doc_id"), "title", "spanish_abstract", "parts", "items")


Q55 = """
SELECT doc_id, upper(concat_ws(' ', 'A text from', source, 'in', lang)) AS title,
       CASE WHEN lang IS NOT DISTINCT FROM 'es' THEN '' ELSE 'ONE OF ' || n_chars || ' CHARACTERS. TWO! THREE?' END AS spanish_abstract,
       CAST(4 AS BIGINT) AS parts, (SELECT count(*) + count(*) FILTER (WHERE lang IS DISTINCT FROM 'es') FROM documents) AS items
FROM documents
"""


# ---------------------------------------------------------------- Q56-Q58: thesaurus, folders, splits
def q56_thesaurus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + L2 + A4 + A12: descriptor records written as XML, the tables built,
    written, and taken from there the second time."""
    base = new_folder(spark, "thesaurus")
    nation = Tables(spark, sf_dir).nation
    tree = mp.nation_descriptor_tree_multi(nation).groupBy("ui", "ord").agg(F.sort_array(F.collect_list("tree_number")).alias("numbers"))
    record = F.concat(F.lit("<DescriptorRecord><DescriptorUI>"), "ui", F.lit("</DescriptorUI><DescriptorName><String>"), "name",
                      F.lit("</String></DescriptorName><TreeNumberList>"),
                      F.array_join(F.transform("numbers", lambda n: F.concat(F.lit("<TreeNumber>"), n, F.lit("</TreeNumber>"))), ""),
                      F.lit("</TreeNumberList></DescriptorRecord>"))
    lines = mp.nation_descriptor(nation).join(tree, "ui").select(F.lit("desc.xml").alias("file"), "ord", record.alias("line"))
    root = spark.createDataFrame([("desc.xml", -1, "<DescriptorRecordSet>"), ("desc.xml", 1 << 62, "</DescriptorRecordSet>")], "file string, ord long, line string")
    write_named_files(lines.unionByName(root), os.path.join(base, "xml"))
    ts.load_or_build_thesaurus(spark, os.path.join(base, "xml"), os.path.join(base, "tables"))
    descriptor, numbers, names = ts.load_or_build_thesaurus(spark, os.path.join(base, "no such file"), os.path.join(base, "tables"))
    return numbers.join(descriptor, "ui").join(names.where("exact").select(F.col("code").alias("tree_number"), F.col("name").alias("node_name")), "tree_number", "left").select(
        F.col("ui").cast("long").alias("nation"), "tree_number", "name", "node_name")


def q57_compare_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 + D22 + E10 + L9: two folders of files, compared by the job; the
    missing names it writes, counted."""
    base = new_folder(spark, "directories")
    t = Tables(spark, sf_dir)
    for side, ids in (("a", t.documents), ("b", t.labels)):
        files = ids.select(F.format_string("doc_%06d.nersuite", "doc_id").alias("file")).distinct()
        write_named_files(files.select("file", F.lit(0).alias("ord"), F.lit(None).cast("string").alias("line")), os.path.join(base, side))
    told = corpus.compare_datasets(spark, os.path.join(base, "a"), os.path.join(base, "b"), os.path.join(base, "out"), ".nersuite")
    listed = spark.read.text(os.path.join(base, "out", "missing_in_b")).agg(F.count(F.lit(1)).alias("listed_only_a"))
    return told.crossJoin(F.broadcast(listed))


Q57 = orc.Q26.replace("SELECT count(*) FILTER (WHERE in_a) AS size_a", "SELECT count(*) FILTER (WHERE in_a AND NOT in_b) AS listed_only_a, count(*) FILTER (WHERE in_a) AS size_a")


def q58_create_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 + L7 + L8: the split job on a category table; rows of its two outputs
    per split, and the rows that its info record counts."""
    from tessera.plans.driver import label_orders

    base = new_folder(spark, "splits")
    wr.write_category_csv(label_orders(spark, sf_dir), os.path.join(base, "categories.csv"))
    corpus.create_split(spark, os.path.join(base, "categories.csv"), os.path.join(base, "out"))
    single = spark.read.option("header", True).csv(os.path.join(base, "out", "traditional")).groupBy("split").agg(F.count(F.lit(1)).alias("single_rows"))
    multi = spark.read.option("header", True).csv(os.path.join(base, "out", "multilabel")).groupBy("split").agg(F.count(F.lit(1)).alias("multi_rows"))
    info = spark.read.schema("category string, count long").json(os.path.join(base, "out", "traditional_info")).agg(F.sum("count").alias("counted"))
    return single.join(multi, "split").crossJoin(F.broadcast(info))


Q58 = "WITH " + orc.LABEL_ORDERS_CTES + """,
b AS (SELECT CAST(('0x' || substr(md5(CAST(pmid AS VARCHAR) || '#42'), 1, 8))::BIGINT % 10000 AS INTEGER) AS bucket FROM labelled WHERE level1_codes <> ''),
s AS (SELECT CASE WHEN bucket < 2000 THEN 'test' WHEN bucket < 3600 THEN 'val' ELSE 'train' END AS split FROM b)
SELECT split, count(*) AS single_rows, count(*) AS multi_rows, (SELECT count(*) FROM s) AS counted FROM s GROUP BY split
"""


# ---------------------------------------------------------------- Q59-Q61
def q59_year_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + C6: articles in year folders, read through a table of years."""
    base = new_folder(spark, "years")
    o = Tables(spark, sf_dir).orders
    arts = mp.order_articles(o)
    wr.write_article_dataset(arts, base, year="year")
    years = o.where(F.col("o_orderpriority") == "1-URGENT").select(F.year("o_orderdate").alias("year")).where("year % 2 = 0").distinct()
    found = ql.in_listed_years(spark.read.parquet(os.path.join(base, "articles")), years)
    return found.groupBy("year").agg(F.count(F.lit(1)).alias("articles"), F.sum("pmid").alias("ids"))


Q59 = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS articles, CAST(sum(o_orderkey) AS BIGINT) AS ids FROM orders
WHERE year(o_orderdate) IN (SELECT year(o_orderdate) FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) % 2 = 0) GROUP BY 1
"""


def q60_distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per year from sketches kept per year and status, against
    the exact counts: within four standard errors."""
    o = Tables(spark, sf_dir).orders.select(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_custkey")
    sketches = pf.distinct_sketches(o, ["year", "o_orderstatus"], "o_custkey")
    exact = o.groupBy("year").agg(F.count_distinct("o_custkey").alias("customers"))
    both = exact.join(pf.distinct_estimates(sketches, ["year"]), "year")
    return both.select("year", "customers", (F.abs(F.col("distinct") - F.col("customers")) <= 4 * 1.04 / 64 * F.col("customers")).alias("within"))


Q60 = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS customers, true AS "within" FROM orders GROUP BY 1
"""


def q61_article_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: all orders in one JSON document, read by many tasks."""
    base = new_folder(spark, "document")
    o = Tables(spark, sf_dir).orders
    a = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("pmid"), F.concat(F.lit('an "order" } ] of '), "o_orderpriority").alias("title"),
                           F.struct(F.year("o_orderdate").cast("string").alias("year")).alias("publication_info")))
    rows = o.select((F.col("o_orderkey") * 2 + 1).alias("ord"), F.concat(F.lit(","), a).alias("line"))
    first = o.agg(F.min("o_orderkey").alias("k")).select("k")
    rows = rows.join(F.broadcast(first), F.lit(True)).select("ord", F.when(F.col("ord") == F.col("k") * 2 + 1, F.substring("line", 2, 1 << 30)).otherwise(F.col("line")).alias("line"))
    ends = spark.createDataFrame([(-(1 << 62), '{"metadata": {"filters_applied": ["]", "{"]}, "articles": ['), (1 << 62, '], "statistics": {}}')], "ord long, line string")
    write_named_files(rows.unionByName(ends).withColumn("file", F.lit("articles.json")), base)
    arts = art.read_articles(spark, base, "document")
    return arts.select(F.col("pmid").cast("long").alias("pmid"), "title", art.publication_year(F.col("publication_info")).alias("year"))


Q61 = """
SELECT o_orderkey AS pmid, 'an "order" } ] of ' || o_orderpriority AS title, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
"""

# ---------------------------------------------------------------- Q62: the translation job, run twice
def upper_but(marker: str):
    """A translator that fails on every batch with a text that holds ``marker``."""
    def translate(texts):
        if any(marker in t for t in texts):
            raise ValueError(f"cannot translate {marker}")
        return [t.upper() for t in texts]

    return lambda: translate


def q62_translate_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C15 + E5 + L11: the translation job with titles only, where those of one
    language fail, then in full on what it wrote: titles that are there keep
    their record, failed ones and the abstracts are translated.  Articles and
    translation infos of both runs are read back."""
    base = new_folder(spark, "translated")
    arts = document_articles(spark, sf_dir)
    told = {}
    for run, factory, titles_only in (("first", upper_but(" in de"), True), ("second", upper_translator, False)):
        out = os.path.join(base, run)
        if corpus.translate_corpus(spark, arts, factory, run, out, titles_only=titles_only)["items"]:
            arts = art.read_articles(spark, os.path.join(out, "articles"), "parquet")
            stats = "translation_stats array<struct<kind string, successful long, failed long, total long>>"
            info = spark.read.schema(f"titles_only_mode boolean, items long, {stats}").json(os.path.join(out, "translation_info")).first()  # one record
            told[run] = {"items": info["items"], "failed": sum(s["failed"] for s in info["translation_stats"]), "titles_only": info["titles_only_mode"]}
    title, text = F.col("title_spanish_translation"), F.col("abstract.spanish_translation.text")
    return arts.select(
        F.col("pmid").cast("long").alias("doc_id"), title["translated_title"].alias("title"), text.alias("spanish_abstract"), title["model_used"].alias("title_model"),
        *[F.lit(told.get(run, {}).get(x)).cast(of).alias(f"{run}_{x}") for run in ("first", "second")
          for x, of in (("items", "long"), ("failed", "long"), ("titles_only", "boolean"))])


Q62 = """
SELECT doc_id, upper(concat_ws(' ', 'A text from', source, 'in', lang)) AS title,
       CASE WHEN lang IS NOT DISTINCT FROM 'es' THEN NULL ELSE 'ONE OF ' || n_chars || ' CHARACTERS. TWO! THREE?' END AS spanish_abstract,
       CASE WHEN lang IS NOT DISTINCT FROM 'de' THEN 'second' ELSE 'first' END AS title_model,
       (SELECT count(*) FROM documents) AS first_items, (SELECT count(*) FILTER (WHERE lang = 'de') FROM documents) AS first_failed, true AS first_titles_only,
       (SELECT count(*) FILTER (WHERE lang = 'de') + count(*) FILTER (WHERE lang IS DISTINCT FROM 'es') FROM documents) AS second_items,
       CAST(0 AS BIGINT) AS second_failed, false AS second_titles_only
FROM documents
"""

#: No token of an event file is a natural cut, so a chunk of a longer file has the
#: 60 lines and the 50 of the look-ahead.
Q54 = """
WITH f AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN user_id % 3 = 0 THEN n - least(n, 110) ELSE n END AS n_tokens,
       CAST(CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS retried, (SELECT CAST(sum(ceil(n / 110.0)) AS BIGINT) FROM f) AS chunks_sent
FROM f
"""

Q56 = """
WITH n AS (SELECT n_nationkey AS nk, n_name, n_regionkey AS r, chr(CAST(65 + n_regionkey AS INTEGER)) || lpad(CAST(n_nationkey % 7 AS VARCHAR), 2, '0') AS l2 FROM nation),
t AS (
  SELECT nk, n_name, l2 || '.' || lpad(CAST(nk AS VARCHAR), 3, '0') AS tree_number FROM n
  UNION ALL SELECT nk, n_name, l2 FROM n WHERE r <= 2
  UNION ALL SELECT nk, n_name, 'Q' || lpad(CAST(r AS VARCHAR), 2, '0') || '.' || lpad(CAST(nk AS VARCHAR), 3, '0') FROM n WHERE r = 4)
SELECT nk AS nation, tree_number, n_name AS name, first_value(n_name) OVER (PARTITION BY tree_number ORDER BY nk) AS node_name FROM t
"""

QUERIES = {
    "q51_stream_reassembly": q51_stream_reassembly, "q52_token_files": q52_token_files, "q53_validate_directory": q53_validate_directory,
    "q54_request_round_trip": q54_request_round_trip, "q55_translate_in_parts": q55_translate_in_parts, "q56_thesaurus_files": q56_thesaurus_files,
    "q57_compare_directories": q57_compare_directories, "q58_create_split": q58_create_split, "q59_year_folders": q59_year_folders,
    "q60_distinct_sketches": q60_distinct_sketches, "q61_article_document": q61_article_document,
    "q62_translate_corpus": q62_translate_corpus,
}
ORACLES = {
    "q51_stream_reassembly": Q51, "q52_token_files": Q52, "q53_validate_directory": Q53, "q54_request_round_trip": Q54, "q55_translate_in_parts": Q55, "q56_thesaurus_files": Q56,
    "q57_compare_directories": Q57, "q58_create_split": Q58, "q59_year_folders": Q59, "q60_distinct_sketches": Q60, "q61_article_document": Q61,
    "q62_translate_corpus": Q62,
}
ORACLES = {k: v.replace("_\\s]", "_" + orc.fv.WHITESPACE + "]").replace("\\s", "[" + orc.fv.WHITESPACE + "]") for k, v in ORACLES.items()}
