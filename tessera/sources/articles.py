"""Article sources: the JSON dataset (A1) and XML records (A2 + B1-B9).

XML records are split with the text source (``lineSep`` = the closing tag),
which keeps input splitting parallel for large files.  Each record is parsed
once, by an XML parser, in Arrow batches: Spark's own XML reader has no type
for mixed content (``Foo <i>x</i> bar``) and every ``xpath_*`` call parses the
record again.  A record that is not well-formed gives a null ``record`` and
goes to a quarantine frame instead of failing the job.  What the parser reads
(texts, attributes, in document order) is then projected natively: abstract
text, word count, language vote.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import fixed_values as fv
from tessera.functions import text as tx
from tessera.sources.json_split import array_elements

ARTICLE_SCHEMA = """
pmid string, title string,
abstract struct<full_text:string, sections:array<struct<label:string,content:string>>,
                has_content:boolean, word_count:int, structured:boolean,
                spanish_translation:struct<text:string, success:boolean, model_used:string,
                     batch_size_used:int, translation_date:string, error:string>>,
abstract_language string,
title_spanish_translation struct<original_title:string, cleaned_title:string, translated_title:string,
                     success:boolean, model_used:string, batch_size_used:int, translation_date:string, error:string>,
journal struct<title:string, iso_abbreviation:string, issn:string>,
authors array<struct<last_name:string, first_name:string>>,
mesh_terms array<struct<descriptor:struct<name:string, ui:string, major_topic:boolean>,
                qualifiers:array<struct<name:string, ui:string, major_topic:boolean>>>>,
keywords array<string>,
publication_info struct<year:string, month:string>,
identifiers map<string,string>,
collection_date string, copyright_status string, quality_filters_passed array<string>
"""

DATASET_SCHEMA = f"""
metadata struct<creation_date:string, collection_method:string, total_articles:bigint,
                filters_applied:array<string>, search_strategies:array<string>>,
statistics struct<total_articles:bigint, language_distribution:map<string,bigint>,
                year_range:struct<earliest:int,latest:int>, top_years:map<string,bigint>,
                top_journals:map<string,bigint>, avg_abstract_length:double, structured_abstracts:bigint,
                collection_stats:map<string,bigint>>,
articles array<struct<{ARTICLE_SCHEMA}>>
"""

QUALITY_FILTERS = ["has_abstract", "has_mesh_terms", "copyright_free"]


# ---------------------------------------------------------------- A1
def read_article_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A1: one JSON document ``{metadata, statistics, articles[]}`` ->
    ``(articles, metadata, statistics)``.  The document is parsed by one task;
    articles of a large one are read with :func:`read_articles`."""
    doc = spark.read.schema(DATASET_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    articles = doc.select(F.explode("articles").alias("a")).select("a.*")
    return articles, doc.select("metadata.*"), doc.select("statistics.*")


def read_articles(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A1 at scale: one article per JSON line, a parquet table, or (``document``)
    the ``articles`` of one or more JSON documents, each read by many tasks."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "document":
        parsed = array_elements(spark, path, "articles").select(F.from_json("json", ARTICLE_SCHEMA, {"mode": "FAILFAST"}).alias("a"))
        return parsed.select("a.*")
    return spark.read.schema(ARTICLE_SCHEMA).json(path)


def has_rows(df: DataFrame) -> bool:
    """Emptiness check that reads at most one row."""
    return df.limit(1).count() > 0


def require_articles(articles: DataFrame, path: str) -> DataFrame:
    """A1: an input without a single article is an error that names the input."""
    if not has_rows(articles):
        raise ValueError(f"no articles in {path}")
    return articles


# ---------------------------------------------------------------- A2
def read_xml_records(spark: SparkSession, path: str, tag: str = "PubmedArticle") -> DataFrame:
    """A2 (splitter): one row per ``<tag>...</tag>`` record, as text."""
    raw = spark.read.option("lineSep", f"</{tag}>").text(path)
    body = F.regexp_extract(F.col("value"), rf"(?s)(<{tag}[\s>].*)$", 1)
    return raw.select(body.alias("b")).where(F.col("b") != "").select(
        F.concat(F.col("b"), F.lit(f"</{tag}>")).alias("xml"))


NAMED = "struct<name:string, ui:string, major_topic:boolean>"
RECORD_SCHEMA = f"""struct<pmid:string, title:string, sections:array<struct<label:string, content:string>>,
journal:struct<title:string, iso_abbreviation:string, issn:string>,
authors:array<struct<last_name:string, first_name:string>>,
mesh_terms:array<struct<descriptor:{NAMED}, qualifiers:array<{NAMED}>>>,
keywords:array<string>, publication_info:struct<year:string, month:string>,
identifiers:map<string,string>, all_identifiers:map<string,string>>""".replace("\n", " ")


def _first(elements: list[ET.Element]) -> ET.Element | None:
    return elements[0] if elements else None


def _leading(element: ET.Element | None, tag: str) -> str | None:
    """Text of the first child ``tag`` before its own first child, if any."""
    return element.findtext(tag) or None if element is not None else None


def _whole(element: ET.Element) -> str:
    """All descendant text, in document order, stripped."""
    return "".join(element.itertext()).strip() if len(element) else (element.text or "").strip()


def _named(element: ET.Element) -> dict:
    return {"name": element.text, "ui": element.get("UI", ""), "major_topic": element.get("MajorTopicYN") == "Y"}


def _identifiers(found: list[ET.Element]) -> list[tuple[str, str]]:
    return list({e.get("IdType"): e.text for e in found if e.get("IdType") and e.text}.items())


#: What is looked for at any depth of a record, in one pass over it.
LOOKED_FOR = ("PMID", "ArticleTitle", "Journal", "AuthorList", "PubDate", "Abstract", "MeshHeading", "KeywordList", "ArticleId")


def parse_record(xml: str | None) -> dict | None:
    """B1-B8 of one record; None if it is null or not well-formed."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return None
    below: dict[str, list[ET.Element]] = {tag: [] for tag in LOOKED_FOR}
    for e in root.iter():
        if e.tag in below and e is not root:
            below[e.tag].append(e)
    pmid, title = _first(below["PMID"]), _first(below["ArticleTitle"])
    journal, authors, date = _first(below["Journal"]), _first(below["AuthorList"]), _first(below["PubDate"])
    own = next((ids for data in root.findall("PubmedData") if (ids := data.find("ArticleIdList")) is not None), None)
    return {
        "pmid": ((pmid.text if pmid is not None else None) or "").strip(),
        "title": _whole(title) if title is not None else "",
        "sections": [{"label": t.get("Label", "").strip(), "content": c}
                     for a in below["Abstract"] for t in a.findall("AbstractText") if (c := _whole(t))],
        "journal": {"title": _leading(journal, "Title"), "iso_abbreviation": _leading(journal, "ISOAbbreviation"), "issn": _leading(journal, "ISSN")},
        "authors": [{"last_name": _leading(a, "LastName"), "first_name": _leading(a, "ForeName")}
                    for a in (authors.findall("Author") if authors is not None else ())
                    if a.find("LastName") is not None or a.find("ForeName") is not None],
        "mesh_terms": [{"descriptor": _named(d), "qualifiers": [_named(q) for q in h.findall("QualifierName")]}
                       for h in below["MeshHeading"] if (d := h.find("DescriptorName")) is not None],
        "keywords": [k.text.strip() for ks in below["KeywordList"] for k in ks.findall("Keyword") if k.text],
        "publication_info": {"year": (_leading(date, "Year") or "") if date is not None and date.find("Year") is not None else None,
                             "month": _leading(date, "Month")},
        "identifiers": _identifiers(own.findall("ArticleId") if own is not None else []),
        "all_identifiers": _identifiers(below["ArticleId"]),
    }


def parse_records(records: DataFrame, keep_text: bool = True) -> DataFrame:
    """``xml, record`` for every row of ``records`` (column ``xml``); ``record``
    is null where the text is not well-formed.  Without ``keep_text`` the texts
    do not come back from the parser."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = pa.struct([("name", pa.string()), ("ui", pa.string()), ("major_topic", pa.bool_())])
        pair = pa.map_(pa.string(), pa.string())
        text = lambda *names: pa.struct([(n, pa.string()) for n in names])
        kind = pa.struct([
            ("pmid", pa.string()), ("title", pa.string()), ("sections", pa.list_(text("label", "content"))),
            ("journal", text("title", "iso_abbreviation", "issn")), ("authors", pa.list_(text("last_name", "first_name"))),
            ("mesh_terms", pa.list_(pa.struct([("descriptor", named), ("qualifiers", pa.list_(named))]))),
            ("keywords", pa.list_(pa.string())), ("publication_info", text("year", "month")),
            ("identifiers", pair), ("all_identifiers", pair)])
        for batch in batches:
            parsed = pa.array([parse_record(x) for x in batch.column(0).to_pylist()], type=kind)
            yield pa.record_batch([batch.column(0), parsed] if keep_text else [parsed], names=["xml", "record"] if keep_text else ["record"])

    return records.select("xml").mapInArrow(parse, f"{'xml string, ' if keep_text else ''}record {RECORD_SCHEMA}")


def gate_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed records split into (well-formed, quarantined)."""
    parsed = records if "record" in records.columns else parse_records(records)
    return parsed.where(F.col("record").isNotNull()), parsed.where(F.col("record").isNull()).select("xml")


def abstract_of(sections: Column) -> Column:
    """B2: the abstract struct of the non-blank ``(label, content)`` sections."""
    full = F.array_join(F.transform(sections, lambda s: F.when(
        s["label"] != "", F.concat(s["label"], F.lit(": "), s["content"])).otherwise(s["content"])), "\n\n")
    named = F.transform(sections, lambda s: F.struct(
        F.when(s["label"] != "", s["label"]).otherwise(F.lit("Main")).alias("label"), s["content"].alias("content")))
    return F.struct(
        full.alias("full_text"),
        named.alias("sections"),
        (F.size(sections) > 0).alias("has_content"),
        tx.word_count(full).cast("int").alias("word_count"),
        F.exists(sections, lambda s: s["label"] != "").alias("structured"),
        F.lit(None).cast("struct<text:string, success:boolean, model_used:string, batch_size_used:int, "
                         "translation_date:string, error:string>").alias("spanish_translation"),
    )


def extract_articles(records: DataFrame, article_ids_only: bool = True) -> DataFrame:
    """Every well-formed record -> article row (before quality filters).

    B7: by default only the article's own ``PubmedData/ArticleIdList`` is read
    (ids of cited works would otherwise overwrite the article's own); of equal
    types the last id wins."""
    parsed = records if "record" in records.columns else parse_records(records, keep_text=False)
    good = parsed.where(F.col("record").isNotNull())
    r = F.col("record")
    ids = r["identifiers"] if article_ids_only else r["all_identifiers"]
    a = good.select(
        r["pmid"].alias("pmid"), r["title"].alias("title"), abstract_of(r["sections"]).alias("abstract"),
        *[r[f].alias(f) for f in ("journal", "authors", "mesh_terms", "keywords", "publication_info")],
        ids.alias("identifiers"))
    return a.select(
        "pmid", "title", "abstract",
        tx.detect_language(F.col("abstract.full_text")).alias("abstract_language"),
        F.lit(None).cast("struct<original_title:string, cleaned_title:string, translated_title:string, "
                         "success:boolean, model_used:string, batch_size_used:int, translation_date:string, "
                         "error:string>").alias("title_spanish_translation"),
        "journal", "authors", "mesh_terms", "keywords", "publication_info", "identifiers",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("collection_date"),
        F.lit("free").alias("copyright_status"),
        F.array(*[F.lit(q) for q in QUALITY_FILTERS]).alias("quality_filters_passed"),
    )


def publication_year(pub: Column) -> Column:
    """Integer year when the raw year is all digits, else null."""
    return F.when(pub["year"].rlike(r"^[0-9]+$"), pub["year"].try_cast("int"))


def ingest_xml(spark: SparkSession, path: str, min_words: int = fv.MIN_ABSTRACT_WORDS,
               article_ids_only: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A2 + B1-B9 + C1-C4: ``(articles_passing_filters, all_extracted, quarantined)``."""
    from tessera.operators import quality as ql

    good, bad = gate_records(read_xml_records(spark, path))
    extracted = extract_articles(good, article_ids_only)
    kept = ql.quality_filter(extracted, n=min_words)
    return kept, extracted, bad
