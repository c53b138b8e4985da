"""Repeated ids, nulls, empty inputs and re-deliveries in the library operators and jobs."""

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.functions import text as tx
from tessera.jobs import corpus
from tessera.operators import bio, chunking, collection, profile, requests, splits, textprep, thesaurus
from tessera.operators import vocabulary as vc
from tessera.sinks import writers
from tessera.sources import articles as art
from tessera.streaming import results

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


def strip_ed(word):
    return word[:-2] if word.endswith("ed") else word


@pytest.mark.parametrize("mode,want", [
    ("basic", [["cats", "walked"], ["cats"], [], None]),
    ("stem", [["cats", "walk"], ["cats"], [], None]),
    ("lemmatize", [["cat", "walk"], ["cat"], [], None]),
    ("both", [["cat", "walk"], ["cat"], [], None])])
def test_normalised_tokens_of_repeated_ids_and_nulls(spark, mode, want):
    df = spark.createDataFrame([(1, ["cats", "walked"]), (1, ["cats"]), (2, []), (None, None)], "id long, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "cat")], "token string, lemma string")
    out = vc.normalise_tokens(df, "tokens", "norm", lemmas, strip_ed, mode).collect()
    assert sorted((r["norm"] for r in out), key=repr) == sorted(want, key=repr)
    assert sorted((r["id"] for r in out), key=repr) == [1, 1, 2, None]


def test_preprocessing_modes(spark):
    df = spark.createDataFrame([("Los perros; walked",), (None,)], "title string")
    lemmas = spark.createDataFrame([("perros", "perro")], "token string, lemma string")
    for mode, want in (("basic", "perros walked"), ("stem", "perros walk"), ("lemmatize", "perro walk"), ("both", "perro walk")):
        out = textprep.preprocess_columns(df, ["title", "absent"], mode=mode, lemma_table=lemmas, stem_fn=strip_ed)
        assert sorted(r["title_processed"] for r in out.collect()) == ["", want]
    with pytest.raises(ValueError):
        textprep.preprocess_columns(df, ["title"], mode="other")
    with pytest.raises(ValueError):
        textprep.preprocess_columns(df, ["title"], mode="lemmatize")


def test_dense_index_keeps_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate([3, None, 1, 1, None, 2] * 5)], "k long, v long").repartition(4)
    rows = chunking.dense_index(df, ["k"], "idx").orderBy("idx").collect()
    assert [r["idx"] for r in rows] == list(range(30)) and sorted(r["v"] for r in rows) == list(range(30))
    keys = [r["k"] for r in rows]
    assert keys[:10] == [None] * 10 and keys[10:] == sorted(keys[10:])
    assert chunking.dense_index(df.limit(0), ["k"]).count() == 0


def test_exact_split_of_repeated_ids(spark):
    df = spark.createDataFrame([(i % 10,) for i in range(20)], "id long")
    sizes = {r["split"]: r["count"] for r in splits.split_sizes(splits.assign_splits_exact(df, "id")).collect()}
    assert sizes == {"test": 4, "val": 4, "train": 12}
    sizes = {r["split"]: r["count"] for r in splits.split_sizes(splits.assign_splits_exact(df, "id", test=0.0625, val=0.5)).collect()}
    assert sizes == {"test": 2, "val": 9, "train": 9}


def test_equal_column_names_of_categories_are_an_error(spark):
    df = spark.createDataFrame([("a b; a,_b",)], "level1_categories_str string")
    with pytest.raises(ValueError):
        splits.multilabel_matrix(df, ["a b", "a,_b"])


def test_a_chunk_delivered_twice_counts_once(spark):
    t = "array<struct<token:string,label:string>>"
    rows = [("f", 0, [("a", "O")], 1), ("f", 0, [("a", "O")], 1), ("f", 2, [("c", "O")], 1), ("f", 2, [("b", "O")], 2), ("g", 0, [], 1)]
    df = spark.createDataFrame(rows, f"source_file string, chunk_index int, tokens {t}, epoch int")
    totals = spark.createDataFrame([("f", 4), ("g", 1), ("h", 2)], "source_file string, total_chunks long")
    out = {r["source_file"]: r for r in requests.reassemble(df, totals, order="epoch").collect()}
    assert [x["token"] for x in out["f"]["tokens"]] == ["a", "b"] and out["f"]["missing"] == [1, 3]
    assert out["g"]["missing"] == [] and out["h"]["missing"] == [0, 1] and out["h"]["tokens"] is None
    plain = {r["source_file"]: r for r in requests.reassemble(df.drop("epoch")).collect()}
    assert plain["f"]["chunk_indexes"] == [0, 2] and [x["token"] for x in plain["f"]["tokens"]] == ["a", "c"]


def test_latest_streamed_result_wins(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    src.mkdir()
    for n, word in enumerate(["old", "new"]):
        body = {"choices": [{"message": {"content": f"{word}\tO"}}]}
        (src / f"{n}.json").write_text(json.dumps({"custom_id": "f__chunk_0", "response": {"status_code": 200, "body": body}}) + "\n")
        results.ingest_available(spark, str(src), str(out), str(ck))
    docs = results.reassemble_ingested(spark, str(out)).collect()
    assert [[t["token"] for t in d["tokens"]] for d in docs] == [["new"]]


def test_repair_until_clean_takes_as_many_passes_as_needed(spark):
    labels = ["X"] + [f"I-{i}" for i in range(14)]
    toks = spark.createDataFrame([("f", i + 1, "t", x) for i, x in enumerate(labels)], "file string, ord int, token string, label string")
    clean = bio.repair_until_clean(toks)
    assert bio.validate_tokens(clean).count() == 0 and clean.count() == 15


def test_validation_of_no_files(spark):
    none = spark.createDataFrame([], "file string, ord int, token string, label string")
    errors = bio.validate_tokens(none)
    summary = bio.validation_summary(bio.file_verdicts(none, errors)).first()
    assert (summary["total_files"], summary["total_errors"], summary["files_with_errors"]) == (0, 0, 0)


def test_error_types_are_sorted_by_frequency(spark):
    errors = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "error_type string")
    assert [r["error_type"] for r in bio.error_statistics(errors).collect()] == ["b", "a", "c"]


def test_unicode_spaces(spark):
    df = spark.createDataFrame([(" a b c\x1c",)], "t string")
    r = df.select(tx.word_count("t").alias("n"), tx.strip_ws("t").alias("s"), tx.words("t").alias("w"), tx.collapse_ws("t").alias("c")).first()
    assert (r["n"], r["s"], r["w"], r["c"]) == (3, "a b c", ["a", "b", "c"], "a b c")


def test_csv_quotes_are_doubled(spark, tmp_path):
    df = spark.createDataFrame([('he said "hi", ok\nnext', "train")], "t string, split string")
    writers.write_splits(df, str(tmp_path / "s"))
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "s") for f in fs if f.endswith(".csv")]
    rows = [r for f in files for r in csv.reader(open(f, newline=""))]
    assert ['he said "hi", ok\nnext'] in rows


def test_gated_union_stops_at_its_target(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    union, ran = collection.gated_union([("a", ids(1, 1, 2)), ("b", ids(2, 3)), ("c", ids(9))], 3)
    assert ran == ["a", "b"] and sorted((r["id"], r["strategy"], r["rank"]) for r in union.collect()) == [(1, "a", 0), (2, "a", 0), (3, "b", 1)]


def test_categories_of_repeated_and_unknown_headings(spark):
    tree = spark.createDataFrame([("u", "A01.1", 0), ("u", "B02", 0), ("v", "A01.2", 1)], "ui string, tree_number string, ord long")
    names = spark.createDataFrame([("A", "Anatomy"), ("B", "Organisms"), ("A01", "Body")], "code string, name string")
    terms = spark.createDataFrame([(1, "u"), (1, "u"), (1, "v"), (1, "zz"), (2, "zz")], "pmid long, ui string")
    out = {r["pmid"]: r for r in thesaurus.categories_per_article(terms, thesaurus.ui_categories(tree, names)).collect()}
    assert out[1]["level1_codes"] == ["A", "B"] and out[1]["level2_names"] == ["Body", "Unknown_B02"] and out[1]["major_subjects_count"] == 3
    assert out[2]["level1_codes"] == [] and out[2]["major_subjects_count"] == 1


def test_checkpoint_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(type("S", (), {"sparkContext": Context()})())


def test_corpus_is_written_by_year_with_statistics(spark, tmp_path):
    body = " ".join(["word"] * 60)

    def record(pmid, year):
        return (f"<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><Journal><JournalIssue><PubDate><Year>{year}</Year></PubDate></JournalIssue>"
                f"<Title>J{year}</Title></Journal><ArticleTitle>t</ArticleTitle><Abstract><AbstractText>{body}</AbstractText></Abstract></Article>"
                f'<MeshHeadingList><MeshHeading><DescriptorName UI="D1" MajorTopicYN="Y">x</DescriptorName></MeshHeading></MeshHeadingList>'
                "</MedlineCitation></PubmedArticle>")

    (tmp_path / "in.xml").write_text("<Set>" + record(1, 2001) + record(2, 2002) + record(2, 2002) + "</Set>")
    counters = corpus.collect_corpus(spark, str(tmp_path / "in.xml"), str(tmp_path / "out"), {"search_strategies": ["s"]})
    assert counters["final"] == 2 and counters["malformed"] == 0
    back = spark.read.parquet(str(tmp_path / "out" / "articles"))
    assert [r["pmid"] for r in back.where("year = 2002").collect()] == ["2"]
    assert sorted(d for d in os.listdir(tmp_path / "out" / "articles") if d.startswith("year=")) == ["year=2001", "year=2002"]
    stats = spark.read.json(str(tmp_path / "out" / "statistics")).first().asDict(True)
    assert stats["top_years"] == {"2001": 1, "2002": 1} and stats["top_journals"] == {"J2001": 1, "J2002": 1}
    assert stats["collection_stats"]["final"] == 2 and stats["avg_abstract_length"] == 60
    meta = spark.read.json(str(tmp_path / "out" / "metadata")).first()
    assert meta["total_articles"] == 2 and meta["search_strategies"] == ["s"]


def test_statistics_of_no_articles(spark):
    none = spark.createDataFrame([], "y int, j string, l string, w int, s boolean")
    r = profile.corpus_statistics(none, "y", "j", "l", word_count="w", structured="s").first()
    assert r["total_articles"] == 0 and r["top_years"] == {} and r["collection_stats"] == {}


def test_split_job_modes_and_info(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    rows = [("1", "Perros walked", 2000, "", "Anatomy; Body"), ("2", "Gatos", 2001, "uno walked", "Body")]
    df = spark.createDataFrame(rows, "pmid string, title string, year int, spanish_abstract string, level1_categories_str string")
    for c in ("level1_codes", "level1_names", "level2_codes", "level2_names", "level2_categories_str"):
        df = df.withColumn(c, F.lit(""))
    names = [f.split()[0] for f in corpus.CATEGORY_CSV_SCHEMA.split(", ")]
    writers.write_category_csv(df.withColumn("major_subjects_count", F.lit(1)).select(*names), path)
    for mode, want in (("basic", "perros walked"), ("stem", "perros walk")):
        out = tmp_path / mode
        assert sum(r["count"] for r in corpus.create_split(spark, path, str(out), mode=mode, stem_fn=strip_ed).collect()) == 2
        info = spark.read.json(str(out / "preprocessing_info")).first()
        assert info["text_processing_type"] == mode and info["processed_columns"] == ["title_processed", "spanish_abstract_processed"]
        table = spark.read.option("header", True).option("escape", '"').csv(str(out / "traditional"))
        assert want in {r["title_processed"] for r in table.collect()}
        assert {(r["category"], r["count"]) for r in spark.read.json(str(out / "traditional_info")).collect()} == {("Anatomy", 1), ("Body", 1)}
        assert spark.read.json(str(out / "text_profile")).count() == 2


def test_translation_outputs(spark, tmp_path):
    arts, _, _ = art.read_article_dataset(spark, os.path.join(FIX, "articles.json"))

    class Echo:
        def __call__(self, texts):
            return [t[::-1] for t in texts]

    info = corpus.translate_corpus(spark, arts, Echo, "echo", str(tmp_path / "out"))
    assert info["items"] == 7 and spark.read.parquet(str(tmp_path / "out" / "articles")).count() == arts.count()
    record = spark.read.json(str(tmp_path / "out" / "translation_info")).first()
    assert record["model_used"] == "echo" and {r["kind"]: r["total"] for r in record["translation_stats"]} == {"abstract": 3, "title": 4}
    assert record["items_per_minute"] > 0
    ids = arts.select("pmid")
    assert corpus.translate_corpus(spark, arts, Echo, "echo", str(tmp_path / "none"), done_abstracts=ids, done_titles=ids)["items"] == 0
    assert not os.path.exists(tmp_path / "none")
    with pytest.raises(ValueError):
        corpus.translate_dataset(spark, arts, Echo, "echo", titles_only=True, translate_titles=False)


def test_validation_report_holds_the_errors(spark, tmp_path):
    toks = spark.createDataFrame([("f", 1, 'a"b', "I-x"), ("f", 2, "c", "O"), ("g", 1, "d", "O")], "file string, ord int, token string, label string")
    errors = bio.validate_tokens(toks)
    writers.write_validation_report(bio.file_verdicts(toks, errors), errors, str(tmp_path))
    files = {r["file"]: r for r in spark.read.json(str(tmp_path / "files")).collect()}
    assert [e["line"] for e in files["f"]["errors"]] == [1] and files["g"]["errors"] is None and files["g"]["is_valid"]
    summary = spark.read.json(str(tmp_path / "summary")).first()
    assert summary["total_files"] == 2 and summary["error_type_distribution"]["ORPHAN_I_TAG"] == 1


def test_empty_article_input_is_an_error(spark):
    none = spark.createDataFrame([], "pmid string")
    with pytest.raises(ValueError, match="no articles in here"):
        art.require_articles(none, "here")
