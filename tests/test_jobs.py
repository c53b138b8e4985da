"""End-to-end batch jobs on small fixtures written to a scratch folder."""

import json
import os

from pyspark.sql import functions as F

from tessera.jobs import corpus
from tessera.sources import articles as art

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


def test_label_dataset_and_split(spark, tmp_path):
    out_csv = str(tmp_path / "categories.csv")
    cov = corpus.label_dataset(spark, os.path.join(FIX, "articles.json"), os.path.join(FIX, "thesaurus_small.xml"),
                               str(tmp_path / "thes"), out_csv).first()
    assert cov["total_articles"] == 4 and cov["articles_with_categories"] == 2
    rows = {r["pmid"]: r for r in spark.read.option("header", True).option("escape", '"').csv(out_csv).collect()}
    assert rows["31516003"]["level1_codes"] == '["E","G"]' and rows["31516003"]["major_subjects_count"] == "2"
    assert rows["15745669"]["spanish_abstract"] == "Perros" and rows["32199067"]["level1_categories_str"] is None
    sizes = {r["split"]: r["count"] for r in corpus.create_split(spark, out_csv, str(tmp_path / "splits")).collect()}
    assert sum(sizes.values()) == 2


def test_translate_dataset(spark):
    arts, _, _ = art.read_article_dataset(spark, os.path.join(FIX, "articles.json"))

    class Echo:
        def __call__(self, texts):
            return [t[::-1] for t in texts]

    out, summary = corpus.translate_dataset(spark, arts, Echo, "echo")
    res = {r["pmid"]: r for r in out.collect()}
    assert res["15745669"]["abstract"]["spanish_translation"]["text"] == "Perros"  # already done: kept
    assert res["31516003"]["abstract"]["spanish_translation"]["success"]
    assert res["15745669"]["title_spanish_translation"]["cleaned_title"] == "Dogs and owners"
    kinds = {r["kind"]: r["total"] for r in summary.collect()}
    assert kinds == {"abstract": 3, "title": 4}


def test_token_round_trip(spark, tmp_path):
    tok = tmp_path / "tok"
    tok.mkdir()
    lines = []
    for i in range(130):
        lab = "B-x" if i % 10 == 0 else ("I-y" if i % 17 == 0 else "O")
        lines.append(f"{lab}\t0\t0\t{'.' if i % 25 == 24 else 'w' + str(i)}")
    (tok / "doc1.nersuite").write_text("\n".join(lines) + "\n")
    (tok / "doc2.nersuite").write_text("I-a\t0\t0\tx\nO\t0\t0\ty\n")
    summary = corpus.validate_directory(spark, str(tok), str(tmp_path / "report"), str(tmp_path / "fixed")).first()
    assert summary["total_files"] == 2 and summary["total_errors"] > 0
    info = corpus.make_requests(spark, str(tok), str(tmp_path / "out"), "m", max_lines=40, batch_size=2)
    assert sum(r["chunks"] for r in info.collect()) >= 4
    reqs = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out" / "requests")).collect()]
    results = []
    for k, rq in enumerate(reqs):
        body = rq["body"]["messages"][1]["content"]
        start, end = body.index("INPUT:\n") + 7, body.index("\n\nOUTPUT:")
        content = body[start:end].split("\nNOTE:")[0]
        status = 500 if rq["custom_id"] == "doc2.nersuite__chunk_0" else 200
        results.append({"custom_id": rq["custom_id"], "response": {"status_code": status, "body": {
            "choices": [{"message": {"content": content.upper()}}]}}})
    res_path = tmp_path / "results.jsonl"
    res_path.write_text("\n".join(json.dumps(r) for r in reversed(results)))
    cov = {r["source_file"]: r for r in corpus.ingest_results(
        spark, str(res_path), str(tmp_path / "out" / "requests"), str(tmp_path / "in")).collect()}
    assert cov["doc1.nersuite"]["tokens"] == 130 and "doc2.nersuite" not in cov
    retry = spark.read.text(str(tmp_path / "in" / "retry_requests")).collect()
    assert len(retry) == 1 and "doc2.nersuite__chunk_0" in retry[0]["value"]
    assert len((tmp_path / "in" / "translated" / "doc1.nersuite").read_text().splitlines()) == 130
    infos = sorted(p.name for p in (tmp_path / "out" / "batch_info").iterdir() if p.suffix == ".json")
    corpus.make_requests(spark, str(tok), str(tmp_path / "out"), "m", max_lines=40, batch_size=2)
    assert sorted(p.name for p in (tmp_path / "out" / "batch_info").iterdir() if p.suffix == ".json") == infos == [f"batch_info_{i:05d}.json" for i in range(len(infos))]


def test_compare_datasets(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir()
    b.mkdir()
    for n in ["x.nersuite", "y.nersuite", ".hidden", "Thumbs.db"]:
        (a / n).write_text("1")
    for n in ["y.nersuite", "z.nersuite"]:
        (b / n).write_text("1")
    c = corpus.compare_datasets(spark, str(a), str(b), str(tmp_path / "cmp")).first()
    assert (c["size_a"], c["size_b"], c["common"], c["only_a"], c["only_b"]) == (2, 2, 1, 1, 1)


def test_collect_corpus(spark, tmp_path):
    out = str(tmp_path / "corpus")
    counters = corpus.collect_corpus(spark, os.path.join(FIX, "articles.xml"), out)
    assert counters["total"] == 3 and counters["malformed"] == 1
    assert counters["dropped_no_abstract"] == 1 and counters["final"] == 0  # fixture abstracts are short
    stats = spark.read.json(os.path.join(out, "statistics")).first()
    assert stats["total_articles"] == 0
    assert spark.read.parquet(os.path.join(out, "articles")).count() == 0


def test_validation_makes_the_errors_of_a_report_once(spark, tmp_path, monkeypatch):
    from tessera.operators import bio
    from tessera.sinks import writers

    tok = tmp_path / "tok"
    tok.mkdir()
    for i in range(200):
        (tok / f"d{i}.nersuite").write_text(f"I-a\t0\t0\tx\nX\t0\t0\ty\nI-b\t0\t0\tz{i}\nB-\t0\t0\t.\n")
    plans, parts, write = [], [], writers.write_validation_report

    def told(verdicts, errors, out_dir):
        plans.extend(d._jdf.queryExecution().optimizedPlan().toString() for d in (verdicts, errors))
        parts.append(errors.rdd.getNumPartitions())
        write(verdicts, errors, out_dir)

    monkeypatch.setattr(writers, "write_validation_report", told)
    summary = corpus.validate_directory(spark, str(tok), str(tmp_path / "report"), str(tmp_path / "fixed")).first()
    assert tuple(summary) == (200, 600, 200)
    assert len(plans) == 4 and not any(node in p for p in plans for node in ("Window", "Generate", "Aggregate"))
    assert max(parts) <= 16
    files = {r["file"]: r for r in spark.read.json(str(tmp_path / "report" / "files")).collect()}
    assert len(files) == 200 and [(e["line"], e["type"]) for e in files["d7.nersuite"]["errors"]] == [
        (1, "ORPHAN_I_TAG"), (2, "INVALID_LABEL_FORMAT"), (4, "EMPTY_ENTITY_TYPE")]
    again = {r["file"]: (r["total_lines"], r["total_errors"]) for r in spark.read.json(str(tmp_path / "report" / "after_fix" / "files")).collect()}
    assert set(again.values()) == {(4, 1)}  # the line after the one that had no BIO label
    assert (tmp_path / "fixed" / "d7.nersuite").read_text().splitlines() == ["x\tB-a", "y\tO", "z7\tI-b", ".\tO"]
    assert bio.validate_tokens(bio.repair_until_clean(tokens_of(spark, tmp_path / "fixed"))).count() == 0


def tokens_of(spark, folder):
    from tessera.sources import tokens as tk

    return tk.read_token_files(spark, str(folder))


def test_small_token_files_share_tasks(spark, tmp_path):
    from tessera.sources import tokens as tk

    for i in range(700):  # 32 of them to a task by their least size
        (tmp_path / f"d{i}.nersuite").write_text(f"B-a\t0\t0\tx{i}\n")
    read = tk.read_token_files(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() <= max(8, 4 * spark.sparkContext.defaultParallelism) < 700 / 32
    assert read.count() == 700 and read.select("file").distinct().count() == 700
