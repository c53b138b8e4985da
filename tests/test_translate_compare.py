"""Translation with an injected function (K10-K12) and dataset comparison."""

from pyspark.sql import functions as F

from tessera.operators import compare, translate


class Upper:
    def __call__(self, texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("model failure")
        return [t.upper() for t in texts]


def test_translate_items_per_item_failures_and_order(spark):
    q = spark.createDataFrame([
        ("1", "abstract", "First one. Second one! Third?", None),
        ("2", "abstract", "Fine. But boom here.", None),
        ("3", "title", "a title", "[a title]."),
        ("4", "abstract", "   ", None),
    ], "id string, kind string, source_text string, original_title string")
    out = {r["id"]: r for r in translate.translate_items(q, "id", Upper).collect()}
    assert out["1"]["text"] == "FIRST ONE. SECOND ONE! THIRD?" and out["1"]["success"]
    assert not out["2"]["success"] and out["2"]["text"] == "" and "model failure" in out["2"]["error"]
    assert out["3"]["text"] == "A TITLE" and out["3"]["success"]
    assert out["4"]["text"] == "" and out["4"]["success"]
    summ = {r["kind"]: r for r in translate.translation_summary(spark.createDataFrame(list(out.values()))).collect()}
    assert summ["abstract"]["failed"] == 1 and summ["abstract"]["total"] == 3


def test_queue_skips_finished_work(spark):
    arts = spark.createDataFrame([
        ("1", "english", True, "Some text.", "[Title]."),
        ("2", "spanish", True, "Texto.", "   "),
        ("3", "mixed_or_unknown", True, "More text.", "()"),
    ], "id string, lang string, has boolean, abstract string, title string")
    done = spark.createDataFrame([("3",)], "id string")
    q = translate.translation_queue(arts, "id", F.col("abstract"), F.col("lang"), F.col("has"),
                                    title=F.col("title"), done_abstracts=done)
    got = sorted((r["id"], r["kind"], r["source_text"]) for r in q.collect())
    assert got == [("1", "abstract", "Some text."), ("1", "title", "Title")]


def test_compare(spark):
    a = spark.createDataFrame([(f"f{i}",) for i in range(30)], "name string")
    b = spark.createDataFrame([(f"f{i}",) for i in range(5, 40)], "name string")
    m = compare.membership(a, b)
    c = compare.completeness(m).first()
    assert (c["size_a"], c["size_b"], c["common"], c["only_a"], c["only_b"]) == (30, 35, 25, 5, 10)
    prev = compare.missing_preview(m, "only_b", n=3).collect()
    assert len(prev) == 6


def test_report_format(spark):
    from tessera.operators import profile

    df = spark.createDataFrame([(1234567, 12.345)], "n long, p double")
    r = profile.report_format(df, ["n"], ["p"]).first()
    assert r["n"] == "1,234,567" and r["p"] == "12.3"
