"""Thesaurus hierarchy (F1-F3) and category labelling (F5-F7) on re-typed mini data."""

from pyspark.sql import functions as F

from tessera.operators import thesaurus as th

ARTICLE_SCHEMA = """pmid string, title_spanish_translation struct<translated_title:string, success:boolean>,
  publication_info struct<year:string>,
  abstract struct<spanish_translation:struct<text:string, success:boolean>>,
  mesh_terms array<struct<descriptor:struct<name:string, ui:string, major_topic:boolean>,
                          qualifiers:array<struct<name:string, ui:string, major_topic:boolean>>>>"""


def _term(ui, major, qual_major=False):
    return ({"name": ui, "ui": ui, "major_topic": major}, [{"name": "q", "ui": "Q1", "major_topic": qual_major}])


def _thesaurus(spark):
    descriptor = spark.createDataFrame(
        [("D004285", "Dogs"), ("D053580", "Muscle Strength"), ("D010809", "Physical Fitness"), ("D000001", "")],
        "ui string, name string")
    tree = spark.createDataFrame([
        ("D004285", "B01.050.150.900.649.313", 0),
        ("D053580", "E01.370.600.550", 1), ("D053580", "G11.427.410.698.500", 1),
        ("D010809", "G11.427.410.700", 2),
        ("D000001", "B01.050", 3),
    ], "ui string, tree_number string, ord long")
    return descriptor, tree




def test_tree_names_roots_exact_and_fallback(spark):
    d, t = _thesaurus(spark)
    names = {r["code"]: r["name"] for r in th.tree_names(d, t).collect()}
    assert names["B"] == "Organisms" and names["E"].startswith("Analytical")
    assert names["B01.050.150.900.649.313"] == "Dogs"
    # B01.050 has a descriptor with an empty name: not a match, so the fallback applies
    assert names["B01.050"] == "Organisms (B01.050)"
    assert names["G11"] == "Phenomena and Processes (G11)"
    # closure: every prefix of every tree number is named
    for tn in ["B01.050.150.900.649.313", "G11.427.410.698.500"]:
        parts = tn.split(".")
        for i in range(1, len(parts) + 1):
            assert ".".join(parts[:i]) in names


def test_first_descriptor_by_order_wins(spark):
    d = spark.createDataFrame([("U1", "First"), ("U2", "Second"), ("U0", None)], "ui string, name string")
    t = spark.createDataFrame([("U0", "Q01", 0), ("U2", "Q01", 2), ("U1", "Q01", 1)], "ui string, tree_number string, ord long")
    names = {r["code"]: r["name"] for r in th.tree_names(d, t).collect()}
    assert names["Q01"] == "First"
    t2 = spark.createDataFrame([("U2", "Q02.001", 2)], "ui string, tree_number string, ord long")
    names2 = {r["code"]: r["name"] for r in th.tree_names(d, t2).collect()}
    assert names2["Q02"] == "Category_Q (Q02)"


def test_label_articles_golden(spark):
    d, t = _thesaurus(spark)
    names = th.tree_names(d, t)
    arts = spark.createDataFrame([
        ("15745669", {"translated_title": "Perros", "success": True}, {"year": "2005"},
         {"spanish_translation": {"text": "texto", "success": True}},
         [_term("D004285", True), _term("D004285", True), _term("D999999", False)]),
        ("31516003", None, {"year": "2019"}, {"spanish_translation": {"text": "x", "success": False}},
         [_term("D053580", True), _term("D010809", True), _term("", True)]),
        ("32199067", None, {"year": "2020"}, None, [_term("D004285", False, qual_major=True)]),
        ("15199801", None, {"year": "2004"}, None, []),
    ], ARTICLE_SCHEMA)
    out = {r["pmid"]: r for r in th.label_articles(arts, t, names).collect()}
    a = out["15745669"]
    assert a["level1_codes"] == ["B"] and a["level2_codes"] == ["B01"] and a["major_subjects_count"] == 1
    assert a["title"] == "Perros" and a["spanish_abstract"] == "texto"
    b = out["31516003"]
    assert b["level1_codes"] == ["E", "G"] and b["level2_codes"] == ["E01", "G11"]
    assert b["major_subjects_count"] == 2 and b["spanish_abstract"] == "" and b["title"] == ""
    assert b["level1_categories_str"] == "Analytical, Diagnostic and Therapeutic Techniques and Equipment; Phenomena and Processes"
    for pmid in ["32199067", "15199801"]:
        assert out[pmid]["level1_codes"] == [] and out[pmid]["major_subjects_count"] == 0
        assert out[pmid]["level1_categories_str"] == ""


def test_unknown_code_name(spark):
    d = spark.createDataFrame([("U1", "x")], "ui string, name string")
    t = spark.createDataFrame([("U1", "A01.1", 0)], "ui string, tree_number string, ord long")
    empty_names = spark.createDataFrame([], "code string, name string")
    r = th.ui_categories(t, empty_names).first()
    assert [tuple(x) for x in r["l1"]] == [("A", "Unknown_A")] and [tuple(x) for x in r["l2"]] == [("A01", "Unknown_A01")]


def test_thesaurus_stats(spark):
    d, t = _thesaurus(spark)
    st = {r["metric"]: r["value"] for r in th.thesaurus_stats(d, t, th.tree_names(d, t)).collect()}
    assert st["total_terms"] == 4 and st["terms_with_tree_numbers"] == 4 and st["main_categories"] == 16
    assert st["exact_matches"] == 4
