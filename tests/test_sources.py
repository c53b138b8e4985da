"""Sources: XML article records (A2, B1-B9), token files."""

import os

from pyspark.sql import functions as F

from tessera.sources import articles, tokens

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


def test_xml_records_extraction(spark):
    recs = articles.read_xml_records(spark, os.path.join(FIX, "articles.xml"))
    assert recs.count() == 4
    good, bad = articles.gate_records(recs)
    assert good.count() == 3 and bad.count() == 1
    arts = {r["pmid"]: r for r in articles.extract_articles(good).collect()}
    a = arts["1001"]
    assert a["title"] == "Dogs in the <city>"
    assert a["abstract"]["full_text"] == "BACKGROUND: Dogs live with people.\n\nRESULTS: We counted 2 dogs."
    assert a["abstract"]["structured"] and a["abstract"]["word_count"] == 10
    assert [s["label"] for s in a["abstract"]["sections"]] == ["BACKGROUND", "RESULTS"]
    assert a["journal"]["title"] == "Journal of Tests" and a["journal"]["issn"] == "1234-5678"
    assert [(x["last_name"], x["first_name"]) for x in a["authors"]] == [("Smith", "Ann"), (None, "Bo")]
    terms = a["mesh_terms"]
    assert terms[0]["descriptor"]["ui"] == "D004285" and terms[0]["descriptor"]["major_topic"]
    assert terms[0]["qualifiers"][0]["name"] == "physiology" and not terms[1]["descriptor"]["major_topic"]
    assert a["keywords"] == ["pets", "cities"]
    assert a["publication_info"]["year"] == "2005" and a["publication_info"]["month"] == "Oct"
    assert a["identifiers"] == {"pubmed": "1001", "doi": "10.1/xyz"}
    b = arts["1002"]
    assert b["abstract"]["sections"][0]["label"] == "Main" and not b["abstract"]["structured"]
    assert b["publication_info"]["year"] == "Spring 2004"
    assert arts["1004"]["abstract"]["has_content"] is False
    yr = articles.extract_articles(good).select(articles.publication_year(F.col("publication_info")).alias("y"))
    assert sorted([r["y"] for r in yr.collect()], key=str) == [2005, None, None]


def test_ingest_applies_quality_rules(spark):
    kept, extracted, bad = articles.ingest_xml(spark, os.path.join(FIX, "articles.xml"), min_words=5)
    assert [r["pmid"] for r in kept.collect()] == ["1001"]


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)


def test_token_files(spark, tmp_path):
    d = tmp_path / "tok"
    d.mkdir()
    _write(d / "a.nersuite", b"B-x\t0\t3\tDogs\n\nI-x\t4\t8\tbark\nno tab line\nO\t9\t10\t.\n")
    _write(d / "b.nersuite", "perro\tB-x\n\tgato\tO\ncaf\xe9\tO\n".encode("latin-1"))
    _write(d / "._a.nersuite", b"\x00\x05\x16\x07junk")
    _write(d / "PMC1.nersuite", b"x\tO\n")
    _write(d / "empty.nersuite", b"")
    _write(d / "mac.nersuite", b"Mac OS X        \tO\n")
    _write(d / "other.txt", b"x\tO\n")
    rows = tokens.read_token_files(spark, str(d)).orderBy("file", "ord").collect()
    got = [(r["file"], r["ord"], r["token"], r["label"]) for r in rows]
    assert got == [
        ("a.nersuite", 1, "Dogs", "B-x"), ("a.nersuite", 2, "bark", "I-x"), ("a.nersuite", 3, ".", "O"),
        ("b.nersuite", 1, "perro", "B-x"), ("b.nersuite", 2, "gato", "O"), ("b.nersuite", 3, "café", "O"),
    ]
    names = sorted(r["name"] for r in tokens.list_files(spark, str(d), ".nersuite").collect())
    assert names == ["PMC1.nersuite", "a.nersuite", "b.nersuite", "empty.nersuite", "mac.nersuite"]


def record(inner, article="", tail=""):
    return (f"<PubmedArticle><MedlineCitation><PMID>1</PMID><Article>{article}<Abstract>{inner}</Abstract></Article></MedlineCitation>"
            f"{tail}</PubmedArticle>")


def test_awkward_markup(spark):
    recs = [
        record('<AbstractText Label="AIM" NlmCategory="X"/><AbstractText Label="RESULTS">text b</AbstractText>'),
        record('<AbstractText Label="P > 0.05">text c</AbstractText><CopyrightInformation>(c)</CopyrightInformation>'),
        record("<AbstractText>a<![CDATA[<b>]]>c<!-- <i> -->d &#233;&lt;</AbstractText>", "<ArticleTitle>Foo <i>x</i> bar<b/></ArticleTitle>"),
        record("", "<Journal><Title/><ISSN a='/>'>1</ISSN></Journal><AuthorList><Author/><Author><LastName/></Author></AuthorList>"),
        None, "", "<PubmedArticle><PMID>2</PMID>", record("") + " junk",
    ]
    parsed = articles.parse_records(spark.createDataFrame([(x,) for x in recs], "xml string"))
    good, bad = articles.gate_records(parsed)
    assert good.count() == 4 and bad.count() == 4
    rows = [r["record"] for r in parsed.collect()]
    assert [[(s["label"], s["content"]) for s in r["sections"]] for r in rows[:4]] == [
        [("RESULTS", "text b")], [("P > 0.05", "text c")], [("", "a<b>cd é<")], []]
    assert rows[2]["title"] == "Foo x bar" and rows[3]["title"] == ""
    assert rows[3]["journal"].asDict() == {"title": None, "iso_abbreviation": None, "issn": "1"}
    assert [a.asDict() for a in rows[3]["authors"]] == [{"last_name": None, "first_name": None}]
    full = [r[0] for r in articles.extract_articles(good).select("abstract.full_text").collect()]
    assert full == ["RESULTS: text b", "P > 0.05: text c", "a<b>cd é<", ""]


def test_all_identifiers_on_request(spark):
    tail = ('<PubmedData><ArticleIdList><ArticleId IdType="doi">a</ArticleId><ArticleId IdType="doi">b</ArticleId><ArticleId>x</ArticleId>'
            '</ArticleIdList><ReferenceList><ArticleIdList><ArticleId IdType="doi">c</ArticleId></ArticleIdList></ReferenceList></PubmedData>')
    recs = spark.createDataFrame([(record("", tail=tail),)], "xml string")
    assert articles.extract_articles(recs).first()["identifiers"] == {"doi": "b"}
    assert articles.extract_articles(recs, article_ids_only=False).first()["identifiers"] == {"doi": "c"}


def test_texts_do_not_come_back_from_the_parser(spark):
    recs = spark.createDataFrame([(record("<AbstractText>one two</AbstractText>"),), ("<a",), (None,)], "xml string")
    out = articles.extract_articles(recs)
    assert [(r["pmid"], r["abstract"]["full_text"]) for r in out.collect()] == [("1", "one two")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    parser = next(x for x in plan.splitlines() if "MapInArrow" in x)
    assert "[record#" in parser
