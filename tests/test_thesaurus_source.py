"""Thesaurus XML source (A3), reuse-or-build."""

import os

from tessera.sources import thesaurus as ts

FIX = os.path.join(os.path.dirname(__file__), "fixtures", "descriptors.xml")


def test_build_from_xml(spark):
    d, t, n = ts.build_thesaurus(ts.read_descriptor_records(spark, FIX))
    assert sorted(r["ui"] for r in d.collect()) == ["D1", "D2", "D3", "D4"]
    assert sorted((r["ui"], r["tree_number"]) for r in t.collect()) == [
        ("D1", "B01.050.150"), ("D1", "B01.060"), ("D2", "B01.050"), ("D3", "B01.050"), ("D5", "Y01.001")]
    names = {r["code"]: r["name"] for r in n.collect()}
    assert names["B01.050"] == "Mammals"          # first descriptor by source order
    assert names["B01.050.150"] == "Dogs"
    assert names["B01"] == "Organisms (B01)"
    assert names["Y01.001"] == "Category_Y (Y01.001)"  # D5 has no name
    assert names["B"] == "Organisms" and len([c for c in names if len(c) == 1]) == 16


def test_load_or_build(spark, tmp_path):
    out = str(tmp_path / "thes")
    assert ts.load_thesaurus(spark, out) is None
    d, t, n = ts.load_or_build_thesaurus(spark, FIX, out)
    assert n.count() > 16
    again = ts.load_or_build_thesaurus(spark, "/nonexistent.xml", out)
    assert again[2].count() == n.count()
