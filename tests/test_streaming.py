"""Incremental result ingest: a second run only picks up newly landed files."""

import json

from tessera.streaming import results


def _result(cid, status, content):
    return json.dumps({"custom_id": cid, "response": {"status_code": status,
                                                      "body": {"choices": [{"message": {"content": content}}]}}})


def test_incremental_ingest(spark, tmp_path):
    landing, out, ckpt = tmp_path / "landing", tmp_path / "out", tmp_path / "ckpt"
    landing.mkdir()
    (landing / "r1.jsonl").write_text(_result("f__chunk_0", 200, "a\tO\nb\tB-x") + "\n" + _result("g__chunk_0", 500, ""))
    results.ingest_available(spark, str(landing), str(out), str(ckpt))
    docs = {r["source_file"]: r for r in results.reassemble_ingested(spark, str(out)).collect()}
    assert [t["token"] for t in docs["f"]["tokens"]] == ["a", "b"] and "g" not in docs
    (landing / "r2.jsonl").write_text(_result("f__chunk_1", 200, "c\tO") + "\n" + _result("g__chunk_0", 200, "z\tO"))
    results.ingest_available(spark, str(landing), str(out), str(ckpt))
    docs = {r["source_file"]: r for r in results.reassemble_ingested(spark, str(out)).collect()}
    assert [t["token"] for t in docs["f"]["tokens"]] == ["a", "b", "c"] and docs["g"]["chunk_indexes"] == [0]
    assert spark.read.parquet(str(out / "failed")).count() == 1
