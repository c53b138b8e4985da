"""Stateful reassembly: shuffled landings, restarts, redeliveries, late files."""

import json
import time

from tessera.streaming import reassembly as R
from tessera.streaming.results import result_stream


def line(file, index, content, status=200):
    return json.dumps({"custom_id": f"{file}__chunk_{index}", "response": {
        "status_code": status, "body": {"choices": [{"message": {"content": content}}]}}})


def land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.jsonl").write_text("\n".join(lines) + "\n")


def test_files_go_out_once_when_their_last_chunk_arrives(spark, tmp_path):
    landing, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    totals = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2), ("none", 4)], "source_file string, total_chunks long")

    def run(timeout_ms=10**9):
        R.ingest_files(result_stream(spark, str(landing), 1), totals, out, ckpt, timeout_ms)
        return {r["source_file"]: r for r in R.complete_files(spark.read.parquet(out)).collect()}, spark.read.parquet(out)

    land(landing, "1", line("a", 2, "x\tO"), line("b", 0, "y\tB-q\nz\tI-q"), line("c", 0, "fail", 500), line("d", 0, "unknown\tO"))
    done, _ = run()
    assert set(done) == {"b"} and [t["token"] for t in done["b"]["tokens"]] == ["y", "z"]

    land(landing, "2", line("a", 0, "u\tO"), line("b", 0, "again\tO"), line("c", 1, "w\tO"), line("a", 0, "v\tO"))
    done, _ = run()  # another query on the same checkpoint: a restart
    assert set(done) == {"b"}

    land(landing, "3", line("a", 1, None))
    done, files = run()
    assert set(done) == {"a", "b"} and [t["token"] for t in done["a"]["tokens"]] == ["v", "x"] and done["a"]["chunk_indexes"] == [0, 1, 2]
    assert files.count() == 2 and [t["token"] for t in done["b"]["tokens"]] == ["y", "z"]

    run()  # nothing has landed
    assert spark.read.parquet(out).count() == 2


def test_late_files_are_reported_and_can_still_be_completed(spark, tmp_path):
    landing, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    totals = spark.createDataFrame([("a", 3), ("b", 2)], "source_file string, total_chunks long")

    def run():
        R.ingest_files(result_stream(spark, str(landing), 1), totals, out, ckpt, 500)
        return spark.read.parquet(out)

    land(landing, "1", line("a", 1, "m\tO"), line("b", 1, "n\tO"))
    run()
    time.sleep(1)
    land(landing, "2", line("b", 0, "k\tO"))  # any later batch lets timers run out
    files = run()
    late = sorted(map(tuple, R.late_chunks(files).collect()))
    assert late == [("a", 0), ("a", 2)]
    land(landing, "3", *(line(f, i, f"{i}\tO") for f, i in late))
    files = run()
    assert sorted(r["source_file"] for r in R.complete_files(files).collect()) == ["a", "b"] and R.late_chunks(files).count() == 0
    tokens = {r["source_file"]: [t["token"] for t in r["tokens"]] for r in R.complete_files(files).collect()}
    assert tokens == {"a": ["0", "m", "2"], "b": ["k", "n"]}
