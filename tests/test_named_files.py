"""Named text files: round trip, order, names, failed tasks and failed writes."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tessera.sinks import files as W
from tessera.sinks import writers
from tessera.sources import tokens as tk


def tree(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if not f.endswith(".crc"))


def test_round_trip_of_conversations(spark, tmp_path):
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    rows = conv.select(F.format_string("conv %05d é.txt", "conv_id").alias("file"), F.regexp_replace("text", "\n", " ").alias("line"), F.col("turn").alias("ord"))
    out = str(tmp_path / "out")
    W.write_named_files(rows.repartition(7), out)
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r["file"], r["ord"])):
        want.setdefault(r["file"], []).append(r["line"])
    assert tree(out) == sorted(want)
    for name, lines in want.items():
        with open(os.path.join(out, name), encoding="utf-8", newline="") as f:
            assert f.read() == "".join(x + "\n" for x in lines)


def test_modes_and_files_without_lines(spark, tmp_path):
    out, of = str(tmp_path / "out"), lambda *rows: spark.createDataFrame(list(rows), "file string, ord int, line string")
    W.write_named_files(of(("a", 1, "1"), ("b", 1, None)), out)
    assert tree(out) == ["a", "b"] and os.path.getsize(f"{out}/b") == 0
    W.write_named_files(of(("b", 2, "y"), ("b", 1, "x"), ("c", 1, "z")), out, mode="append")
    assert tree(out) == ["a", "b", "c"] and open(f"{out}/b").read() == "x\ny\n"
    W.write_named_files(of(("d", 1, "only")), out)
    assert tree(out) == ["d"]
    W.write_named_files(of(), out)
    assert tree(out) == []


def test_a_failed_attempt_leaves_nothing(tmp_path, spark):
    out = str(tmp_path / "out")
    writer = W.NamedFilesWriter(out, True)
    first = os.path.join(writer.hidden, "0-77")
    os.makedirs(first)  # what an attempt that was killed left behind
    open(os.path.join(first, "half"), "w").write("half a")
    second = os.path.join(writer.hidden, "0-78")
    os.makedirs(second)
    open(os.path.join(second, "half"), "w").write("half a file\n")
    assert [f for f in tree(out) if not f.startswith("_writing-")] == []  # nothing to be seen before the commit
    writer.commit([W.Written("0-78", ["half"]), None])
    assert tree(out) == ["half"] and open(f"{out}/half").read() == "half a file\n" and not os.path.exists(writer.hidden)


def test_a_failed_write_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    W.write_named_files(spark.createDataFrame([("a", 1, "old")], "file string, ord int, line string"), out)
    bad = spark.range(100).select(F.concat(F.lit("f"), F.col("id") % 5).alias("file"), F.col("id").alias("ord"), F.expr("IF(id = 77, raise_error('killed'), 'x')").alias("line"))
    with pytest.raises(Exception, match="killed"):
        W.write_named_files(bad, out)
    with pytest.raises(Exception, match="no file name"):
        W.write_named_files(spark.createDataFrame([("../a", 1, "x")], "file string, ord int, line string"), out)
    assert tree(out) == ["a"] and open(f"{out}/a").read() == "old\n" and os.listdir(out) == ["a"]


def test_token_files_are_read_back_by_the_jobs_own_reader(spark, tmp_path):
    out = str(tmp_path / "tokens")
    toks = spark.createDataFrame([(f"f{i % 3}.nersuite", i, f"tok{i}", "O") for i in range(1, 31)], "file string, ord int, token string, label string")
    writers.write_token_files(toks, out)
    assert tree(out) == ["f0.nersuite", "f1.nersuite", "f2.nersuite"]
    back = tk.read_token_files(spark, out)
    assert [(r["file"], r["token"]) for r in back.orderBy("file", "ord").collect()] == [(r["file"], r["token"]) for r in toks.orderBy("file", "ord").collect()]


def test_a_file_of_many_lines_is_the_work_of_several_tasks(spark, tmp_path, monkeypatch):
    out, tasks = str(tmp_path / "out"), []
    rows = spark.range(4000).select(F.when(F.col("id") < 3900, "big").otherwise(F.concat(F.lit("f"), F.col("id") % 7)).alias("file"), F.col("id").alias("ord"),
                                    F.concat(F.lit("línea "), "id").alias("line"))
    real = W.join_parts

    def joined(session, path, hidden, overwrite):
        with open(f"{path}/{hidden}/{W.PLAN}") as f:
            tasks.append(W.json.loads(f.read())["split"])
        real(session, path, hidden, overwrite)

    monkeypatch.setattr(W, "join_parts", joined)
    W.write_named_files(rows.orderBy(F.rand(3)), out)
    assert len(tasks[0]["big"]) >= 4
    assert sorted(os.listdir(out)) == ["big", *[f"f{i}" for i in range(7)]]
    for name in os.listdir(out):
        with open(f"{out}/{name}", encoding="utf-8") as f:
            ids = [int(x.split()[1]) for x in f]
        assert ids == (list(range(3900)) if name == "big" else [i for i in range(3900, 4000) if f"f{i % 7}" == name])


def test_names_without_lines_are_dealt_to_several_tasks(spark, tmp_path, monkeypatch):
    out, deals = str(tmp_path / "out"), []
    real = W.join_parts

    def joined(session, path, hidden, overwrite):
        deals.append(len(os.listdir(f"{path}/{hidden}")) if os.path.isdir(f"{path}/{hidden}") else 0)
        real(session, path, hidden, overwrite)

    monkeypatch.setattr(W, "join_parts", joined)
    names = spark.range(3000).select(F.format_string("n%05d", "id").alias("file"), F.lit(0).alias("ord"), F.lit(None).cast("string").alias("line"))
    last = spark.createDataFrame([("z", i, "x") for i in range(1200)], "file string, ord int, line string")  # its parts keep the hidden folder until the end
    W.write_named_files(names.unionByName(last), out)
    assert len(os.listdir(out)) == 3001 and deals[0] > 4
    with open(f"{out}/z") as f:
        assert f.read() == "x\n" * 1200


def test_lines_of_a_name_in_tasks_apart_are_refused(tmp_path):
    assert W.split_names([W.Written("0-1", ["a", "b"]), W.Written("1-2", ["b"]), W.Written("2-3", ["b", "c"])]) == {"b": ["0-1", "1-2", "2-3"]}
    assert W.split_names([W.Written("0-1", ["a", "b"]), W.Written("1-2", ["c"]), W.Written("2-3", ["b"])]) is None
    assert W.split_names([W.Written("0-1", ["a", "b"]), W.Written("1-2", ["b", "a"])]) is None


def test_listing_meets_nested_and_empty_files_and_no_hidden_ones(spark, tmp_path):
    for n in ("a.x", "sub/b.x", "c d+%41.x", "_h.x", ".i.x", "_w/j.x", "k.y"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"")
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        assert sorted(r["name"] for r in tk.list_files(spark, path, ".x").collect()) == ["a.x", "b.x", "c d+%41.x"]
