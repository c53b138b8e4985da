"""One test per BIO rule (G1), repair (K13) and statistics."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import bio


def _tokens(spark, labels, file="f"):
    rows = [(file, i + 1, f"t{i + 1}", lab) for i, lab in enumerate(labels)]
    return spark.createDataFrame(rows, "file string, ord int, token string, label string")


def _errors(spark, labels):
    errs = bio.validate_tokens(_tokens(spark, labels)).orderBy("line_number", "rule").collect()
    return [(r["line_number"], r["error_type"], r["suggested_fix"]) for r in errs]


@pytest.mark.parametrize("labels,expected", [
    (["I-a"], [(1, "ORPHAN_I_TAG", "B-a")]),
    (["O", "I-a"], [(2, "ORPHAN_I_TAG", "B-a")]),
    (["B-a", "I-b"], [(2, "ENTITY_TYPE_MISMATCH", "B-b")]),
    (["I-a", "I-b"], [(1, "ORPHAN_I_TAG", "B-a"), (2, "ENTITY_TYPE_MISMATCH", "B-b")]),
    (["X"], [(1, "INVALID_LABEL_FORMAT", "O")]),
    (["X", "I-a"], [(1, "INVALID_LABEL_FORMAT", "O")]),
    (["B-"], [(1, "EMPTY_ENTITY_TYPE", "O")]),
    (["O", "I-"], [(2, "ORPHAN_I_TAG", "B-"), (2, "EMPTY_ENTITY_TYPE", "O")]),
    (["B-a", "I-a", "O"], []),
])
def test_rules(spark, labels, expected):
    assert _errors(spark, labels) == expected


def test_repair_last_fix_wins_and_single_pass(spark):
    toks = _tokens(spark, ["O", "I-", "X", "I-a"])
    errs = bio.validate_tokens(toks)
    fixed = bio.repair_labels(toks, errs).orderBy("ord").collect()
    # line 2: orphan (B-) then empty type (O): the last rule's fix wins
    assert [r["fixed_label"] for r in fixed] == ["O", "O", "O", "I-a"]
    # a single pass leaves the new orphan after the repaired "X"
    again = bio.validate_tokens(bio.repair_labels(toks, errs).select(
        "file", "ord", "token", F.col("fixed_label").alias("label")))
    assert again.count() == 1


def test_repair_until_clean_reaches_fixpoint(spark):
    toks = _tokens(spark, ["X", "I-a", "I-b", "B-", "O", "I-c"])
    clean = bio.repair_until_clean(toks)
    assert bio.validate_tokens(clean).count() == 0


def test_segmented_lag_equals_plain(spark):
    labels = ["B-a", "I-a", "O", "I-b", "X", "I-c", "B-d", "I-e"] * 7
    toks = _tokens(spark, labels)
    plain = sorted(tuple(r) for r in bio.validate_tokens(toks).collect())
    seg = sorted(tuple(r) for r in bio.validate_tokens(toks, segment=F.floor(F.col("ord") / 5)).collect())
    assert plain == seg and len(plain) > 0


def test_verdicts_and_stats(spark):
    toks = _tokens(spark, ["B-a", "I-a", "B-b", "O"], "good").unionByName(_tokens(spark, ["I-x", "B-x"], "bad"))
    errs = bio.validate_tokens(toks)
    v = {r["file"]: r for r in bio.file_verdicts(toks, errs).collect()}
    assert v["good"]["is_valid"] and v["good"]["total_lines"] == 4 and v["good"]["entity_counts"] == {"a": 1, "b": 1}
    assert not v["bad"]["is_valid"] and v["bad"]["total_errors"] == 1
    s = bio.validation_summary(bio.file_verdicts(toks, errs)).first()
    assert (s["total_files"], s["total_errors"], s["files_with_errors"]) == (2, 1, 1)


def test_top_errors_per_file(spark):
    toks = _tokens(spark, ["X"] * 25)
    top = bio.top_errors_per_file(bio.validate_tokens(toks), 10).collect()
    assert len(top) == 10 and all(r["more"] == 15 and r["file_errors"] == 25 for r in top)


def _py_errors(labels):
    """Sequential statement of the G1 rules (previous label only)."""
    out, prev = [], None
    for i, lab in enumerate(labels, 1):
        bi = lab.startswith("B-") or lab.startswith("I-")
        if lab != "O" and not bi:
            out.append((i, "INVALID_LABEL_FORMAT", "O"))
        else:
            t = lab[2:]
            if lab.startswith("I-"):
                if prev is None or prev == "O":
                    out.append((i, "ORPHAN_I_TAG", "B-" + t))
                elif (prev.startswith("B-") or prev.startswith("I-")) and prev[2:] != t:
                    out.append((i, "ENTITY_TYPE_MISMATCH", "B-" + t))
            if bi and t == "":
                out.append((i, "EMPTY_ENTITY_TYPE", "O"))
        prev = lab
    return out


def test_rules_random_against_loop(spark):
    import random

    rnd = random.Random(11)
    choices = ["O", "B-a", "I-a", "B-b", "I-b", "B-", "I-", "X", "b-a"]
    files = {f"f{k}": [rnd.choice(choices) for _ in range(rnd.randint(1, 40))] for k in range(60)}
    rows = [(f, i + 1, "t", lab) for f, labs in files.items() for i, lab in enumerate(labs)]
    toks = spark.createDataFrame(rows, "file string, ord int, token string, label string")
    got = {}
    for r in bio.validate_tokens(toks).orderBy("file", "line_number", "rule").collect():
        got.setdefault(r["file"], []).append((r["line_number"], r["error_type"], r["suggested_fix"]))
    for f, labs in files.items():
        assert got.get(f, []) == _py_errors(labs), f


def test_repair_in_row_equals_join(spark):
    from tessera.operators.ordered import positions_and_previous

    labels = ["O", "I-", "X", "I-a", "B-a", "I-b", "I-b", "B-", "I-c"] * 5
    rows = [("f", i + 1, "t", lab) for i, lab in enumerate(labels)]
    toks = spark.createDataFrame(rows, "file string, ord int, token string, label string")
    joined = bio.repair_labels(toks, bio.validate_tokens(toks)).select("ord", "fixed_label")
    with_prev = positions_and_previous(toks.drop("ord").withColumn("o", F.monotonically_increasing_id()),
                                       "file", ["o"], "label").drop("o")
    in_row = bio.repair_labels(with_prev).select("ord", "fixed_label")
    assert sorted(joined.collect()) == sorted(in_row.collect())
