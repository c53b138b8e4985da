"""Links of operator 1 by degree: pairs beside a dense group, copies, the audit and the exact way out."""

import numpy as np
import pytest

from tessera.llm import vector_graph as G

SCHEMA = "vec_id long, embedding array<float>, label int"


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def mixed(pairs=600, group=300, single=1200, d=48, seed=3):
    """Vectors of links far apart, of one dense group, and of none."""
    rng = np.random.default_rng(seed)
    a, other = unit(rng.normal(size=(pairs, d))), unit(rng.normal(size=(pairs, d)))
    other = unit(other - (other * a).sum(axis=1, keepdims=True) * a)
    c = rng.uniform(0.935, 0.96, size=(pairs, 1))
    near = unit(unit(rng.normal(size=d)) + 0.002 * rng.normal(size=(group, d)))
    x = np.vstack([a, c * a + np.sqrt(1 - c * c) * other, near, unit(rng.normal(size=(single, d)))])
    return x.astype(np.float32)


def truth(x):
    y = unit(x.astype(np.float64))
    near = y @ y.T >= G.THRESHOLD
    return near.sum(axis=1) - 1


def test_pairs_are_found_beside_a_dense_group(spark):
    x = mixed()
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], SCHEMA).repartition(4)
    got = {r["vec_id"]: r for r in G.near_duplicates(df, max_shard=400).collect()}
    want = truth(x)
    of = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (of <= want).all() and (of[1200:1500] == 299).all()
    assert (of[:1200] == want[:1200]).mean() >= 0.98
    for i in range(600):
        if of[i]:
            assert got[i]["kept"] and got[i + 600]["component_id"] == i


def test_recall_of_the_audit_is_that_of_the_worst_kind_of_vector(spark):
    x = mixed(pairs=60, group=200, single=0)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], SCHEMA)
    alone = G.distinct_vectors(G.unit_vectors(df, "vec_id", "embedding", "label"))
    whole = alone.selectExpr("row", "space AS shard", "m", "v")
    counted = G.link_counts(G.compare_blocks(whole, G.homes_of(whole), G.THRESHOLD, block=50))
    assert G.audit(alone, counted, G.THRESHOLD) == 1.0
    lost = counted.filter("n_near > 1")  # all pairs are lost: 120 of some 40,000 links
    assert G.audit(alone, lost, G.THRESHOLD) == 0.0
    assert G.audit(alone, counted.limit(0), G.THRESHOLD) == 0.0


@pytest.mark.parametrize("max_overlap", [0, 5])  # 0: all vectors are compared, exactly
def test_equal_vectors_are_one_with_a_count(spark, max_overlap):
    x = mixed(pairs=40, group=30, single=50)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(1000 + k, x[0].tolist(), 1) for k in range(500)] + [(None, x[80].tolist(), 1), (2000, x[0].tolist(), 2), (2001, x[0].tolist(), None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert G.distinct_vectors(G.unit_vectors(df, "vec_id", "embedding", "label")).count() == len(x) + 1
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in G.near_duplicates(df, max_shard=60, max_overlap=max_overlap).collect()}
    assert got[0] == (501, 0, True) and got[40] == (501, 0, False) and got[1499] == (501, 0, False)
    assert got[80] == (30, 80, True) and got[None] == (30, 80, False) and got[85] == (30, 80, False)
    assert got[2000] == (0, 2000, True) and got[2001] == (0, 2001, True)


def test_a_link_of_several_shards_counts_once():
    import pandas as pd

    homes = pd.Series([[5, 9], [9, 5], [9], [5, 7, 9]])
    later = G._Elsewhere(9, homes)
    assert later.without(0, np.array([1, 2, 3])).tolist() == [2] and later.without(2, np.array([0, 1, 3])).tolist() == [0, 1, 3]
    assert G._Elsewhere(5, homes).without(0, np.array([1, 3])).tolist() == [1, 3]


def test_vectors_of_a_shard_are_searched_side_by_side():
    import sys

    import pandas as pd

    x = unit(mixed(pairs=150, group=100, single=200).astype(np.float64))
    n, calls = len(x), 0
    rows = pd.DataFrame({"row": np.arange(n) * 3, "shard": "a", "m": 1, "v": list(x)})

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "c_call"

    sys.setprofile(count)
    try:
        lists = G._graph(24, 1.2)(rows)
        rows = rows.merge(lists[["row", "near"]], on="row").assign(id=5, homes=[[5]] * n)
        rows["near"] = [np.append(a, 10 ** 9) for a in rows["near"]]  # a row of another shard
        found = G._search(G.THRESHOLD, 24, 0.1)(rows)
    finally:
        sys.setprofile(None)
    assert calls < 60 * n  # vector by vector some 350 for each
    of = found[found["other"].isna()].set_index("row")["n_near"].reindex(rows["row"]).fillna(0).to_numpy()
    assert (of == truth(x)).all()
    assert sorted(found["other"].dropna().unique()) == sorted({0, *range(3, 450, 3), 900}) and found["other"].notna().sum() == 150 + 99


def test_the_length_of_a_vector_is_not_made_for_every_component(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0], 1), (2, [0.0, 0.0], 1), (3, None, 1), (4, [1.0, float("nan")], 1)], SCHEMA)
    seen = []
    stage, G.stage = G.stage, lambda d, name: (seen.append(d), stage(d, name))[1]
    try:
        got = {r["vec_id"]: r["v"] for r in G.unit_vectors(df, "vec_id", "embedding", "label").collect()}
    finally:
        G.stage = stage
    assert got == {1: [0.6, 0.8], 2: None, 3: None, 4: None}
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "/ lambda" in plan and "/ SQRT(" not in plan
