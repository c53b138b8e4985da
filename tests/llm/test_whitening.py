"""Whitening against numpy's own eigenvectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def spread(name, rng):
    x = rng.normal(size=(400, 12))
    return {
        "alike": x,
        "graded": x * 10.0 ** -np.arange(12),
        "steep the other way": x * 10.0 ** np.arange(-11, 1),
        "twice the same": np.hstack([x, x]),
        "with zeros": np.hstack([x, np.zeros((400, 3))]),
        "equal eigenvalues": np.vstack([np.eye(10), -np.eye(10)]),
        "two of each": np.vstack([np.eye(10), -np.eye(10)]) * np.repeat([5, 4, 3, 2, 1], 2),
        "fewer rows": x[:5],
        "nearly equal": np.vstack([np.eye(10), -np.eye(10)]) @ np.linalg.qr(rng.normal(size=(10, 10)))[0] * (1 + 1e-9 * rng.normal(size=10)),
        "one dimension": x[:, :1],
        "wide": rng.normal(size=(300, 150)),
    }[name]


@pytest.mark.parametrize("name", ["alike", "graded", "steep the other way", "twice the same", "with zeros", "equal eigenvalues", "two of each",
                                  "fewer rows", "nearly equal", "one dimension", "wide"])
def test_axes(name):
    x = spread(name, np.random.default_rng(7))
    x = x - x.mean(axis=0)
    n = len(x)
    values, axes, trace = W.principal_axes(W.triangle(x), n, 8)
    v = x.T @ x / n
    want = np.linalg.svd(x, compute_uv=False) ** 2 / n
    assert len(values) == min(8, np.linalg.matrix_rank(x))
    assert np.allclose(values, want[:len(values)], rtol=1e-12, atol=0) and math.isclose(trace, np.trace(v), rel_tol=1e-12)
    assert np.abs(v @ axes - axes * values).max() <= 1e-13 * values[0]
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12


def test_small_singular_values_keep_their_digits():
    # a graded bidiagonal matrix, for which plain eigenvalues of b'b lose every digit of the last ones
    b, above = 10.0 ** -np.arange(0.0, 16, 2), 10.0 ** -np.arange(1.0, 15, 2)
    got = W.squared_singular_values(b, above)
    assert math.isclose(float(np.prod(got)), float(np.prod(b)) ** 2, rel_tol=1e-12) and (np.diff(got) < 0).all()


def test_parts_reduce_to_one_triangle(spark):
    x = np.random.default_rng(2).normal(size=(300, 6)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA).repartition(40)
    n, sums = W.exact_sums(df, "embedding")
    whole = np.floor(1024 * x.astype(float)).astype(int) + 100_000
    assert n == 300 and (sums == whole.sum(axis=0)).all()
    r = W.reduced_triangle(df, "embedding", n, sums)
    c = whole - whole.mean(axis=0)
    assert np.allclose(r.T @ r, c.T @ c, rtol=1e-10) and np.allclose(r, np.triu(r))


def test_rows(spark):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(500, 10)) * np.arange(1, 11)).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(3, x[3].tolist(), 1), (None, x[9].tolist(), None)]
    good = rows[:]
    rows += [(900, None, 1), (901, [], 1), (902, [float("nan")] * 10, 1), (903, [1.0] * 9 + [None], 1), (904, [float("-inf")] + [0.0] * 9, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("component", "n", "whitened", "explained", "d", "node")})
    got = W.whiten(df.repartition(5)).collect()
    whole = np.floor(1024 * np.array([r[1] for r in good], dtype=float)).astype(int) + 100_000
    n, s = len(whole), whole.sum(axis=0)
    v = np.cov(whole.T, bias=True)
    want, vectors = np.linalg.eigh(v)
    want, vectors = want[::-1], vectors[:, ::-1]
    z = (whole - s / n) @ vectors / np.sqrt(want)
    assert len(got) == 8 * n and {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-10
    told = sorted((str(i), int(d)) for (i, *_), d in zip(good, ((n * whole - s) ** 2).sum(axis=1)))
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in got if r["component"] == 1) == told
    for c in range(1, 9):
        mine = {r["vec_id"]: r["whitened"] for r in got if r["component"] == c}
        sign = math.copysign(1, mine[0] * z[0, c - 1])
        assert all(abs(mine[i] - sign * z[k, c - 1]) < 1e-8 for k, (i, *_) in enumerate(good))
        assert all(math.isclose(r["explained"], want[c - 1] / want.sum(), rel_tol=1e-10) for r in got if r["component"] == c)


def test_tables_without_spread(spark):
    of = lambda rows: W.whiten(spark.createDataFrame(rows, SCHEMA))
    columns = of([]).columns
    assert columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None, 1), (2, [], 1)], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 5):
        assert of(rows).collect() == [] and of(rows).columns == columns
    with pytest.raises(ValueError, match="several lengths"):
        of([(1, [1.0, 2.0], 1), (2, [1.0], 1)])


def test_deviations_beyond_float_and_long():
    sums = np.array([3, 5])
    assert W.deviations(np.array([[3_000_000_000, 1]]), 1, sums)[0] == (3_000_000_000 - 3) ** 2 + 16
    with pytest.raises(OverflowError):
        W.deviations(np.array([[2**40, 1]]), 1, sums)
