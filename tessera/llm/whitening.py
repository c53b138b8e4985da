"""Embedding whitening by a bidiagonal qd solver (operator 11).

Vectors become whole numbers, so their sums are exact.  Every task reduces its
centred rows, block by block, to a triangle R (QR); triangles of several tasks
are stacked and reduced again until one is left, whose size is that of one
vector squared however many rows there are.  The covariance is never formed:
its eigenvalues are the squares of R's singular values.

R is made bidiagonal by Householder reflections.  dqds finds the squares of
the singular values to high relative accuracy.  A direction comes from the
twisted factorisation of B'B - e: a stationary transform from the top and a
progressive one from the bottom meet at the row where the remainder is least,
and two products of quotients lead away from it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import stage

# --- fixed values: how an entry becomes a whole number ----------------------------
SCALE, SHIFT = 1024, 100_000

COMPONENTS = 8
#: Triangles reduced together.
FAN_IN = 16
EPS = float(np.finfo(np.float64).eps)
#: Squares of couplings below this share of their neighbours are nil.
NEGLIGIBLE = (4 * EPS) ** 2
#: Eigenvalues nearer than this to a neighbour, relative to it, need their
#: directions made orthogonal.
CLOSE = 1e-3


# ------------------------------------------------------------------ rows of a task
def whole_numbers(column: pa.Array) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Places of the usable vectors of an Arrow list column, and by length the
    whole numbers of those vectors in the same order.  Unusable are null and
    empty vectors and those with a null or non-finite entry."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths().fill_null(0))
    flat = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan))
    ends = np.cumsum(sizes)
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    usable = np.flatnonzero((sizes > 0) & (wrong[ends] == wrong[ends - sizes]))
    out = {}
    for d in np.unique(sizes[usable]):
        at = usable[sizes[usable] == d]
        x = np.floor(SCALE * flat[(ends - sizes)[at][:, None] + np.arange(d)])
        if np.abs(x).max() > 2**52:
            raise ValueError(f"entries beyond {2**52 // SCALE} are no exact whole numbers here")
        out[int(d)] = x.astype(np.int64) + SHIFT
    return usable, out


def triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR of ``rows``, square."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over dimensions of ``(n * x - sums) ** 2``, exact."""
    widest = max(int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max(initial=0)), 1)
    if widest * widest * x.shape[1] < 2**63:
        return ((n * x - sums) ** 2).sum(axis=1)
    off = n * x.astype(object) - sums.astype(object)
    out = (off * off).sum(axis=1)
    if max(out, default=0) >= 2**63:
        raise OverflowError("a deviation does not fit a long")
    return out.astype(np.int64)


# ------------------------------------------------------------------ solver
def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor ``p`` of ``r = u b p'``, by
    Householder reflections from the left and the right in turn."""
    a, n = r.copy(), len(r)
    p = np.eye(n)

    def reflector(x):
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        norm = np.linalg.norm(v)
        return v / norm if norm else v

    for k in range(n - 1):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        w = reflector(a[k, k + 1:])
        a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
        p[:, k + 1:] -= 2 * np.outer(p[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd transform with ``shift``; None if the shift was too
    large to keep all quotients positive."""
    q_new, e_new = [], []
    d = q[0] - shift
    for k, x in enumerate(e):
        if d < 0 or (d == 0 and shift):
            return None
        top = d + x
        ratio = q[k + 1] / top if top else 0.0
        q_new.append(top)
        e_new.append(x * ratio)
        d = d * ratio - shift
    return None if d < 0 else ([*q_new, d], e_new)


def safe_shift(q: list[float], e: list[float]) -> float:
    """Laguerre's bound below the smallest eigenvalue, from the traces of the
    inverse and of its square: the quotients' product is the determinant, so
    both are sums over the first two derivatives of the quotients by the shift."""
    t1 = t2 = 0.0
    d, d1, d2 = q[0], -1.0, 0.0
    for k in range(len(q)):
        x = e[k] if k < len(e) else 0.0
        top = d + x
        if not top > 0:
            return 0.0
        u, v = d1 / top, d2 / top
        t1 -= u
        t2 += u * u - v
        if k < len(e):
            ratio = q[k + 1] / top
            kept, u1, v1 = x / top, d1, d2
            # derivatives of d / (d + x), times q[k + 1]
            d, d1, d2 = d * ratio, u1 * kept * ratio - 1.0, (v1 - 2.0 * u1 * u) * kept * ratio
    n = len(q)
    spread = (n - 1) * (n * t2 - t1 * t1)
    below = t1 + spread ** 0.5 if spread > 0 else t1
    return n / below * (1 - 8 * EPS) if t1 > 0 and np.isfinite(below) else 0.0


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, each to
    high relative accuracy: dqds, deflating at the end and splitting inside."""
    found: list[float] = []
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while todo:
        q, e, moved = todo.pop()
        if q[0] < q[-1]:  # the smallest values come out at the end
            q, e = q[::-1], e[::-1]
        for _ in range(100 * len(q) + 100):
            while e and e[-1] <= NEGLIGIBLE * (moved + q[-1]):
                found.append(q.pop() + moved)
                e.pop()
            at = next((k for k, x in enumerate(e) if x <= NEGLIGIBLE * (moved + min(q[k], q[k + 1]))), None)
            if at is not None:
                todo.append((q[:at + 1], e[:at], moved))
                q, e = q[at + 1:], e[at + 1:]
            if not e:
                found.append(q[0] + moved)
                break
            shift = safe_shift(q, e)
            step = dqds_step(q, e, shift)
            while step is None:  # rounding took the bound over the eigenvalue
                shift = 0.9 * shift if shift > 1e-3 * q[-1] else 0.0
                step = dqds_step(q, e, shift)
            q, e = step
            moved += shift
        else:
            raise ArithmeticError("dqds did not settle")
    return np.sort(np.array(found))[::-1]


def twisted(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quotients of the stationary factorisation (from the top) and of the
    progressive one (from the bottom) of ``b'b - shift``, where ``b`` has the
    squares ``q, e``, and the remainder at each row where the two can meet."""
    n, tiny = len(q), np.finfo(np.float64).tiny
    low = np.empty(max(n - 1, 0))
    s = np.empty(n)
    s[0] = -shift
    for k in range(n - 1):
        top = s[k] + q[k] or tiny
        low[k] = np.sqrt(q[k] * e[k]) / top
        s[k + 1] = s[k] * (e[k] / top) - shift
    up = np.empty(max(n - 1, 0))
    p = np.empty(n)
    p[n - 1] = q[n - 1] - shift
    for k in range(n - 2, -1, -1):
        bottom = e[k] + p[k + 1] or tiny
        up[k] = np.sqrt(q[k] * e[k]) / bottom
        p[k] = p[k + 1] * (q[k] / bottom) - shift
    return low, up, s + p + shift


def direction(low: np.ndarray, up: np.ndarray, at: int, signs: np.ndarray) -> np.ndarray:
    """The vector that solves the twisted system meeting in row ``at``."""
    z = np.zeros(len(low) + 1)
    z[at] = 1.0
    for k in range(at - 1, -1, -1):
        z[k] = -low[k] * signs[k] * z[k + 1]
    for k in range(at, len(low)):
        z[k + 1] = -up[k] * signs[k] * z[k]
    return z / np.linalg.norm(z)


def principal_axes(r: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of ``r'r / n``, at
    most ``components`` of them and none that is zero to working accuracy, and
    the trace."""
    b, above, p = bidiagonalise(r)
    size = np.hypot.reduce(np.concatenate([b, above]), initial=0.0)
    above[np.abs(above) <= EPS * size / 16] = 0.0
    b[np.abs(b) <= EPS * size / 16] = 0.0
    starts = [0, *(np.flatnonzero(above == 0) + 1), len(b)]
    pairs, trace = [], 0.0
    for first, end in zip(starts, starts[1:]):
        part, ups = b[first:end], above[first:end - 1]
        values = squared_singular_values(part, ups)
        trace += float(values.sum())
        pairs += [(float(v), first, end, k) for k, v in enumerate(values)]
    pairs.sort(key=lambda x: (-x[0], x[1]))
    floor = pairs[0][0] * (EPS * len(b)) ** 2 if pairs else 0.0
    chosen = [x for x in pairs[:components] if x[0] > floor]
    axes, inside = [], []
    for value, first, end, _ in chosen:
        part, ups = b[first:end], above[first:end - 1]
        low, up, remainder = twisted(part**2, ups**2, value)
        signs = np.sign(part[:-1] * ups)
        near = [z for v, at, z in inside if at == first and abs(v - value) <= CLOSE * v]
        for at in np.argsort(np.abs(remainder), kind="stable"):
            z = direction(low, up, int(at), signs)
            for _ in range(2):
                for other in near:
                    z = z - (z @ other) * other
            if np.linalg.norm(z) > 0.1:  # else the same direction as a close one: meet in another row
                break
        z /= np.linalg.norm(z)
        inside.append((value, first, z))
        axes.append(p[:, first:end] @ z)
    return np.array([x[0] for x in chosen]) / n, np.array(axes).reshape(len(axes), len(b)).T, trace / n


# ------------------------------------------------------------------ Spark jobs
def exact_sums(vectors: DataFrame, embedding: str) -> tuple[int, np.ndarray] | None:
    """Number of usable vectors and sums of their whole numbers by dimension;
    None without any.  A task returns one row, which Spark adds up."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = {}, {}
        for batch in batches:
            for d, x in whole_numbers(batch.column(0))[1].items():
                n[d] = n.get(d, 0) + len(x)
                sums[d] = sums.get(d, 0) + x.sum(axis=0)
                if max(len(x) * int(np.abs(x).max()), int(np.abs(sums[d]).max())) >= 2**62:
                    raise OverflowError("a sum does not fit a long")
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([n[d] for d in sums], pa.int64()),
                                   pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], names=["d", "n", "s"])

    parts = stage(vectors.select(embedding).mapInArrow(add, "d int, n long, s array<long>"), "vector_sums")
    lengths = parts.groupBy("d").agg(F.sum("n").alias("n")).limit(2).collect()
    if not lengths:
        return None
    if len(lengths) > 1:
        raise ValueError(f"vectors of several lengths, such as {sorted(r['d'] for r in lengths)}")
    rows = parts.select(F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
    return int(lengths[0]["n"]), np.array([r["s"] for r in rows], dtype=np.int64)


def reduced_triangle(vectors: DataFrame, embedding: str, n: int, sums: np.ndarray) -> np.ndarray:
    """R of all centred vectors: one a task, then of ``FAN_IN`` at a time."""
    d, mean = len(sums), sums / n

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for x in whole_numbers(batch.column(0))[1].values():
                centred = x - mean
                r = triangle(centred if r is None else np.vstack([r, centred]))
        if r is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["node", "r"])

    def merge(key, group):  # hints make applyInArrow look for another signature
        held = [np.frombuffer(x.as_py()).reshape(d, d) for x in group.sort_by("node")["r"]]
        return pa.table({"node": pa.array([key[0].as_py()], pa.int64()), "r": pa.array([triangle(np.vstack(held)).tobytes()], pa.binary())})

    parts = stage(vectors.select(embedding).mapInArrow(own, "node long, r binary"), "triangles")
    last = parts.agg(F.max("node")).first()[0]
    while last:
        grouped = parts.withColumn("group", F.expr(f"node div {FAN_IN}")).groupBy("group")
        parts = stage(grouped.applyInArrow(merge, "node long, r binary"), "triangles")
        last //= FAN_IN
    return np.frombuffer(parts.first()["r"]).reshape(d, d)


def identity_error(vectors: DataFrame, embedding: str, mean: np.ndarray, axes: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity.  Every task centres its rows at their own mean, and the tasks'
    means are centred at that of all."""
    k = axes.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, at, cross = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for x in whole_numbers(batch.column(0))[1].values():
                z = (x - mean) @ axes
                own = z.mean(axis=0)
                off, step = z - own, own - at
                cross += off.T @ off + np.outer(step, step) * (n * len(z) / (n + len(z)))
                at = at + step * (len(z) / (n + len(z)))
                n += len(z)
        if n:
            yield pa.record_batch([pa.array([n], pa.int64()), pa.array([at.tolist()]), pa.array([cross.ravel().tolist()])], names=["n", "at", "cross"])

    parts = stage(vectors.select(embedding).mapInArrow(measure, "n long, at array<double>, cross array<double>"), "whitened_parts")
    total = F.sum("n")
    first = parts.agg(total.alias("n"), *((F.sum(F.col("n") * F.get("at", F.lit(i))) / total).alias(f"m{i}") for i in range(k))).first()
    n, at = first["n"], [first[f"m{i}"] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    spread = parts.agg(*(F.sum(F.get("cross", F.lit(i * k + j)) + F.col("n") * (F.get("at", F.lit(i)) - at[i]) * (F.get("at", F.lit(j)) - at[j]))
                         .alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(spread[f"c{i}_{j}"] / n - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Rows ``vec_id, component, n, deviation, whitened, explained,
    identity_error``, one per usable vector and component.

    Vectors that are null or empty or hold a null or non-finite entry are left
    out.  Equal vectors and repeated rows count each by itself, and null ids
    are kept.  Directions without spread have no component, so a table of
    equal vectors, or without any, gives an empty table.  Vectors of several
    lengths are an error, as are entries beyond 2 ** 42 and deviations beyond
    a long.  Other columns are left out, so they cannot clash."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    schema = T.StructType([rows.schema["vec_id"], *T.StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    held = exact_sums(rows, "embedding")
    if held is None:
        return rows.sparkSession.createDataFrame([], schema)
    n, sums = held
    values, axes, trace = principal_axes(reduced_triangle(rows, "embedding", n, sums), n, components)
    k = len(values)
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    mean, scaled, explained = sums / n, axes / np.sqrt(values), values / trace
    error = identity_error(rows, "embedding", mean, scaled)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, found = whole_numbers(batch.column(1))
            for x in found.values():
                m = len(x)
                yield pa.record_batch([
                    batch.column(0).take(pa.array(np.repeat(usable, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)), pa.array(np.repeat(deviations(x, n, sums), k)), pa.array(((x - mean) @ scaled).ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], names=schema.names)

    return rows.mapInArrow(project, schema)
