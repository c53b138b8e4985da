"""Embedding near-duplicates by a robust-pruned flat graph (operator 1).

Equal vectors become one with a count.  Vectors of a label are cut into
overlapping clusters ("shards"), level by level, until a shard fits one task.
Each shard gets a flat graph: a vector keeps its nearest neighbours, but none
that a kept one is clearly nearer to.  The adjacency lists of a vector from all
its shards are united.  Every vector is then searched for in each of its
shards, greedily from medoids; from all vectors found within range, itself
among them, the search goes on until nothing new is in range.  Links are
verified by their cosine in double precision, and one that several shards find
counts in the first of the shards that both ends share.

Centres nearer to each other than ``merge`` become one, so a dense group of
near copies is never cut.  A shard that cannot be cut and does not fit is
compared in blocks, exactly.  A bounded set of audit vectors is compared with
all rows.  Recall is the mean over vectors, taken apart for vectors with one
link, a few and many, so that one dense group does not speak for the others;
where one is below ``target`` the shards are built again with more overlap, and
in the end all vectors of a label are compared, exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage
from tessera.llm.components import component_ids

THRESHOLD = 0.93


def unit_vectors(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``row`` (a number), ``vec_id``, ``space`` (label and length; null if the
    vector links with nothing), ``v``, the vector over its length, and ``h1, h2``,
    a 128-bit hash of it."""
    v = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x))
    sound = (F.col(label).isNotNull() & v.isNotNull()
             & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False)))
    usable = F.coalesce(sound & (norm > 0) & (norm != float("inf")), F.lit(False))
    # inside the inner lambda the norm would be made anew for every component
    scaled = F.transform(F.array(norm), lambda n: F.transform(v, lambda x: x / n))[0]
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).alias("vec_id"),
                           F.when(usable, F.concat_ws("/", F.col(label).cast("string"), F.size(v).cast("string"))).alias("space"),
                           F.when(usable, scaled).alias("v"))
    return stage(numbered.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")}), "unit_vectors")


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Rows ``row, space, v, m, least`` of :func:`unit_vectors`: equal vectors
    of a space as the first of them, how many they are, their smallest id."""
    return stage(vectors.filter("space IS NOT NULL").groupBy("space", "h1", "h2").agg(
        F.min("row").alias("row"), F.first("v").alias("v"), F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("least"))
        .select("space", "h1", "h2", "row", "v", "m", "least"), "distinct_vectors")


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _centres(merge: float, max_shard: int, fanout: int, overlap: int, rounds: int = 6):
    """Spherical k-means on the sample of one shard."""

    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        x = _stack(sample.sort_values("row")["v"])
        k = int(min(max(fanout, 4 * overlap), max(4 * overlap, -(-2 * overlap * int(sample["n"].iloc[0]) // max_shard)), len(x)))
        c = x[np.linspace(0, len(x) - 1, k).astype(int)]
        for _ in range(rounds):
            near = (x @ c.T).argmax(axis=1)
            sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
            c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        kept: list[np.ndarray] = []
        for y in c:
            if all(float(y @ z) < merge for z in kept):
                kept.append(y)
        return pd.DataFrame({"shard": sample["shard"].iloc[0], "centre": range(len(kept)), "c": [list(map(float, y)) for y in kept]})

    return fit


def _assign(overlap: int, threshold: float):
    """Nearest ``overlap`` centres of each vector of a part of one shard, as far
    as a vector within range could have them as its nearest."""

    def deal(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(centres):
            return pd.DataFrame({"row": [], "shard": [], "m": [], "v": []})
        sims = _stack(rows["v"]) @ _stack(centres["c"]).T
        m = min(overlap, sims.shape[1])
        best = np.argsort(-sims, axis=1, kind="stable")[:, :m]
        near = np.take_along_axis(sims, best, axis=1)
        top = np.clip(near[:, :1], -1, 1)
        close = near >= top - 2 * np.sqrt(1 - top * top) * np.sqrt(1 - threshold * threshold) - 1e-9
        who, nth = np.nonzero(close)
        names = centres["centre"].to_numpy()
        return pd.DataFrame({
            "row": rows["row"].to_numpy()[who],
            "shard": [f"{rows['shard'].iloc[0]}.{j}" for j in names[best[who, nth]]],
            "m": rows["m"].to_numpy()[who],
            "v": rows["v"].to_numpy()[who]})

    return deal


def shards(vectors: DataFrame, threshold: float, overlap: int, max_shard: int, fanout: int, merge: float, max_levels: int = 8,
           part: int = 2000) -> tuple[DataFrame, DataFrame]:
    """Rows ``row, shard, m, v`` of the shards that fit, and of those that
    could not be cut.  Levels grow with the logarithm of the rows; centres are
    fitted on about ``16 * fanout`` vectors of a shard, and meet its vectors in
    parts of about ``part``."""
    todo = vectors.select("row", F.col("space").alias("shard"), "m", "v")
    fits, stuck, level = None, None, 0

    def more(a, b):
        return b if a is None else a.unionByName(b)

    while True:
        sizes = stage(todo.groupBy("shard").agg(F.count(F.lit(1)).alias("n")), "shard_sizes")
        big = sizes.filter(F.col("n") > max_shard)
        n_big = big.count()
        fits = more(fits, todo if not n_big else todo.join(sizes.filter(F.col("n") <= max_shard).select("shard"), "shard").select(todo.columns))
        if not n_big:
            break
        large = stage(todo.join(big, "shard").select(*todo.columns, "n"), "large_shards")
        draw = F.pmod(F.xxhash64("row", F.lit(level)), F.lit(1 << 30)) / float(1 << 30)
        sample = large.filter(draw < F.lit(16.0 * fanout) / F.col("n")).select("shard", "row", "n", "v")
        centres = stage(sample.groupBy("shard").applyInPandas(_centres(merge, max_shard, fanout, overlap), "shard string, centre int, c array<double>"), "centres")
        cut = stage(centres.groupBy("shard").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").join(big, "shard"), "cut_shards")
        whole = large.join(cut.select("shard"), "shard", "left_anti").select(todo.columns)
        stuck = more(stuck, whole)
        n_parts = F.ceil(F.col("n") / part).cast("int")
        parts = large.join(cut.select("shard"), "shard").withColumn("salt", F.pmod(F.xxhash64("row"), n_parts).cast("int"))
        spread = centres.join(cut, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), n_parts - 1)))
        todo = stage(parts.select("shard", "salt", "row", "m", "v").groupBy("shard", "salt")
                     .cogroup(spread.select("shard", "salt", "centre", "c").groupBy("shard", "salt"))
                     .applyInPandas(_assign(overlap, threshold), "row long, shard string, m long, v array<double>"), "dealt_shards")
        level += 1
        if level >= max_levels:
            stuck = more(stuck, todo)
            break
    empty = vectors.limit(0).select("row", F.lit("").alias("shard"), "m", "v")
    return fits if fits is not None else empty, stuck if stuck is not None else empty


def _graph(degree: int, alpha: float, block: int = 256):
    """Robust-pruned neighbour lists of one shard, with their reverse links:
    pruning hangs a group of copies on the one in its middle, so the way back
    from there must not be cut short.  The vectors of a block are pruned side by
    side; a shard fits a task, and so do the cosines of its vectors."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        x, ids = _stack(rows["v"]), rows["row"].to_numpy()
        n, sims = len(x), x @ x.T
        m, links = min(8 * degree, n), []
        for at in range(0, n, block):
            s = sims[at:at + block]
            own = np.arange(at, at + len(s))
            o = np.argpartition(-s, m - 1, axis=1)[:, :m]
            o = np.take_along_axis(o, np.argsort(-np.take_along_axis(s, o, axis=1), axis=1, kind="stable"), axis=1)
            gap, left = 1 - np.take_along_axis(s, o, axis=1), o != own[:, None]
            for _ in range(degree):
                who = np.flatnonzero(left.any(axis=1))
                if not len(who):
                    break
                nth = left[who].argmax(axis=1)  # the nearest that is left
                kept = o[who, nth]
                links.append(own[who] * n + kept)
                left[who] &= alpha * (1 - sims[kept[:, None], o[who]]) > gap[who]  # not clearly nearer to the kept one
                left[who, nth] = False
        links = np.concatenate([*links, np.zeros(0, dtype=np.int64)])
        links = np.unique(np.concatenate([links, links % n * n + links // n]))
        near = np.split(ids[links % n], np.searchsorted(links, np.arange(1, n) * n))
        return pd.DataFrame({"row": ids, "shard": rows["shard"].to_numpy(), "near": near})

    return build


class _Joined:
    """Components among the members of a shard."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins each of ``a`` with its one of ``b``: of two roots the larger
        hangs on the smaller, until no pair has two."""
        while (apart := (a := self.root[a]) != (b := self.root[b])).any():
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root != (up := self.root[self.root])).any():
                self.root = up


class _Found:
    """Links found by the vectors of a shard: counts, copies of a vector and
    once for all of them, and what they join."""

    def __init__(self, ids: np.ndarray, m: np.ndarray):
        self.ids, self.m, self.joined = ids, m, _Joined(len(ids))
        self.n_links, self.n_near = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)

    def add(self, q: np.ndarray, found: np.ndarray) -> None:
        np.add.at(self.n_links, q, self.m[found])
        np.add.at(self.n_near, q, 1)
        self.joined.join(q, found)

    def result(self) -> pd.DataFrame:
        linked, root = np.flatnonzero(self.n_near), self.joined.root
        moved = np.flatnonzero(root != np.arange(len(root)))
        none = np.zeros(len(moved), dtype=np.int64)
        return pd.DataFrame({"row": self.ids[np.concatenate([linked, moved])], "n_links": np.concatenate([self.n_links[linked], none]),
                             "n_near": np.concatenate([self.n_near[linked], none]),
                             "other": pd.array([*[None] * len(linked), *self.ids[root[moved]]], dtype="Int64")})


class _Elsewhere:
    """Which vectors of a shard share an earlier shard with one of them: those
    links count there.  ``homes`` has the shards of every vector."""

    def __init__(self, shard: int, homes: pd.Series):
        earlier = [[h for h in mine if h < shard] for mine in homes]
        self.earlier = np.zeros((len(earlier), max(map(len, earlier), default=0)), dtype=np.int64)
        self.there = np.zeros(self.earlier.shape, dtype=bool)
        for i, mine in enumerate(earlier):
            self.earlier[i, :len(mine)], self.there[i, :len(mine)] = mine, True

    def shared(self, q: np.ndarray | int, found: np.ndarray) -> np.ndarray:
        """Whether each of ``found`` shares one with ``q``, its own or one for all."""
        out = np.zeros(len(found), dtype=bool)
        for h, there in zip(self.earlier[q].T[..., None], self.there[q].T[..., None]):
            out |= ((self.earlier[found] == h) & self.there[found] & there).any(axis=1)
        return out

    def without(self, q: int, found: np.ndarray) -> np.ndarray:
        return found[~self.shared(q, found)]


def medoids(x: np.ndarray, k: int = 8) -> np.ndarray:
    """The vector nearest to the mean, then ``k - 1`` that are each least
    similar to those before, every one moved to the middle of its group."""
    start = int((x @ x.mean(axis=0)).argmax())
    best, found = x @ x[start], [start]
    for _ in range(min(k, len(x)) - 1):
        found.append(int(best.argmin()))
        best = np.maximum(best, x @ x[found[-1]])
    group = (x @ x[found].T).argmax(axis=1)
    sums = np.stack([x[group == j].sum(axis=0) for j in range(len(found))])
    return np.unique((x @ sums.T).argmax(axis=0))


class _Walk:
    """A block of searches of the graph of one shard, side by side: what each has
    seen, with its cosine (-2: not seen), and from where it has gone on."""

    def __init__(self, x: np.ndarray, starts: np.ndarray, near: np.ndarray, q: np.ndarray, first: np.ndarray):
        self.x, self.starts, self.near, self.q = x, starts, near, q
        self.sims, self.done = np.full((len(q), len(x)), -2.0), np.zeros((len(q), len(x)), dtype=bool)
        self.mark = np.zeros(len(q) * len(x), dtype=np.int64)
        self.sims[:, first] = x[q] @ x[first].T

    def go(self, who: np.ndarray, node: np.ndarray) -> None:
        """From ``node``, each of the search ``who``, to its neighbours."""
        self.done[who, node] = True
        size = self.starts[node + 1] - self.starts[node]
        place = np.arange(size.sum()) + np.repeat(self.starts[node] - np.cumsum(size) + size, size)
        who, new = np.repeat(who, size), self.near[place]
        fresh = self.sims[who, new] == -2.0
        who, new = who[fresh], new[fresh]
        key, nth = who * len(self.x) + new, np.arange(len(who))
        self.mark[key] = nth
        once = self.mark[key] == nth
        who, new = who[once], new[once]
        self.sims[who, new] = np.einsum("ij,ij->i", self.x[self.q[who]], self.x[new])

    def greedy(self, beam: int, width: int) -> None:
        """On from the ``width`` nearest that are left of the ``beam`` nearest seen, until none is."""
        live, beam = np.arange(len(self.q)), min(beam, len(self.x))
        while len(live):
            best = np.argpartition(-self.sims[live], beam - 1, axis=1)[:, :beam]
            sims = self.sims[live[:, None], best]
            sims[self.done[live[:, None], best]] = -2.0
            nth = np.argsort(-sims, axis=1)[:, :width]
            who, col = np.nonzero(np.take_along_axis(sims, nth, axis=1) > -2.0)
            self.go(live[who], best[who, nth[who, col]])
            live = live[np.unique(who)]

    def expand(self, least: float) -> None:
        """On from all with a cosine of ``least`` or more, until none is left."""
        while len((todo := np.nonzero((self.sims >= least) & ~self.done))[0]):
            self.go(*todo)


def _search(threshold: float, beam: int, slack: float, block: int = 64, width: int = 4):
    """Range-expanding greedy search of the vectors of one shard."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        x, ids = _stack(rows["v"]), rows["row"].to_numpy()
        # the lists name rows; those of other shards fall away
        told, row = np.concatenate([*rows["near"], np.zeros(0, dtype=np.int64)]).astype(np.int64), np.repeat(np.arange(len(x)), rows["near"].map(len))
        near = np.minimum(np.searchsorted(ids, told), len(x) - 1)
        here = ids[near] == told
        starts, near = np.searchsorted(row[here], np.arange(len(x) + 1)), near[here]
        first, found, elsewhere = medoids(x), _Found(ids, rows["m"].to_numpy()), _Elsewhere(rows["id"].iloc[0], rows["homes"])
        for at in range(0, len(x), block):
            walk = _Walk(x, starts, near, np.arange(at, min(at + block, len(x))), first)
            walk.greedy(beam, width)
            own = walk.sims[np.arange(len(walk.q)), walk.q]
            walk.sims[np.arange(len(walk.q)), walk.q] = np.where(own == -2.0, 1.0, own)  # the vector is in its own range
            walk.expand(threshold - slack)
            who, other = np.nonzero(walk.sims >= threshold)
            q = walk.q[who]
            links = q != other
            q, other = q[links], other[links]
            links = ~elsewhere.shared(q, other)
            found.add(q[links], other[links])
        return found.result()

    return search


def _compare(threshold: float, chunk: int = 256):
    """Links inside a block, or between two blocks, in both directions."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        x, own = _stack(rows["v"]), rows["own"].to_numpy()
        found, elsewhere = _Found(rows["row"].to_numpy(), rows["m"].to_numpy()), _Elsewhere(rows["id"].iloc[0], rows["homes"])
        two = len(np.unique(own)) == 2
        for at in range(0, len(x), chunk):
            q, other = np.nonzero(x[at:at + chunk] @ x.T >= threshold)
            q += at
            links = own[other] != own[q] if two else other != q
            q, other = q[links], other[links]
            links = ~elsewhere.shared(q, other)
            found.add(q[links], other[links])
        return found.result()

    return compare


RESULT = "row long, n_links long, n_near long, other long"


def search_shards(fits: DataFrame, homes: DataFrame, threshold: float, degree: int, alpha: float, beam: int, slack: float) -> DataFrame:
    """Counts and spanning links found in the shards that fit one task."""
    lists = fits.groupBy("shard").applyInPandas(_graph(degree, alpha), "row long, shard string, near array<long>")
    united = stage(lists.groupBy(F.col("row").alias("r")).agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "adjacency")
    rows = fits.join(united, fits["row"] == united["r"]).join(homes, "row").select("shard", F.xxhash64("shard").alias("id"), "row", "m", "v", "near", "homes")
    return rows.groupBy("shard").applyInPandas(_search(threshold, beam, slack), RESULT)


def compare_blocks(stuck: DataFrame, homes: DataFrame, threshold: float, block: int = 1500) -> DataFrame:
    """Counts and spanning links of shards that do not fit, by pairs of blocks."""
    sizes = stuck.groupBy(F.col("shard").alias("s")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    rows = stuck.join(homes, "row").join(sizes, stuck["shard"] == sizes["s"])
    dealt = (rows.withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    pairs = dealt.select("shard", F.xxhash64("shard").alias("id"), F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "row", "m", "v", "homes")
    return pairs.groupBy("shard", "i", "j").applyInPandas(_compare(threshold), RESULT)


def homes_of(dealt: DataFrame) -> DataFrame:
    """Rows ``row, homes``: the hashes of all shards that a vector is in."""
    return stage(dealt.groupBy("row").agg(F.collect_list(F.xxhash64("shard")).alias("homes")), "vector_homes")


def link_counts(found: DataFrame) -> DataFrame:
    return stage(found.groupBy("row").agg(F.sum("n_links").alias("n_links"), F.sum("n_near").alias("n_near")), "link_counts")


def audit(vectors: DataFrame, counted: DataFrame, threshold: float, at_most: int = 1024) -> float:
    """Least mean recall among the audit vectors with one link to a different
    vector, with two to nine, and with more: a bounded set is compared with all
    rows, which stream past it.  1 without any link."""
    n = vectors.count()
    draw = F.pmod(F.xxhash64("row", F.lit(99)), F.lit(1 << 30)) / float(1 << 30)
    few = vectors.filter(draw < 1.3 * at_most / max(n, 1)).orderBy(F.xxhash64("row", F.lit(98))).limit(at_most).select("row", "space", "v").toPandas()
    if not len(few):
        return 1.0
    spaces = {s: (g["row"].to_numpy(), _stack(g["v"])) for s, g in few.groupby("space")}

    def count(batches):
        for rows in batches:
            for s, g in rows.groupby("space"):
                if s in spaces:
                    ids, q = spaces[s]
                    hit = (_stack(g["v"]) @ q.T >= threshold) & (g["row"].to_numpy()[:, None] != ids)
                    yield pd.DataFrame({"r": ids, "n_true": hit.sum(axis=0)})

    true = vectors.select("row", "space", "v").mapInPandas(count, "r long, n_true long").groupBy("r").agg(F.sum("n_true").alias("n_true")).filter("n_true > 0")
    both = true.join(counted, true["r"] == counted["row"], "left")
    share = F.least("n_true", F.coalesce("n_near", F.lit(0))) / F.col("n_true")
    kinds = both.groupBy(F.when(F.col("n_true") == 1, 1).when(F.col("n_true") < 10, 2).otherwise(3).alias("kind")).agg(F.avg(share).alias("recall"))
    return kinds.agg(F.min("recall")).first()[0] or (0.0 if true.count() else 1.0)


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    overlap: int = 3, max_shard: int = 1500, fanout: int = 64, merge: float = 0.8, degree: int = 24, alpha: float = 1.2,
                    beam: int = 24, slack: float = 0.1, target: float = 0.99, max_overlap: int = 5) -> DataFrame:
    """One row per row of ``rows``: ``vec_id``, ``n_links`` (other vectors of
    the label with a cosine of ``threshold`` or more), ``component_id``
    (smallest id reachable over links) and ``kept`` (they are equal).

    Vectors that are null, zero or hold a null, NaN or infinite component, and
    those without a label, link with nothing; vectors of different lengths do
    not link; repeated rows are vectors of their own and link; a null id is
    never the smallest and not kept, and without any id in its component
    component_id is null; an empty table gives an empty table; other columns
    are left out."""
    vectors = unit_vectors(rows, vec_id, vector, label)
    alone = distinct_vectors(vectors)
    while True:
        if overlap > max_overlap:
            whole = alone.select("row", F.col("space").alias("shard"), "m", "v")
            found = stage(compare_blocks(whole, homes_of(whole), threshold), "vector_links")
            counted = link_counts(found)
            break
        fits, stuck = shards(alone, threshold, overlap, max_shard, fanout, merge)
        homes = homes_of(fits.unionByName(stuck))
        found = stage(search_shards(fits, homes, threshold, degree, alpha, beam, slack).unionByName(compare_blocks(stuck, homes, threshold)), "vector_links")
        counted = link_counts(found)
        if audit(alone, counted, threshold) >= target:
            break
        overlap += 1
    links = found.filter("other IS NOT NULL").select(F.col("row").alias("a"), F.col("other").alias("b"))
    ids = component_ids(alone.select(F.col("row").alias("node"), F.col("least").alias("id")), links)
    counts = counted.select(F.col("row").alias("r"), "n_links")
    told = alone.join(counts, alone["row"] == counts["r"], "left").join(ids, alone["row"] == ids["node"])
    told = stage(told.select(F.col("space").alias("of"), F.col("h1").alias("k1"), F.col("h2").alias("k2"),
                             (F.coalesce("n_links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id"), "vector_components")
    joined = vectors.join(told, (vectors["space"] == told["of"]) & (vectors["h1"] == told["k1"]) & (vectors["h2"] == told["k2"]), "left")
    component = F.when(F.col("space").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
