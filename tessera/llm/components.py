"""Connected components of a table of links, by alternating stars.

Each round hangs every node's larger neighbours on its smallest one, then
every node and its smaller neighbours on the smallest of those; the links of a
component end as a star around its smallest node.  Rounds grow with the
logarithm of a component's size, and links only ever meet through joins on
staged tables, whose large partitions Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows ``node, root`` for every node of ``links`` (longs ``a``, ``b``):
    root is the smallest node reachable.  Links with a null end and links of a
    node to itself are left out; repeated links count once; no links give no
    rows.  Raises if ``max_rounds`` rounds do not end it."""
    flat = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(flat.filter("a > b").distinct(), "links")
    digest = _digest(edges)
    for _ in range(max_rounds):
        if digest[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = stage(low, "large_star_min")
        large = stage(edges.join(low, edges["b"] == low["u"]).select("a", F.col("m").alias("b")).distinct(), "large_star")
        low = stage(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "small_star_min")
        hung = large.join(low, large["a"] == low["u"])
        small = low.select(F.col("u").alias("a"), F.col("m").alias("b")).unionByName(
            hung.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges, before = stage(small.distinct(), "small_star"), digest
        digest = _digest(edges)
        if digest == before:
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())


def component_ids(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Rows ``node, component_id`` for each row of ``nodes`` (``node``, a long
    without repeats, and ``id``): the smallest id of the node's component, null
    ids left out; a node without links has its own id."""
    roots = connected_components(links).withColumnRenamed("node", "n")
    linked = stage(nodes.join(roots, nodes["node"] == roots["n"]).select("node", "id", "root"), "linked_nodes")
    least = stage(linked.groupBy(F.col("root").alias("r")).agg(F.min("id").alias("least")), "component_least")
    named = stage(linked.join(least, linked["root"] == least["r"]).select(F.col("node").alias("n"), "least"), "named_nodes")
    own = nodes.join(named, nodes["node"] == named["n"], "left")
    return stage(own.select("node", F.coalesce("least", "id").alias("component_id")), "component_ids")
