"""How the driver's test tables stand in for the corpus data model.

The test tables hold no articles, thesaurus or token files, so the operators
(which take column names and word lists as parameters) are exercised through
these mappings:

* article = order (``o_orderkey``); year = ``year(o_orderdate)``;
  journal = ``o_orderpriority``
* heading of an article = each lineitem of the order; descriptor id = the
  lineitem supplier's ``s_nationkey``; major topic = ``l_returnflag = 'R'``
* descriptor = nation (id = ``n_nationkey`` as text, name = ``n_name``,
  source order = ``n_nationkey``); its tree number is
  ``chr(65 + n_regionkey) || lpad(n_nationkey % 7, 2, '0') || '.' || lpad(n_nationkey, 3, '0')``
* token stream = events of one user (file = ``user_id``) in ``(ts, event_id)``
  order; BIO label: ``I-`` when ``value < 1``, else signup ``B-A``, view ``I-A``,
  click ``I-B``, purchase ``O``, error ``ERR``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nation_tree_number() -> Column:
    return F.concat(
        F.chr(F.lit(65) + F.col("n_regionkey")),
        F.lpad((F.col("n_nationkey") % 7).cast("string"), 2, "0"),
        F.lit("."),
        F.lpad(F.col("n_nationkey").cast("string"), 3, "0"),
    )


def nation_descriptor(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("string").alias("ui"),
        F.col("n_name").alias("name"),
    )


def nation_descriptor_tree(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("string").alias("ui"),
        nation_tree_number().alias("tree_number"),
        F.col("n_nationkey").cast("long").alias("ord"),
    )


def nation_descriptor_tree_multi(nation: DataFrame) -> DataFrame:
    """Richer thesaurus for the hierarchy query: besides the main tree number,
    nations of regions 0-2 also sit directly on their level-2 node (so several
    descriptors share that tree number and the first by ``ord`` must win) and
    nations of region 4 have a number under the non-root letter ``Q`` (so the
    ``Category_<letter>`` fallback is exercised)."""
    nk = F.col("n_nationkey")
    main = nation.select(nk.cast("string").alias("ui"), nation_tree_number().alias("tree_number"), nk.cast("long").alias("ord"))
    level2 = nation.where(F.col("n_regionkey") <= 2).select(
        nk.cast("string").alias("ui"),
        F.concat(F.chr(F.lit(65) + F.col("n_regionkey")), F.lpad((nk % 7).cast("string"), 2, "0")).alias("tree_number"),
        nk.cast("long").alias("ord"),
    )
    q = nation.where(F.col("n_regionkey") == 4).select(
        nk.cast("string").alias("ui"),
        F.concat(F.lit("Q"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0"), F.lit("."),
                 F.lpad(nk.cast("string"), 3, "0")).alias("tree_number"),
        nk.cast("long").alias("ord"),
    )
    return main.unionByName(level2).unionByName(q)


def order_articles(orders: DataFrame) -> DataFrame:
    """Article projection of B10 for orders (no translations: title and
    abstract stand-ins are the priority text and ``''``)."""
    return orders.select(
        F.col("o_orderkey").alias("pmid"),
        F.col("o_orderpriority").alias("title"),
        F.year("o_orderdate").alias("year"),
        F.lit("").alias("spanish_abstract"),
    )


def order_terms(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Long heading table ``(pmid, ui, major_topic)``; only major rows are read
    (the flag predicate is pushed into the lineitem scan).  The supplier side
    is a plain file scan, so the planner's own size check (file statistics
    against the broadcast threshold) decides the broadcast; a large supplier
    table is joined by shuffle."""
    li = lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_suppkey")
    sup = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return li.join(sup, "l_suppkey").select(
        F.col("l_orderkey").alias("pmid"),
        F.col("s_nationkey").cast("string").alias("ui"),
        F.lit(True).alias("major_topic"),
    )


def bio_label() -> Column:
    et = F.col("event_type")
    return (
        F.when(F.col("value") < 1, F.lit("I-"))
        .when(et == "signup", F.lit("B-A"))
        .when(et == "view", F.lit("I-A"))
        .when(et == "click", F.lit("I-B"))
        .when(et == "purchase", F.lit("O"))
        .when(et == "error", F.lit("ERR"))
        .otherwise(et)
    )


def event_tokens(events: DataFrame) -> DataFrame:
    """Token rows ``(file, ord_key1, ord_key2, token, label)`` from events."""
    return events.select(
        F.col("user_id").cast("string").alias("file"),
        F.col("ts"),
        F.col("event_id"),
        F.col("event_type").alias("token"),
        bio_label().alias("label"),
        F.col("value"),
    )
