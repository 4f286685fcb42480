"""Connected components of an edge table, by alternating star contractions.

Each step is a grouped minimum and a join, so a node with very many edges is pre-aggregated before
its shuffle and its join rows are split by adaptive execution. Every round is cut into a table in
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm.tables import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any orderable type -> (node, root): every node that has an edge to another
    node, with the smallest node it reaches. Self-loops and nulls are ignored; no edges give no rows.
    """
    current = cut(edges.where("a <> b").select("a", "b").distinct(), "cc")
    seen = None
    while True:
        current = cut(_small_star(_large_star(current)), "cc")
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == seen:
            break
        seen = state
    # Now every edge leads from a node to its component's smallest node.
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def merged_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) of earlier links after more ``links`` (a, b): components of the small graph between
    the old components, mapped back. Nodes without a root are components of their own."""
    for side in "ab":
        known = roots.select(F.col("node").alias(side), F.col("root").alias("known"))
        links = links.join(known, side, "left").withColumn(side, F.coalesce("known", side)).drop("known")
    merged = cut(connected_components(links.where("a <> b")).toDF("old", "new"), "cc-merged")
    moved = roots.join(merged, roots["root"] == merged["old"], "left").select("node", F.coalesce("new", "root").alias("root"))
    alone = merged.join(roots, merged["old"] == roots["node"], "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    return moved.union(alone)
