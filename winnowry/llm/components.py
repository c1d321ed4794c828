"""Connected components of a graph given as links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import stored


def stars(edges: DataFrame) -> DataFrame:
    """One contraction: larger neighbours move to the smallest known node, then all meet at the root.

    Nodes get a minimum each, so one with any number of links needs no group in memory; joins on such a
    node are split at run time.  Every edge gives one edge, so equal ones may come out and their number stays.
    """
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    root = large.groupBy("hi").agg(F.min("lo").alias("m"))
    return large.join(root, "hi").select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo"))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """links (a, b) -> node, root: the smallest node of its component; nodes without links are absent."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")), "links")
    # A sum and no exclusive-or, in which equal edges would cancel out.
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("x")).alias("mark")
    before = edges.agg(mark).first()["mark"]
    for i in range(max_rounds):
        if before["n"] == 0:
            break
        met = stars(edges)
        # The first round leaves most edges equal; after it they are few, and their number only stays.
        edges = stored(met if i else met.distinct(), "stars")
        now = edges.agg(mark).first()["mark"]
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).distinct()


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (node, root) after further links (a, b), stored: only what the links tie together is contracted again."""
    side = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
    between = links.join(side("a"), "a", "left").join(side("b"), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    found = components(between)
    if found.isEmpty():
        return roots
    moved = found.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    kept = roots.join(moved, F.col("root") == F.col("_node"), "left").select("node", F.coalesce("_root", "root").alias("root"))
    alone = found.join(roots, "node", "left_anti")  # nodes that had no link before
    return stored(kept.unionByName(alone.select("node", "root")), "roots")
