"""Connected components of a link table by repeated contraction, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node with a link, the smallest node it reaches.

    Each round hooks every node to its smallest smaller neighbour, shortens
    the resulting chains by pointer jumping, and replaces the ends of all links by
    their roots; links inside a tree vanish.  Rounds go on until no link is
    left, O(log n) of them.  All state is in tables; only counts reach the driver.
    """
    edges = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct()
    edges = written(edges, "links")
    maps = []
    while not edges.isEmpty():
        tree = _jump(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")))
        maps.append(tree)
        up, down = tree.toDF("hi", "hi_root"), tree.toDF("lo", "lo_root")
        ends = (
            edges.join(up, "hi").join(down, "lo", "left")
            .select("hi_root", F.coalesce("lo_root", "lo").alias("lo_root"))
            .where("hi_root <> lo_root")
            .select(F.greatest("hi_root", "lo_root").alias("hi"), F.least("hi_root", "lo_root").alias("lo"))
            .distinct()
        )
        edges = written(ends, "links")
    if not maps:
        return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    # A node hooked in round r is no end of a link afterwards; its root may be hooked in a later round.
    label = maps[-1]
    for tree in reversed(maps[:-1]):
        later = label.toDF("root", "top")
        label = tree.join(later, "root", "left").select("node", F.coalesce("top", "root").alias("root")).unionByName(label)
    own = label.select("root").distinct().select(F.col("root").alias("node"), "root")
    return label.unionByName(own).select("node", F.col("root").alias("component")).distinct()


def _jump(tree: DataFrame) -> DataFrame:
    """Roots in place of parents: the chains halve until no parent has a parent."""
    tree = written(tree, "tree")
    while True:
        up = tree.toDF("root", "top")
        if tree.join(up.select("root"), "root", "left_semi").isEmpty():
            return tree
        tree = written(tree.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "tree")
