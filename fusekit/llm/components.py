"""Connected components of a link table on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (src, dst; long), where root is
    the smallest node of its component.

    Alternating large-star and small-star steps: every node sends its
    neighbours to the smallest of them.  The minimum of a node with very many
    neighbours is pre-aggregated before its shuffle, and the join that brings
    it back is one Spark can split.  Each round is written to the shared folder;
    rounds grow with the logarithm of a component's length."""
    edges = written(_directed(links), "links")
    state = _state(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "links")
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _directed(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    return links.filter("src != dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(src, dst))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node point to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("least")).withColumn("least", F.least("least", "src"))
    return both.filter("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = edges.groupBy("src").agg(F.min("dst").alias("least"))
    moved = edges.join(least, "src").filter("dst != least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return moved.unionByName(least.select("src", F.col("least").alias("dst"))).distinct()
