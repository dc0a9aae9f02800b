"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
    tied = both.where("dst > src").join(least, "src")
    return tied.select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src != dst").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("src").agg(F.min("dst").alias("m"))
    tied = edges.join(least, "src")
    down = tied.select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    own = least.select("src", F.col("m").alias("dst"))
    return down.unionByName(own).where("src != dst").distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row.n, row.h


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node of its component, for every node of an edge.

    `edges` has the long columns `src` and `dst`. Each round is written to shared storage, so
    lineage stays short and a lost executor costs one round at most. The largest and smallest
    neighbours are plain aggregates and the tie is a join, which AQE splits at a hot node; no
    neighbourhood is gathered. An empty table gives an empty result.
    """
    larger = edges.where("src != dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    current = materialise(larger.distinct(), "component-edges")
    mark = _digest(current)
    while mark[0]:
        after = materialise(_small_star(_large_star(current)), "component-edges")
        seen, mark, current = mark, _digest(after), after
        if seen == mark:
            break
    roots = current.groupBy("src").agg(F.min("dst").alias("root")).select(F.col("src").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
