"""Connected components of a graph of links, by joins only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.sources.shared import materialize


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; the root is the least node.

    Large-star and small-star steps in turn: each links the neighbours of a node to the least
    of them, which keeps the components and takes about log n rounds.  Every round is written
    out; minima are pre-aggregated and written, so that a node with very many neighbours is one skewed key
    of a join of two tables, which the planner can split.
    """
    links = links.select("a", "b").filter(F.col("a") != F.col("b"))
    links = materialize(_ordered(links).distinct(), "links")
    for _ in range(rounds):
        large = _star(links)
        links = materialize(large.filter(F.col("a") > F.col("b")).distinct(), "links")
        small = materialize(links.groupBy("a").agg(F.min("b").alias("least")), "least")
        moved = links.join(small, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = moved.unionByName(small.select("a", F.col("least").alias("b")))
        links = materialize(_ordered(links.filter(F.col("a") != F.col("b"))).distinct(), "links")
        if _settled(links):
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    own = links.select(F.col("b").alias("node")).distinct()
    own = own.join(roots, "node", "left_anti").withColumn("root", F.col("node"))
    return roots.unionByName(own)


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none itself."""
    further = links.select(F.col("a").alias("b")).distinct()
    chained = links.join(further, "b", "left_semi").select("a")
    several = links.groupBy("a").count().filter(F.col("count") > 1).select("a")
    return chained.unionByName(several).isEmpty()


def _ordered(links: DataFrame) -> DataFrame:
    """The larger node first."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = links.unionByName(back).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    # Each link is stored with its larger node first: ``back`` has the larger neighbours of ``a``.
    near = back.join(materialize(least, "least"), "a")
    return near.select(F.col("b").alias("a"), F.col("least").alias("b"))
