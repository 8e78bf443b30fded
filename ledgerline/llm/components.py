"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, written


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step.

    Large star: every larger neighbour of a node is linked to the node's least
    neighbour.  Small star: every smaller neighbour, and the node itself, is
    linked to the least of them.  Only a minimum per node is aggregated (with
    partial sums), so a node with very many links costs one row per task; and
    the minima of the large star are a written table, so that in the join the
    rows of such a node can be split.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least-neighbours")
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    large = large.distinct()                                      # b < a from here on
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    return (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node reachable.

    Alternating star steps until the links stop changing, each round written
    to the shared checkpoint folder.  Raises when ``max_rounds`` do not suffice.
    """
    now = cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        mark = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == seen or not mark[0]:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = mark
        now = cut(_stars(now))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
