"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.work import stored


def _star(edges: DataFrame, smaller: bool) -> DataFrame:
    """Join each node's neighbours to the smallest of them and itself.

    Large star: the larger neighbours of each node. Small star: the smaller ones and the node.
    """
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if smaller:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    moved = both.join(least, "a")
    if smaller:
        out = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(
            least.select("a", F.col("least").alias("b"))
        )
    else:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return out.where("a <> b").distinct()


def _print(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) reaches.

    Each round stores its edges, at most as many as there were; the number of rounds grows with
    the logarithm of the longest path. A node with very many edges is split by adaptive joins.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(spark, pairs.distinct(), "edges")
    seen = _print(now)
    while True:
        now = stored(spark, _star(_star(now, smaller=False), smaller=True), "edges")
        found = _print(now)
        if found == seen:
            break
        seen = found
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionAll(roots)
