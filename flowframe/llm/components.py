"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.base import written


def _large(edges: DataFrame) -> DataFrame:
    """Hang every greater neighbour of a node on the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select("v", "u"))
    # Written, so that Spark may split the rows of a node that very many others hang on.
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is connected to) of every node that has
    an edge to another and is not its component's root itself.

    ``edges`` has columns ``u`` and ``v``; loops and repeats don't matter. Each round is
    written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    now = written(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    mark = None
    while True:
        now = written(_small(_large(now)), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
