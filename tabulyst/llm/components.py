"""Connected components of a link table by large-star and small-star rounds, all on Spark.

Each round is two aggregations over written tables: every node hangs its larger
neighbours (large star), then its smaller ones (small star), on the smallest node it knows. The
number of rounds grows with the logarithm of the longest path. A hub with very many links is only
ever reduced by a partial aggregate and joined with its one minimum, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import Stages


def _with_least(links: DataFrame, stages: Stages) -> DataFrame:
    """links (u, v) plus the least node among u and its neighbours."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return links.join(stages.keep(least, "least"), "u")


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node of its component.

    Loops, repeated and null-ended links change nothing; no link gives an empty table.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stages.keep(edges, "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, stages).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stages.keep(large, "large")
        hung = _with_least(large, stages)
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        small = stages.keep(small, "small")
        # A star forest: every node hangs on one node at most, and none that hangs carries another.
        ends = small.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("carries")).union(
            small.select("v", F.lit(0), F.lit(1)))
        ties = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("carries").alias("carries"))
        stages.release("least", "large", "edges")
        stages.release("small", but_last=True)
        if ties.where(F.col("hangs") + F.col("carries") > 1).isEmpty():
            break
        edges = small
    found = stages.keep(small.select(F.col("u").alias("node"), F.col("v").alias("root")).union(small.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct(), "roots")
    stages.release("small")
    return found
