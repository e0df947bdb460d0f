"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long), root being the smallest node of its component.

    Each round hangs every node's larger neighbours, then its smaller ones, below the smallest neighbour, until only
    stars are left; the number of rounds grows with the logarithm of the longest chain. A round is written to the
    shared folder. Neighbourhoods are never gathered: a round joins the edges with one minimum per node, and adaptive
    execution splits the join at a node with very many edges. Null ends and loops are ignored.
    """
    edges = stage(links.filter("a is not null and b is not null and a <> b")
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        below = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(below.union(low.select("u", "m").toDF("u", "v")).distinct(), "small-star")
        # Stars: no node hangs below two others, and none that something hangs below hangs itself.
        # An unchanged edge set is the same thing, and cheaper to see.
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .union(after.select("v", "v").distinct())
        edges = after
