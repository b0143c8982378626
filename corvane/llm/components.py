"""Connected components by alternating star contractions; links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: every node's neighbours are linked to the least of its neighbourhood.

    Large: the greater neighbours move (both directions are looked at); small: the lesser ones and the node itself.
    The least neighbour is pre-aggregated and joined back, so that the centre of a huge star is no single task.
    """
    if large:
        sides = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = sides.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links of any ordered type -> (node, root): the least node that each linked node can reach; nodes without links are absent.

    Each round is written to the shared folder. The rounds end when the set of links no longer changes;
    their number grows with the logarithm of the longest chain. An empty input gives an empty result.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        edges = cut(_star(_star(edges, large=True), large=False))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
