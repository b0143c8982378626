"""Message trees: the path from a conversation's leaf to its root, and the health of the tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.session import settled


def active_path(messages: DataFrame, leaves: DataFrame, unit: str, node: str, parent: str) -> DataFrame:
    """unit, node, place: the messages from the root (place 0) to the leaf.

    Parent pointers are doubled each round, so the rounds grow with the logarithm of the depth and no
    conversation is gathered into one task. A parent that is not there ends the path; in a cycle each message
    is met once. Units without a known leaf are absent.
    """
    known = messages.select(unit, node, parent).dropDuplicates([unit, node])
    there = known.select(unit, F.col(node).alias(parent))
    jump = known.where(F.col(parent).isNotNull()).join(there, [unit, parent], "left_semi").select(unit, node, F.col(parent).alias("up"))
    held = settled(leaves.select(unit, node).join(known.select(unit, node), [unit, node], "left_semi").distinct().withColumn("hops", F.lit(0).cast("long")))
    step, before = 1, held.count()
    while True:
        new = held.join(jump, [unit, node]).select(unit, F.col("up").alias(node), (F.col("hops") + step).alias("hops"))
        held = settled(held.unionByName(new).groupBy(unit, node).agg(F.min("hops").alias("hops")))
        now = held.count()
        if now == before:
            break
        before, step = now, step * 2
        onward = jump.select(unit, F.col(node).alias("up"), F.col("up").alias("top"))
        jump = settled(jump.join(onward, [unit, "up"]).select(unit, node, F.col("top").alias("up")))
    depth = held.groupBy(unit).agg(F.max("hops").alias("depth"))
    return held.join(depth, unit).select(unit, node, (F.col("depth") - F.col("hops")).alias("place"))


def tree_problems(messages: DataFrame, unit: str, node: str, parent: str) -> DataFrame:
    """unit, roots, dangling: trees of two messages or more without exactly one root, or with parents that are not there."""
    there = messages.select(unit, F.col(node).alias(parent), F.lit(1).alias("seen")).distinct()
    joined = messages.select(unit, node, parent).join(there, [unit, parent], "left")
    found = joined.groupBy(unit).agg(
        F.count("*").alias("n"), F.count_if(F.col(parent).isNull()).alias("roots"), F.count_if(F.col(parent).isNotNull() & F.col("seen").isNull()).alias("dangling")
    )
    return found.where("n > 1 and (roots <> 1 or dangling > 0)").select(unit, "roots", "dangling")
