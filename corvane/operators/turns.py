"""Turns: counts by side, ordinals within a role, word tables, transcripts compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.functions.text import words


def side(role: Column) -> Column:
    """user -> human, assistant -> assistant, other roles null."""
    return F.when(role == "user", "human").when(role == "assistant", "assistant")


def counts(turns: DataFrame) -> DataFrame:
    """conv_id, human, assistant, total, bytes."""
    return turns.groupBy("conv_id").agg(
        F.count_if(side(F.col("role")) == "human").alias("human"),
        F.count_if(side(F.col("role")) == "assistant").alias("assistant"),
        F.count("*").alias("total"),
        F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0).cast("long")).alias("bytes"),
    )


def role_ordinals(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, n: the place of each turn among those of its role."""
    order = Window.partitionBy("conv_id", "role").orderBy("turn")
    return turns.select("conv_id", "turn", "role", F.row_number().over(order).cast("long").alias("n"))


def word_counts(turns: DataFrame) -> DataFrame:
    """side, word, count; counted before any shuffle of words."""
    found = turns.select(side(F.col("role")).alias("side"), F.explode(words(F.col("text"))).alias("word")).where("side is not null")
    return found.groupBy("side", "word").agg(F.count("*").alias("count"))


def top(counted: DataFrame, by: list[str], n: int = 120) -> DataFrame:
    """The ``n`` most frequent words of each group; ties by word."""
    order = Window.partitionBy(*by).orderBy(F.desc("count"), "word") if by else None
    if order is None:
        return counted.orderBy(F.desc("count"), "word").limit(n)
    return counted.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def transcript(turns: DataFrame) -> DataFrame:
    """conv_id, said: the digests of the turns in order; texts themselves are not gathered."""
    one = F.struct("turn", F.sha2(F.concat_ws("\n", "role", "text"), 256).alias("h"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("s")).select("conv_id", F.col("s.h").alias("said"))


def compare(mine: DataFrame, other: DataFrame) -> DataFrame:
    """conv_id, state: identical, appended (mine begins other), stale (other begins mine), divergent, or held by one side."""
    a, b = transcript(mine).withColumnRenamed("said", "a"), transcript(other).withColumnRenamed("said", "b")
    begins = lambda x, y: F.slice(F.col(y), F.lit(1), F.size(x)) == F.col(x)
    state = (
        F.when(F.col("b").isNull(), "only mine").when(F.col("a").isNull(), "only other").when(F.col("a") == F.col("b"), "identical")
        .when(begins("a", "b"), "appended").when(begins("b", "a"), "stale").otherwise("divergent")
    )
    return a.join(b, "conv_id", "full_outer").select("conv_id", state.alias("state"))
