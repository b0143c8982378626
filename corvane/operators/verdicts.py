"""Judgements and states of units, and how far a capture covers what there is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def judged(units: DataFrame, verdicts: DataFrame, key: str, good: str) -> DataFrame:
    """units plus judgement: valid, invalid, or unjudged without a verdict."""
    found = verdicts.groupBy(key).agg(F.min(good).alias("_good"))
    joined = units.join(found, key, "left")
    return joined.withColumn("judgement", F.when(F.col("_good").isNull(), "unjudged").when(F.col("_good") == 1, "valid").otherwise("invalid")).drop("_good")


def latest(verdicts: DataFrame, by: list[str], verdict: str, version: str) -> DataFrame:
    """The verdict of the greatest version of each group."""
    return verdicts.groupBy(*by).agg(F.max_by(verdict, version).alias(verdict))


def coverage(units: DataFrame, captured: DataFrame, key: str) -> DataFrame:
    """One row: captured, never, gone, total."""
    u, c = units.select(key).distinct().withColumn("u", F.lit(1)), captured.select(key).distinct().withColumn("c", F.lit(1))
    return u.join(c, key, "full_outer").agg(
        F.count_if(F.col("u").isNotNull() & F.col("c").isNotNull()).alias("captured"),
        F.count_if(F.col("c").isNull()).alias("never"),
        F.count_if(F.col("u").isNull()).alias("gone"),
        F.count("*").alias("total"),
    )


#: The states of a staged unit, in the order a tally names them.
STATES = ["promotable", "held already", "invalid", "unlicensed", "would lose", "incomplete", "unjudged"]
REFUSING = ["AHEAD", "DIVERGED"]


def state(missing: Column, relation: Column, judgement: Column, redundant: Column) -> Column:
    """The one state of a staged unit, by precedence."""
    return (
        F.when(missing, "incomplete").when(judgement == "invalid", "invalid").when(relation.isin(REFUSING), "would lose").when(judgement == "unlicensed", "unlicensed")
        .when(judgement.isin("unseen", "changed", "superseded", "unjudged"), "unjudged").when(redundant, "held already").otherwise("promotable")
    )


def promotable(relation: Column, judgement: Column) -> Column:
    """True where the relation costs the held copy nothing and no verdict stands against the unit."""
    return ~relation.isin(REFUSING) & judgement.isin("valid", "none")


def tally(units: DataFrame, column: str = "state") -> DataFrame:
    """state, n: every state is named, with 0 where no unit is in it."""
    dim = units.sparkSession.createDataFrame([(s,) for s in STATES], f"{column} string")
    counted = units.groupBy(column).agg(F.count("*").alias("n"))
    return dim.join(counted, column, "left").select(column, F.coalesce("n", F.lit(0).cast("long")).alias("n"))
