"""Deposits of one key over time: what is new, what repeats, what conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def deposits(df: DataFrame, key: str, order: list[str], content: str) -> DataFrame:
    """df plus verdict: deposited where the content differs from the one before it, else unchanged."""
    before = F.lag(content).over(Window.partitionBy(key).orderBy(*order))
    first = F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1
    return df.withColumn("verdict", F.when(first | ~F.col(content).eqNullSafe(before), "deposited").otherwise("unchanged"))


def conflicts(df: DataFrame, key: str, stamp: str, content: str) -> DataFrame:
    """key, stamp, contents: stamps that hold more than one content."""
    return df.groupBy(key, stamp).agg(F.countDistinct(content).alias("contents")).where("contents > 1")


def fill_forward(df: DataFrame, key: str, order: list[str], marker: str) -> DataFrame:
    """df plus section: the last non-null marker so far."""
    past = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("section", F.last(marker, ignorenulls=True).over(past))


def accumulated(readings: DataFrame, key: str, stamp: str, arrival: str, content: str) -> DataFrame:
    """readings plus verdict: deposited, unchanged or conflict.

    Of several readings at one stamp the first to arrive counts; others with its content are unchanged, with
    another content conflicts, and write nothing. What counts is compared with the one at the nearest earlier
    stamp, so A, B, A deposits three times; a reading that arrives late is judged by its own place and leaves
    later ones as they were. Null contents are contents of their own.
    """
    one = F.struct(arrival, content)
    first = readings.groupBy(key, stamp).agg(F.min(one).alias("_first"))
    before = F.lag(F.struct(F.col(f"_first.{content}").alias("c"))).over(Window.partitionBy(key).orderBy(stamp))
    first = first.withColumn("_before", before)
    both = readings.join(first, [key, stamp])
    counts = F.col(arrival) == F.col(f"_first.{arrival}")
    same = F.col(content).eqNullSafe(F.col(f"_first.{content}"))
    news = F.col("_before").isNull() | ~F.col(content).eqNullSafe(F.col("_before.c"))
    verdict = F.when(counts & news, "deposited").when(same, "unchanged").otherwise("conflict")
    return both.withColumn("verdict", verdict).select(*readings.columns, "verdict")


def rolling(readings: DataFrame, deposits: DataFrame, key: str, stamp: str, content: str) -> DataFrame:
    """key, stamp, content: the latest reading of each key, kept only while its content is not among the key's deposits."""
    last = readings.groupBy(key).agg(F.max_by(F.struct(stamp, content), stamp).alias("l")).select(key, f"l.{stamp}", f"l.{content}")
    return last.join(deposits.select(key, content).distinct(), [key, content], "left_anti").select(key, stamp, content)
