"""Orders over a whole corpus without gathering it in one task: ordinals, spans of a global sequence, as-of lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ordinals(df: DataFrame, order: list[str], bucket: Column, among: Column) -> DataFrame:
    """df plus ordinal: the place of the rows of ``among`` in the order, null for others.

    ``bucket`` must not decrease along the order. Rows are numbered within their bucket; what earlier buckets
    hold comes from one count for each bucket, so no task sees more than a bucket.
    """
    marked = df.withColumn("_bucket", bucket).withColumn("_in", among)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = marked.where("_in").groupBy("_bucket").agg(F.count("*").alias("_n"))
    sizes = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_bucket", "_in").orderBy(*order))
    return marked.join(sizes, "_bucket", "left").withColumn("ordinal", F.when(F.col("_in"), F.col("_before") + place)).drop("_bucket", "_in", "_before")


def islands(df: DataFrame, key: str, at: str, order: list[str], bucket: Column) -> DataFrame:
    """island, key, first, last, n: runs of one key in the global order.

    Changes are found within each bucket; the first row of a bucket looks at the last key of the bucket before,
    which one row for each bucket carries.
    """
    marked = df.withColumn("_bucket", bucket)
    place = F.struct(*order)
    ends = marked.groupBy("_bucket").agg(F.max_by(key, place).alias("_end"))
    ends = ends.select("_bucket", F.lag("_end").over(Window.orderBy("_bucket")).alias("_prior"))
    inside = Window.partitionBy("_bucket").orderBy(*order)
    seen = marked.join(ends, "_bucket").withColumn("_prev", F.coalesce(F.lag(key).over(inside), "_prior"))
    seen = seen.withColumn("_new", (~F.col(key).eqNullSafe(F.col("_prev"))).cast("long")).withColumn("_run", F.sum("_new").over(inside))
    total = seen.groupBy("_bucket").agg(F.sum("_new").alias("_n"))
    total = total.select("_bucket", F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = seen.join(total, "_bucket").withColumn("island", F.col("_before") + F.col("_run"))
    return numbered.groupBy("island", key).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n"))


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """left plus ``value`` of the row of ``right`` with the same key that is nearest strictly before ``at``.

    Both sides are put in one sequence for each key and filled forward: one shuffle, linear in the rows. Of
    right rows at one instant the greatest value counts.
    """
    columns = left.columns
    held = right.groupBy(key, at).agg(F.max(value).alias(value))
    both = left.withColumn("_side", F.lit(0)).unionByName(held.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    # at one instant the left rows come first, so they see strictly earlier rows only
    past = Window.partitionBy(key).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = both.withColumn(value, F.last(value, ignorenulls=True).over(past))
    return filled.where("_side = 0").select(*columns, value)
