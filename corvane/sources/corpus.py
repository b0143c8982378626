"""Scans of a corpus of conversations in markdown: ``<provider>/<channel>/conversations/<number>-<slug>.md`` below a root."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.functions.text import conversation_id
from corvane.operators.projection import markdown_turns

#: Characters of a file in which its title and identity stand.
HEAD = 600


def markdown_files(spark: SparkSession, root: str) -> DataFrame:
    """(provider, channel, stem, md) of every file with a number and a hyphen before its name; files elsewhere below the root are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(root)
    parts = files.select(F.decode("content", "UTF-8").alias("value"), F.split("path", "/").alias("p"))
    depth = len([x for x in root.split("://")[-1].split("/") if x])
    below = F.filter("p", lambda x, i: (x != "") & ~((i == 0) & x.endswith(":")))
    parts = parts.select("value", F.slice(below, depth + 1, F.size(below)).alias("p")).where("size(p) = 4 and p[2] = 'conversations'")
    stem = F.regexp_replace(F.col("p")[3], r"\.md$", "")
    return parts.select(F.col("p")[0].alias("provider"), F.col("p")[1].alias("channel"), stem.alias("stem"), F.col("value").alias("md")).where(F.col("stem").rlike(r"^[0-9]+-"))


def index(files: DataFrame, first: str) -> DataFrame:
    """files (of ``markdown_files``) -> ordinal, stem, title, id: the conversations with a title and an identity near their start.

    Ordinals are 1 to N: the provider ``first``, then the others by name, their channels by name, files by name. Each channel is
    numbered alone, in a task of one short row a file; the numbers before it are added from one row a channel.
    """
    head = F.substring("md", 1, HEAD)
    title = F.nullif(F.regexp_extract(head, r"(?m)^# (.+)$", 1), F.lit(""))
    found = files.select("provider", "channel", "stem", title.alias("title"), conversation_id(head).alias("id")).where("title is not null and id is not null")
    found = found.withColumn("n", F.row_number().over(Window.partitionBy("provider", "channel").orderBy("stem")))
    before = F.sum("k").over(Window.orderBy(F.col("provider") != first, "provider", "channel").rowsBetween(Window.unboundedPreceding, -1))
    sizes = found.groupBy("provider", "channel").agg(F.count("*").alias("k")).withColumn("before", F.coalesce(before, F.lit(0)))
    placed = found.join(sizes, ["provider", "channel"])
    return placed.select((F.col("before") + F.col("n")).alias("ordinal"), F.concat_ws("/", "provider", "channel", "stem").alias("stem"), "title", "id")


def listing(found: DataFrame) -> DataFrame:
    """index -> ordinal, line: ``n: title`` as a list shows it."""
    return found.select("ordinal", F.concat(F.col("ordinal").cast("string"), F.lit(": "), "title").alias("line"))


def book(files: DataFrame, channel: str = "chat") -> DataFrame:
    """The turns of one channel's files: source, stem, and what ``projection.markdown_turns`` tells of each turn."""
    own = files.where(F.col("channel") == channel).select(F.struct("provider", "stem").alias("conv_id"), "md")
    turns = markdown_turns(own)
    return turns.select(F.col("conv_id.provider").alias("source"), F.col("conv_id.stem").alias("stem"), *[c for c in turns.columns if c != "conv_id"])
