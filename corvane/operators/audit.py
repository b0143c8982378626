"""The file audit over (chat, chat_name, source, path, in_dl, dl_compare): tallies, one-sided paths, and the pivot.

Two files are the same one where chat and path are equal; a null path is equal to none. Repeated rows count each
time. ``source`` is 'tooltip' for what a conversation shows, anything else for what lies on disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sources in column order.
SOURCES = ["tooltip", "ef", "eh_out", "eh_wrk", "dl"]
CHAT = ["chat", "chat_name"]


def tally(audit: DataFrame, sources: list[str], column: str, classes: dict[str, str]) -> DataFrame:
    """chat, chat_name, extracted, and for each name of ``classes`` how many rows of these sources hold its value in ``column``."""
    counts = [F.count_if(F.col(column) == value).alias(name) for name, value in classes.items()]
    return audit.where(F.col("source").isin(sources)).groupBy(CHAT).agg(F.count("*").alias("extracted"), *counts)


def shown(audit: DataFrame) -> DataFrame:
    """The rows of paths that a conversation shows."""
    return audit.where("source = 'tooltip'")


def on_disk(audit: DataFrame) -> DataFrame:
    """The rows of files found in any of the four places on disk."""
    return audit.where(F.col("source").isin(SOURCES[1:]))


def without_twin(rows: DataFrame, others: DataFrame) -> DataFrame:
    """The rows whose chat and path the others lack; the others travel once for each file."""
    return rows.join(others.select("chat", "path").distinct(), ["chat", "path"], "left_anti")


def pivoted(audit: DataFrame) -> DataFrame:
    """A row for each (chat, chat_name, base): the sorted paths of each source, joined by a bar; null where it has none."""
    named = audit.withColumn("base", F.element_at(F.split("path", "/"), -1))
    joined = F.array_join(F.array_sort(F.collect_set("path")), " | ")
    wide = named.groupBy("chat", "chat_name", "base").pivot("source", SOURCES).agg(joined)
    return wide.select("chat", "chat_name", "base", *[F.nullif(F.col(s), F.lit("")).alias(s) for s in SOURCES])
