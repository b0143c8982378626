"""Readers of archives: JSON arrays, JSON lines, strict CSV, alias lists, and files that belong in pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One row per element of each JSON array (or per lone object) below ``path``; malformed files raise.

    Spark gives a JSON array file to one task: very large arrays are better split into lines at the source.
    """
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("mode", "FAILFAST").json(path)


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line_id, value, state) of each non-blank line.

    state is 'record', 'truncated' for a last line of its file that is no JSON (a log still being written), or
    'fault' for any other. (block, line_id) orders the lines of a file; files are split among tasks.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_id"), "value"
    )
    lines = lines.where(F.trim("value") != "").withColumn("ok", F.try_parse_json("value").isNotNull())
    ends = lines.groupBy("file").agg(F.max(F.struct("block", "line_id")).alias("last")).withColumnRenamed("file", "_file")
    bad = lines.where(~F.col("ok")).join(ends, F.col("file") == F.col("_file")).drop("_file")
    bad = bad.withColumn("state", F.when(F.struct("block", "line_id") == F.col("last"), "truncated").otherwise("fault"))
    good = lines.where("ok").withColumn("state", F.lit("record"))
    columns = ["file", "block", "line_id", "value", "state"]
    return good.select(columns).union(bad.select(columns))


def csv_strict(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header that must match the schema; a row with surplus or missing fields raises."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def alias_lists(spark: SparkSession, path: str) -> DataFrame:
    """(head, aliases) of lines ``head = alias, alias # comment``; blank and comment lines are no rows."""
    bare = F.trim(F.regexp_replace("value", "#.*$", ""))
    lines = spark.read.text(path).select(bare.alias("line")).where("line <> ''")
    sides = F.split("line", "=", 2)
    aliases = F.filter(F.transform(F.split(F.coalesce(F.get(sides, 1), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return lines.select(F.trim(sides[0]).alias("head"), aliases.alias("aliases")).where("head <> ''")


def star(path: str, pattern: str):
    """What the one ``*`` of a file-name pattern matched in the last part of a path column; null where it does not fit."""
    before, after = pattern.split("*", 1)
    name = F.element_at(F.split(path, "/"), -1)
    fits = name.startswith(before) & name.endswith(after) & (F.length(name) >= len(before) + len(after))
    return F.when(fits, F.substring(name, F.lit(len(before) + 1), F.length(name) - len(before) - len(after)))


def paired(files: DataFrame, datum: str, record: str) -> DataFrame:
    """``path`` rows -> (star, datum, record, missing): files of the two patterns with the same starred part.

    missing names the absent side ('datum', 'record') or is null. Of several files for one side the first by path counts.
    """
    side = lambda pattern, name: files.withColumn("star", star("path", pattern)).where("star is not null").groupBy("star").agg(F.min("path").alias(name))
    both = side(datum, "datum").join(side(record, "record"), "star", "full_outer")
    return both.withColumn("missing", F.when(F.col("datum").isNull(), "datum").when(F.col("record").isNull(), "record"))
