"""Units of an archive from a listing of its files and the declared selections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def declared(selections: DataFrame, providers: DataFrame) -> DataFrame:
    """selections(name, template, depth), providers(name, provider) -> name, provider, folder, depth: one store for each provider of a selection.

    ``<provider>`` in a template stands for the provider's name. A selection without a provider keeps its template and a
    null provider; nulls in a template give a null folder; empty tables give no rows.
    """
    stores = selections.select("name", "template", "depth").join(providers.select("name", "provider"), "name", "left")
    folder = F.when(F.col("provider").isNull(), F.col("template")).otherwise(F.replace("template", F.lit("<provider>"), F.col("provider")))
    return stores.select("name", "provider", folder.alias("folder"), "depth")


def _in_stores(files: DataFrame, stores: DataFrame) -> DataFrame:
    """path, name, provider, depth, rest: the files below a store's folder. Each file meets the stores through the folders above it, by equality."""
    steps = files.select("path").where("path is not null").distinct().withColumn("s", F.split("path", "/"))
    above = steps.where("size(s) > 1").select("path", F.posexplode(F.expr("transform(sequence(1, size(s) - 1), n -> array_join(slice(s, 1, n), '/'))")).alias("n", "folder"), "s")
    return above.join(stores, "folder").select("path", "name", "provider", "depth", F.expr("slice(s, n + 2, size(s))").alias("rest"), "folder")


def scanned(files: DataFrame, stores: DataFrame) -> DataFrame:
    """files(path), stores(name, provider, folder, depth) -> name, provider, address, files: files below a store's folder gathered by their first ``depth`` steps.

    Files less deep are units of their own; a file in two stores counts in both; repeated paths count once.
    """
    met = _in_stores(files, stores).withColumn("address", F.concat_ws("/", "folder", F.array_join(F.expr("slice(rest, 1, depth)"), "/")))
    return met.groupBy("name", "provider", "address").agg(F.count("path").alias("files"))


def all_units(files: DataFrame, stores: DataFrame) -> DataFrame:
    """name, provider, address, files, measure: the units of the stores, and each file that no store covers as a unit measured by its prefix."""
    of_stores = scanned(files, stores).withColumn("measure", F.lit("declared"))
    none = F.lit(None).cast("string")
    alone = files.select("path").where("path is not null").distinct().join(_in_stores(files, stores).select("path"), "path", "left_anti")
    return of_stores.union(alone.select(none, none, "path", F.lit(1).cast("bigint"), F.lit("prefix")))


def missing_parts(manifests: DataFrame, members: DataFrame, held: DataFrame) -> DataFrame:
    """manifests(unit, category), members(category, member), held(unit, member) -> unit, lacking: what a unit's categories promise and the unit does not hold.

    A category that is not known is lacking under its own name; repeated rows count once.
    """
    owed = manifests.select("unit", "category").distinct().join(members.select("category", "member").distinct(), "category", "left")
    named = owed.select("unit", F.coalesce("member", F.concat(F.lit("unknown category "), "category")).alias("lacking")).distinct()
    return named.join(held.select("unit", F.col("member").alias("lacking")), ["unit", "lacking"], "left_anti")
