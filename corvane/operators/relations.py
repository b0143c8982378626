"""How two snapshots of the same thing stand to each other; copies held twice; keyed table differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lattice(absent: Column, below: Column, above: Column) -> Column:
    """ABSENT, IDENTICAL, EXTENDS (held <= staged), AHEAD (staged <= held) or DIVERGED."""
    return F.when(absent, "ABSENT").when(below & above, "IDENTICAL").when(below, "EXTENDS").when(above, "AHEAD").otherwise("DIVERGED")


def by_prefix(staged: DataFrame, held: DataFrame, key: str, text: str) -> DataFrame:
    """key, relation under the prefix order."""
    joined = staged.select(key, F.col(text).alias("s")).join(held.select(key, F.col(text).alias("h")), key, "left")
    return joined.select(key, lattice(F.col("h").isNull(), F.startswith("s", "h"), F.startswith("h", "s")).alias("relation"))


def by_atoms(staged: DataFrame, held: DataFrame, unit: str, atom: str) -> DataFrame:
    """unit, relation, new, missing under inclusion of atom sets; one full join, counted on the fly."""
    s = staged.select(unit, atom).distinct().withColumn("in_s", F.lit(1))
    h = held.select(unit, atom).distinct().withColumn("in_h", F.lit(1))
    both = s.join(h, [unit, atom], "full_outer").groupBy(unit).agg(
        F.count("in_h").alias("n_held"),
        F.count("in_s").alias("n_staged"),
        F.count_if(F.col("in_h").isNull()).alias("new"),
        F.count_if(F.col("in_s").isNull()).alias("missing"),
    )
    kind = lattice(F.col("n_held") == 0, F.col("missing") == 0, F.col("new") == 0)
    return both.where("n_staged > 0").select(unit, kind.alias("relation"), "new", "missing")


def held_twice(units: DataFrame, key: str, text: str) -> DataFrame:
    """key, holder: units whose text the unit with the least key holds too. Texts travel as digests."""
    digests = units.select(key, F.sha2(F.coalesce(text, F.lit("")), 256).alias("h"))
    least = digests.groupBy("h").agg(F.min(key).alias("holder"), F.count("*").alias("n")).where("n > 1")
    return digests.join(least, "h").where(F.col(key) != F.col("holder")).select(key, "holder")


def lag(page: DataFrame, corpus: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """key, state: absent (from the page), gone (from the corpus), regressed (any metric fell), lagging, or current."""
    a = page.select(key, F.struct(*metrics).alias("p"))
    b = corpus.select(key, F.struct(*metrics).alias("c"))
    fell = F.lit(False)
    for m in metrics:
        fell = fell | (F.col(f"c.{m}") < F.col(f"p.{m}"))
    state = F.when(F.col("p").isNull(), "absent").when(F.col("c").isNull(), "gone").when(fell, "regressed").when(F.col("p") != F.col("c"), "lagging").otherwise("current")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))


def table_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, column, before, after: changed cells of shared columns; added and removed rows have column null."""
    shared = [c for c in old.columns if c in new.columns and c != key]
    a = old.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in shared]).alias("a"))
    b = new.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in shared]).alias("b"))
    joined = a.join(b, key, "full_outer")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"a.{c}").alias("before"), F.col(f"b.{c}").alias("after")) for c in shared])
    changed = joined.where("a is not null and b is not null").select(key, F.inline(F.filter(cells, lambda x: ~x["before"].eqNullSafe(x["after"]))))
    whole = joined.where("a is null or b is null").select(
        key, F.lit(None).cast("string").alias("column"), F.when(F.col("a").isNotNull(), "held").alias("before"), F.when(F.col("b").isNotNull(), "held").alias("after")
    )
    return changed.union(whole)


def reconcile(declared: DataFrame, live: DataFrame, key: str, value: str) -> DataFrame:
    """key, state: OK, DRIFT, or UNVERIFIED where the live side has no such setting."""
    joined = declared.select(key, F.col(value).alias("d")).join(live.select(key, F.col(value).alias("l"), F.lit(True).alias("seen")), key, "left")
    return joined.select(key, F.when(F.col("seen").isNull(), "UNVERIFIED").when(F.col("d").eqNullSafe(F.col("l")), "OK").otherwise("DRIFT").alias("state"))


def currency(mine: DataFrame, other: DataFrame, unit: str, atom: str, at: str, label: str) -> DataFrame:
    """unit, currency: how a unit's messages stand to those the other corpus holds; one full join, counted on the fly."""
    a = mine.select(unit, atom).distinct().withColumn("in_m", F.lit(1))
    b = other.groupBy(unit, atom).agg(F.max(at).alias("at")).withColumn("in_o", F.lit(1))
    both = a.join(b, [unit, atom], "full_outer").groupBy(unit).agg(
        F.count("in_m").alias("m"),
        F.count("in_o").alias("o"),
        F.count_if(F.col("in_o").isNull()).alias("here"),
        F.count_if(F.col("in_m").isNull()).alias("there"),
        F.max(F.when(F.col("in_m").isNull(), F.col("at"))).alias("newest"),
    )
    said = (
        F.when(F.col("o") == 0, f"no-{label}").when((F.col("here") == 0) & (F.col("there") == 0), "in-sync")
        .when(F.col("there") == 0, F.format_string(f"ahead-of-{label}: +%d messages here", "here"))
        .when(F.col("here") == 0, F.format_string(f"stale: {label} holds %d newer messages (through %sZ)", "there", F.substring("newest", 1, 19)))
        .otherwise(f"anomaly: unique messages both here and in the {label}")
    )
    return both.where("m > 0").select(unit, said.alias("currency"))
