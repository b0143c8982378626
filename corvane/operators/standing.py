"""Where things stand: judgements by precedence, matrices of verdicts, owed runs, tallies, acts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import version_number


def judgement(units: DataFrame, record: DataFrame, published: DataFrame) -> DataFrame:
    """unit, judgement: the eight judgements by precedence.

    units: unit, pipeline, judged_by (a family of the pipeline judges it), digest. record: unit, digest, family,
    version, datum_digest, schema_digest, verdict, one row a verdict; a unit seen without a verdict has family
    null. published: family, version, schema_digest, and held_digest, the digest by which this checkout holds it.
    A unit is NONE without pipeline or family, UNSEEN without a record, CHANGED where digests differ, UNJUDGED
    without verdicts; then the first family in order that does not pass says CHANGED, UNJUDGED, UNLICENSED,
    SUPERSEDED or INVALID; all pass: VALID.
    """
    seen = record.select("unit", F.col("digest").alias("seen_digest"), "family", "version", "datum_digest", "schema_digest", "verdict", F.lit(True).alias("seen"))
    main = published.select("family", F.col("version").alias("main_version"), F.col("schema_digest").alias("main_digest"))
    both = units.join(seen, "unit", "left").join(main, "family", "left")
    differs = F.col("main_digest").isNull() | (F.col("schema_digest") != F.col("main_digest"))
    one = (
        F.when(F.col("datum_digest") != F.col("digest"), "CHANGED").when(F.col("schema_digest").isNull(), "UNJUDGED")
        .when(differs & (F.col("main_version") == F.col("version")), "UNJUDGED").when(differs & F.col("main_version").isNull(), "UNLICENSED")
        .when(differs & (version_number(F.col("version")) < version_number(F.col("main_version"))), "SUPERSEDED").when(differs, "UNLICENSED")
        .when(F.col("verdict") != "valid", "INVALID")
    )
    whole = (
        F.when(F.col("pipeline").isNull() | ~F.col("judged_by"), "NONE").when(F.col("seen").isNull(), "UNSEEN")
        .when(F.col("seen_digest") != F.col("digest"), "CHANGED").when(F.col("family").isNull(), "UNJUDGED")
    )
    both = both.select("unit", whole.alias("whole"), F.when(one.isNotNull(), F.struct("family", one.alias("one"))).alias("fault"))
    found = both.groupBy("unit").agg(F.min("whole").alias("whole"), F.min("fault").alias("fault"))
    return found.select("unit", F.coalesce("whole", "fault.one", F.lit("VALID")).alias("judgement"))


def matrix(verdicts: DataFrame, latest: DataFrame) -> DataFrame:
    """(schema, version, item, verdict, at) -> schema, item, version, symbol, is_latest: the last verdict of each cell.

    symbol is a tick, a cross, or a question mark for a verdict that is neither.
    """
    last = verdicts.groupBy("schema", "item", "version").agg(F.max_by("verdict", "at").alias("verdict"))
    symbol = F.when(F.col("verdict") == "valid", "✓").when(F.col("verdict") == "invalid", "✗").otherwise("?")
    newest = latest.select("schema", F.col("version").alias("newest"))
    return last.join(newest, "schema", "left").select("schema", "item", "version", symbol.alias("symbol"), F.coalesce(F.col("version") == F.col("newest"), F.lit(False)).alias("is_latest"))


def latest_versions(versions: DataFrame) -> DataFrame:
    """(schema, version) -> schema, version: the greatest by number, not by name."""
    return versions.groupBy("schema").agg(F.max_by("version", F.struct(version_number(F.col("version")).alias("n"), "version")).alias("version"))


def owed_validations(items: DataFrame, records: DataFrame) -> DataFrame:
    """(item, digest, schema, schema_digest) less those with a record of the same item, schema and both digests: what is to be validated."""
    keys = ["item", "schema", "digest", "schema_digest"]
    return items.join(records.select(*keys).distinct(), keys, "left_anti")


def owed(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """(unit, digest), (unit, digest) -> unit, why: inputs without an output, or whose digest is none of those their output was made of."""
    made = outputs.select("unit", F.lit(True).alias("made")).distinct()
    same = outputs.select("unit", "digest", F.lit(True).alias("same")).distinct()
    both = inputs.select("unit", "digest").join(made, "unit", "left").join(same, ["unit", "digest"], "left")
    return both.where("made is null or same is null").select("unit", F.when(F.col("made").isNull(), "unprocessed").otherwise("changed since its output").alias("why"))


def audit_totals(items: DataFrame, verdicts: DataFrame, latest: DataFrame) -> DataFrame:
    """One row: items, at_latest (a verdict at the latest version of their schema), valid, processed (any verdict)."""
    at = verdicts.join(latest, ["schema", "version"], "left_semi").groupBy("schema", "item").agg(F.max(F.col("verdict") == "valid").alias("ok"))
    seen = verdicts.select("schema", "item").distinct().withColumn("seen", F.lit(True))
    both = items.select("schema", "item").distinct().join(at, ["schema", "item"], "left").join(seen, ["schema", "item"], "left")
    return both.agg(F.count("*").alias("items"), F.count("ok").alias("at_latest"), F.count_if("ok").alias("valid"), F.count("seen").alias("processed"))


def kind_counts(units: DataFrame, kind: str, judged: str, states: list[str]) -> DataFrame:
    """kind and a column for each state with how many units are in it; every state is named."""
    return units.groupBy(kind).agg(*[F.count_if(F.col(judged) == s).alias(s.replace("-", "_")) for s in states])


def census(files: DataFrame, by: list[str], size: str) -> DataFrame:
    """by, n, bytes."""
    return files.groupBy(*by).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col(size).cast("long")), F.lit(0).cast("long")).alias("bytes"))


def fault_groups(faults: DataFrame) -> DataFrame:
    """(pos, stage, subject, fault) -> stage, fault, subjects, n: subjects with the same fault joined in the order they were first met."""
    first = faults.groupBy("stage", "fault", "subject").agg(F.min("pos").alias("pos"))
    found = first.groupBy("stage", "fault").agg(F.sort_array(F.collect_list(F.struct("pos", "subject"))).alias("s"), F.count("*").alias("n"))
    return found.select("stage", "fault", F.array_join(F.col("s.subject"), ", ").alias("subjects"), "n")


def survey(records: DataFrame, line: str, type_key: str) -> DataFrame:
    """type, records, keys: how many JSON objects of each type there are, and all keys they have at the top, sorted."""
    df = records.select(F.get_json_object(line, f"$.{type_key}").alias("type"), F.json_object_keys(line).alias("keys"))
    counted = df.groupBy("type").agg(F.count("*").alias("records"))
    keys = df.select("type", F.explode("keys").alias("k")).distinct().groupBy("type").agg(F.array_join(F.sort_array(F.collect_list("k")), ",").alias("keys"))
    return counted.join(keys, counted.type.eqNullSafe(keys.type), "left").select(counted.type, "records", "keys")


def acts(rows: DataFrame, once: bool = False) -> DataFrame:
    """(modality, command, thing, n) -> the same, acts of one thing folded: counts added, or the greater kept where one unit is named twice."""
    total = F.max("n") if once else F.sum("n")
    return rows.groupBy("modality", "command", "thing").agg(total.cast("long").alias("n"))


def staged_acts(units: DataFrame) -> DataFrame:
    """(unit, kind, state) -> modality, command, thing, n: what may or must be done about staged units."""
    act = (
        F.when(F.col("state") == "promotable", F.struct(F.lit("MAY").alias("modality"), F.lit("promote").alias("command")))
        .when(F.col("state").isin("unjudged", "unlicensed"), F.struct(F.lit("MAY").alias("modality"), F.lit("rehearse").alias("command")))
        .when(F.col("state") == "incomplete", F.struct(F.lit("MUST").alias("modality"), F.lit("capture again").alias("command")))
        .when(F.col("state").isin("invalid", "would lose"), F.struct(F.lit("MUST").alias("modality"), F.lit("look into").alias("command")))
    )
    named = units.select(act.alias("a"), F.col("kind").alias("thing"), F.lit(1).alias("n")).where("a is not null")
    return acts(named.select("a.modality", "a.command", "thing", "n"))


def orphans(present: DataFrame, owned: DataFrame) -> DataFrame:
    """path: files that no owner names, themselves or by a folder above them."""
    parts = F.split("path", "/")
    above = present.select("path", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("owner"))
    return present.select("path").distinct().join(above.join(owned.select(F.col("path").alias("owner")).distinct(), "owner", "left_semi").select("path"), "path", "left_anti")


def difference(declared: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """key, side: what only one side names: 'undone' (declared alone) or 'undeclared'."""
    both = declared.select(key, F.lit(1).alias("d")).distinct().join(found.select(key, F.lit(1).alias("f")).distinct(), key, "full_outer")
    return both.where("d is null or f is null").select(key, F.when(F.col("f").isNull(), "undone").otherwise("undeclared").alias("side"))


def resolved(typed: DataFrame, ids: DataFrame) -> DataFrame:
    """(typed), (id) -> typed, id: the one id that begins with what was typed; null where none or several do. A whole id is itself.

    Whole ids join by equality. What is left joins on the beginnings of ids of the lengths that were typed, each length once; a text longer
    than every id is none. Nulls resolve to null.
    """
    asked, known = typed.select("typed").distinct(), ids.select("id").where("id is not null").distinct()
    whole = asked.join(known, F.col("typed") == F.col("id"))
    part = asked.join(whole.select("typed"), "typed", "left_anti")
    longest = known.agg(F.max(F.length("id"))).first()[0] or 0
    # at most as many rows as the longest id has characters
    lengths = part.select(F.length("typed").alias("n")).where(F.col("n") <= longest).distinct()
    begins = known.join(F.broadcast(lengths), F.length("id") >= F.col("n")).select("id", F.expr("left(id, n)").alias("typed"))
    found = part.join(begins, "typed", "left").groupBy("typed").agg(F.count("id").alias("c"), F.max("id").alias("id"))
    return whole.union(found.select("typed", F.when(F.col("c") == 1, F.col("id")).alias("id")))


def word_table_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(side, word, count) of both -> side, entered, left, moved: how many words came, went, or changed their count."""
    both = old.select("side", "word", F.col("count").alias("a")).join(new.select("side", "word", F.col("count").alias("b")), ["side", "word"], "full_outer")
    return both.groupBy("side").agg(
        F.count_if(F.col("a").isNull()).alias("entered"), F.count_if(F.col("b").isNull()).alias("left"), F.count_if(F.col("a") != F.col("b")).alias("moved"))


def table_diff_totals(old: DataFrame, new: DataFrame, key: str, group: str, measures: list[str]) -> DataFrame:
    """group, added, removed, changed and the change of each measure's total, by the group of the new row (of the old where it is gone)."""
    a, b = (df.select(key, F.struct(group, *measures).alias(n)) for df, n in ((old, "a"), (new, "b")))
    both = a.join(b, key, "full_outer")
    delta = [(F.coalesce(F.sum(f"b.{m}"), F.lit(0)) - F.coalesce(F.sum(f"a.{m}"), F.lit(0))).cast("long").alias(m) for m in measures]
    return both.groupBy(F.coalesce(f"b.{group}", f"a.{group}").alias(group)).agg(
        F.count_if(F.col("a").isNull()).alias("added"), F.count_if(F.col("b").isNull()).alias("removed"),
        F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).alias("changed"), *delta)


def columns_changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """column, change: columns that one of the two tables lacks."""
    rows = [(c, "removed") for c in old.columns if c not in new.columns] + [(c, "added") for c in new.columns if c not in old.columns]
    return old.sparkSession.createDataFrame(rows, "column string, change string")


def reference_drift(recorded: DataFrame, fetched: DataFrame, keys: list[str]) -> DataFrame:
    """keys, state: 'missing' where nothing was fetched, 'drifted' where its sha is another."""
    both = recorded.select(*keys, F.col("sha").alias("r")).join(fetched.select(*keys, F.col("sha").alias("f"), F.lit(True).alias("there")), keys, "left")
    return both.where("there is null or r <> f or f is null").select(*keys, F.when(F.col("there").isNull(), "missing").otherwise("drifted").alias("state"))


def remedy(state: Column, setting: Column, declared: Column) -> Column:
    """What to do about a setting: set it where it drifts, look where it could not be verified, else null."""
    return F.when(state == "DRIFT", F.concat(F.lit("set "), setting, F.lit(" to "), declared.cast("string"))).when(state == "UNVERIFIED", F.concat(F.lit("look at "), setting))
