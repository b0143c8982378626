"""What an archive's library holds: folders resolved to conversations, exports taken apart, harvests, pairs, shown lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.operators.ordering import ordinals


def resolved_folders(folders: DataFrame, chats: DataFrame) -> DataFrame:
    """(folder), (chat, uuid) -> folder, chat, how: the conversation whose uuid begins with the folder's last or else its first eight characters.

    how is 'suffix', 'prefix', or 'unknown' with a null chat. Of several conversations with one beginning the least counts.
    """
    known = chats.where("uuid is not null").groupBy(F.expr("left(uuid, 8)").alias("key")).agg(F.min("chat").alias("chat"))
    side = lambda name: known.select(F.col("key").alias(name), F.col("chat").alias(f"by_{name}"))
    cut = folders.select("folder", F.expr("right(folder, 8)").alias("suffix"), F.expr("left(folder, 8)").alias("prefix"))
    both = cut.join(side("suffix"), "suffix", "left").join(side("prefix"), "prefix", "left")
    how = F.when(F.col("by_suffix").isNotNull(), "suffix").when(F.col("by_prefix").isNotNull(), "prefix").otherwise("unknown")
    return both.select("folder", F.coalesce("by_suffix", "by_prefix").alias("chat"), how.alias("how"))


def atomised(exports: DataFrame, key: str, array: str) -> DataFrame:
    """(key, JSON array) -> key, place, uuid, name, valid: one row for each element; null arrays and those that are no JSON give none.

    valid says that the element names its uuid and holds its messages.
    """
    items = exports.select(key, F.posexplode(F.from_json(array, "array<string>")).alias("place", "item"))
    of = lambda path: F.get_json_object("item", path)
    valid = (F.coalesce(of("$.uuid"), F.lit("")) != "") & of("$.chat_messages").isNotNull()
    return items.select(key, "place", of("$.uuid").alias("uuid"), of("$.name").alias("name"), valid.alias("valid"))


def asset_handles(messages: DataFrame, keys: list[str], files: str) -> DataFrame:
    """keys, url: of each file (document_url, preview_url, thumbnail_url) the first address it has; files without any are left out."""
    spread = messages.select(*keys, F.explode(files).alias("f"))
    return spread.select(*keys, F.coalesce("f.document_url", "f.preview_url", "f.thumbnail_url").alias("url")).where("url is not null")


def legacy_numbers(chats: DataFrame, order: list[str], bucket: Column, empty: Column) -> DataFrame:
    """chats plus ordinal, without the empty ones: they took a number each before they went."""
    numbered = ordinals(chats.withColumn("_empty", F.coalesce(empty, F.lit(False))), order, bucket, F.lit(True))
    return numbered.where("not _empty").drop("_empty")


def listed_first(captures: DataFrame, listing: DataFrame, key: str, bucket: Column) -> DataFrame:
    """(key), (key, place) -> key, ordinal: the listed by their place, the others by key after the last place of the listing, captured or not."""
    both = captures.select(key).distinct().join(listing.groupBy(key).agg(F.min("place").alias("place")), key, "left")
    last = listing.agg(F.coalesce(F.max("place"), F.lit(0)).alias("last"))
    rest = ordinals(both.where("place is null"), [key], bucket, F.lit(True)).join(last).select(key, (F.col("last") + F.col("ordinal")).alias("ordinal"))
    return both.where("place is not null").select(key, F.col("place").alias("ordinal")).union(rest)


def harvested(files: DataFrame, extraction: DataFrame, library: DataFrame, reasons: DataFrame, key: str) -> DataFrame:
    """key, standing: 'in extraction', 'library only', or 'unharvested: ' and the reason on record ('unknown' where there is none)."""
    flag = lambda df, name: df.select(key, F.lit(True).alias(name)).distinct()
    why = reasons.groupBy(key).agg(F.min("reason").alias("reason"))
    both = files.select(key).distinct().join(flag(extraction, "e"), key, "left").join(flag(library, "l"), key, "left").join(why, key, "left")
    none = F.concat(F.lit("unharvested: "), F.coalesce("reason", F.lit("unknown")))
    return both.select(key, F.when(F.col("e"), "in extraction").when(F.col("l"), "library only").otherwise(none).alias("standing"))


def capture_lag(corpus: DataFrame, covered: DataFrame, group: str) -> DataFrame:
    """group, lag: how many more rows the corpus has than the capture covers; never below 0."""
    count = lambda df, name: df.groupBy(group).agg(F.count("*").alias(name))
    both = count(corpus, "c").join(count(covered, "v"), group, "left")
    return both.select(group, F.greatest(F.col("c") - F.coalesce("v", F.lit(0)), F.lit(0)).alias("lag"))


def pair_census(pairs: DataFrame) -> DataFrame:
    """(datum, record, categories, members) -> standing, n: pairs that lack a side, categories without members in the archive, or nothing.

    Null arrays hold nothing.
    """
    empty = F.array().cast("array<string>")
    lost = F.size(F.array_except(F.coalesce("categories", empty), F.coalesce("members", empty)))
    standing = F.when(F.col("datum").isNull(), "no datum").when(F.col("record").isNull(), "no record").when(lost > 0, "incomplete").otherwise("complete")
    return pairs.groupBy(standing.alias("standing")).agg(F.count("*").alias("n"))


def segments(lines: DataFrame, key: str, place: str, line: str, signed: Column) -> DataFrame:
    """key, message, first, last, signatures: a text line that follows a signature opens the next message (from 0); a chain of signatures stays with its own."""
    within = Window.partitionBy(key).orderBy(place)
    marked = lines.select(key, place, F.coalesce(signed, F.lit(False)).alias("s"), (F.trim(F.coalesce(line, F.lit(""))) != "").alias("t"))
    said = marked.where("s or t")  # blank lines belong to no side
    opens = ~F.col("s") & F.coalesce(F.lag("s").over(within), F.lit(False))
    numbered = said.withColumn("o", opens).withColumn("message", F.sum(F.col("o").cast("int")).over(within))
    return numbered.groupBy(key, "message").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count_if("s").alias("signatures"))


def title_range(chats: DataFrame, by: list[str], at: str) -> DataFrame:
    """by, n, since, until: how many conversations, and between which days."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return chats.groupBy(*by).agg(F.count("*").alias("n"), day(F.min(at)).alias("since"), day(F.max(at)).alias("until"))


def first_shown(rows: DataFrame, group: str, label: str, shown: int = 4) -> DataFrame:
    """group, names: the first labels in order, an ellipsis after them where there are more; equal labels stand once."""
    ranked = rows.select(group, label).where(F.col(label).isNotNull()).distinct().withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy(label)))
    top = ranked.where(F.col("r") <= shown + 1).groupBy(group).agg(F.sort_array(F.collect_list(label)).alias("n"))
    named = F.array_join(F.slice("n", 1, shown), ", ")
    return top.select(group, F.concat(named, F.when(F.size("n") > shown, ", …").otherwise("")).alias("names"))


def surplus(files: DataFrame, read: DataFrame) -> DataFrame:
    """(unit, name): files of units that have a measure and do not read them; units of which nothing is read have none."""
    measured = files.join(read.select("unit").distinct(), "unit", "left_semi")
    return measured.join(read.select("unit", "name").distinct(), ["unit", "name"], "left_anti").select("unit", "name").distinct()


def created_files(blocks: DataFrame, keys: list[str], content: str) -> DataFrame:
    """keys, path, text: the file-creating calls among content blocks (type, name, path, text) that name a path."""
    spread = blocks.select(*keys, F.explode(content).alias("b"))
    return spread.where("b.type = 'tool_use' and b.name = 'create_file' and trim(b.path) <> ''").select(*keys, F.col("b.path").alias("path"), F.col("b.text").alias("text"))


def index_standing(books: DataFrame) -> DataFrame:
    """(book, judged, rendered) digests -> book, standing: 'waits' without a judged index, 'current' where the text is what it renders, else 'stale'."""
    standing = F.when(F.col("judged").isNull(), "waits").when(F.col("judged").eqNullSafe(F.col("rendered")), "current").otherwise("stale")
    return books.select("book", standing.alias("standing"))


def memory_markdown(fields: DataFrame, stamp: str) -> DataFrame:
    """(stamp, account, field, text) -> stamp, markdown: a heading for each account and each field, each only where the state has several."""
    kept = fields.where("trim(text) <> ''")
    sized = kept.groupBy(stamp).agg(F.sort_array(F.collect_list(F.struct("account", "field", "text"))).alias("f"), F.count_distinct("account").alias("a"))
    section = F.transform("f", lambda x, i: F.concat(
        F.when((F.col("a") > 1) & ((i == 0) | (F.get(F.col("f"), i - 1)["account"] != x["account"])), F.concat(F.lit("# "), x["account"], F.lit("\n\n"))).otherwise(""),
        F.when(F.size(F.filter("f", lambda y: y["account"] == x["account"])) > 1, F.concat(F.lit("## "), x["field"], F.lit("\n\n"))).otherwise(""), F.trim(x["text"])))
    return sized.select(stamp, F.array_join(section, "\n\n").alias("markdown"))


def layers(definitions: DataFrame, description: str, pattern: str = r"^\[([^\]]+)\]") -> DataFrame:
    """layer, n: how many definitions each layer that a description names has; '(none)' for those that name none."""
    layer = F.coalesce(F.nullif(F.regexp_extract(description, pattern, 1), F.lit("")), F.lit("(none)"))
    return definitions.groupBy(layer.alias("layer")).agg(F.count("*").alias("n"))
