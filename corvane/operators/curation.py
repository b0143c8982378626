"""Headwords under curation: locators by whole words, concepts anchored by phrasings, accepting and rejecting, the queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import phrasings
from corvane.session import settled

TOKEN = r"[\p{L}\p{N}_]+"
#: Two neighbouring words of a text with what stands between them, at each word that has one after it.
PAIR = r"(?<![\p{L}\p{N}_])(?=([\p{L}\p{N}_]++[^\p{L}\p{N}_]++[\p{L}\p{N}_]++))"
#: Puts marks around the words of a text, so that a term with its own marks stands in it as whole words or not at all.
MARK = "\x1f"


def marked(text: str) -> Column:
    """The text in lower case, each run of letters, digits and underscores between marks."""
    return F.regexp_replace(F.lower(text), f"({TOKEN})", f"{MARK}$1{MARK}")


def grams(low: str) -> Column:
    """Words and pairs of neighbouring words of a column in lower case, each once."""
    return F.array_distinct(F.concat(F.regexp_extract_all(low, F.lit(TOKEN), F.lit(0)), F.regexp_extract_all(low, F.lit(PAIR), F.lit(1))))


def term_locators(texts: DataFrame, terms: DataFrame, text_key: str = "doc_id", term_key: str = "item_id") -> DataFrame:
    """(text_key, text), (term_key, term) -> term_key, text_key: the texts in which one of the key's terms stands, whole words, in lower case.

    A term of one or two words without anything before or after them is a word or a pair of neighbouring words of
    any text that holds it, so these join by equality and texts do not travel. Other terms join on their longest
    word or pair, whatever their number of words; the marked text then decides. Terms without any word are
    tried against every text, which Spark does by broadcast while they are few. Empty terms match nothing.
    """
    named = terms.select(F.col(term_key).alias("k_"), F.lower("term").alias("t_")).where("trim(t_) <> ''").distinct()
    longest = F.array_max(F.transform(grams("t_"), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    # a term that is one of its own words or pairs needs no text
    named = named.select("k_", "t_", marked("t_").alias("p_"), longest.alias("w_"), (longest == F.col("t_")).alias("whole"))
    rows = texts.select(F.col(text_key).alias("x_"), "text").where("text is not null")
    spread = rows.select("x_", F.lower("text").alias("low")).select("x_", F.explode(grams("low")).alias("w_"))
    # the texts are read for their words once
    near = settled(spread.join(named.where("w_ is not null"), "w_").select("x_", "k_", "p_", "whole").distinct())
    found = near.where("whole").select("k_", "x_")
    # a text is marked once, before it meets the terms that its words allow
    pairs = near.where("not whole").select("x_", "k_", "p_")
    checked = rows.select("x_", marked("text").alias("m_")).join(pairs, "x_").where("contains(m_, p_)")
    odd = rows.select("x_", F.lower("text").alias("low")).join(named.where("w_ is null").select("k_", "t_"), F.expr("contains(low, t_)"))
    found = found.union(checked.select("k_", "x_")).union(odd.select("k_", "x_"))
    return found.distinct().select(F.col("k_").alias(term_key), F.col("x_").alias(text_key))


def terms_of(heads: DataFrame, key: str = "item_id") -> DataFrame:
    """(key, head, aliases) -> key, term: the headword and its aliases."""
    return heads.select(key, F.explode(F.concat(F.array("head"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("term"))


def concept_table(locators: DataFrame, provider: str, key: str = "item_id") -> DataFrame:
    """key, count, provider: locators of each headword, and its one provider or 'both'; headwords without any are absent."""
    one = F.count_distinct(provider) == 1
    return locators.groupBy(key).agg(F.count("*").alias("count"), F.when(one, F.min(provider)).otherwise("both").alias("provider"))


def index_summary(heads: DataFrame, locators: DataFrame, conversation: str, key: str = "item_id") -> DataFrame:
    """One row: located, accepted, locators, conversations."""
    found = locators.agg(F.count_distinct(key).alias("located"), F.count("*").alias("locators"), F.count_distinct(conversation).alias("conversations"))
    return found.join(heads.agg(F.count("*").alias("accepted"))).select("located", "accepted", "locators", "conversations")


def anchors(texts: DataFrame, concepts: DataFrame, text_key: str = "doc_id") -> DataFrame:
    """(concept) -> concept, phrasing, place, texts: the phrasings that stand in a text, place in the order they are tried."""
    tried = concepts.select("concept", F.posexplode(phrasings(F.col("concept"))).alias("place", "term"))
    keyed = tried.withColumn("item_id", F.concat_ws("\x01", "concept", "place"))
    found = term_locators(texts, keyed, text_key).groupBy("item_id").agg(F.count("*").alias("texts"))
    return keyed.join(found, "item_id").select("concept", F.col("term").alias("phrasing"), "place", "texts")


def anchored(concepts: DataFrame, found: DataFrame) -> DataFrame:
    """concept, aliases: the phrasings beside its own spelling that anchor it, in order; null where none anchors it at all."""
    aliases = found.groupBy("concept").agg(F.sort_array(F.collect_list(F.struct("place", "phrasing"))).alias("a"))
    aliases = aliases.select("concept", F.filter(F.col("a.phrasing"), lambda p: F.lower(p) != F.lower("concept")).alias("aliases"))
    return concepts.select("concept").distinct().join(aliases, "concept", "left")


def disposed(concepts: DataFrame, accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """concept, by: 'accepted' where an accepted term (column term) covers the concept, else 'rejected' where it is on that list in lower case, else null."""
    keyed = concepts.select("concept").distinct()
    covered = term_locators(keyed.select(F.col("concept").alias("doc_id"), F.col("concept").alias("text")), accepted.select(F.lit(0).alias("item_id"), "term")).select(F.col("doc_id").alias("concept"), F.lit(True).alias("a"))
    gone = rejected.select(F.lower("term").alias("low"), F.lit(True).alias("r")).distinct()
    both = keyed.join(covered, "concept", "left").withColumn("low", F.lower("concept")).join(gone, "low", "left")
    return both.select("concept", F.when(F.col("a"), "accepted").when(F.col("r"), "rejected").alias("by"))


def queue(concepts: DataFrame, accepted: DataFrame, rejected: DataFrame, found: DataFrame) -> DataFrame:
    """concept: inferred, anchored by a phrasing (of ``found``), and not disposed of."""
    free = disposed(concepts, accepted, rejected).where("by is null").select("concept")
    return free.join(found.select("concept").distinct(), "concept", "left_semi")


def accept(accepted: DataFrame, new: DataFrame) -> DataFrame:
    """(head, aliases) of both -> head, aliases: new aliases join the headword they name in any case, other headwords are added.

    Of aliases that differ in case only the first stays; none repeats its headword. Null aliases are none.
    """
    side = lambda df, n: df.select(F.lower("head").alias("low"), F.col("head"), F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), F.lit(n).alias("side"))
    both = side(accepted, 0).union(side(new, 1))
    named = both.groupBy("low").agg(F.min_by("head", F.struct("side", "head")).alias("head"))
    alias = both.select("low", "side", F.posexplode("aliases").alias("p", "alias")).withColumn("alias_low", F.lower("alias")).where("alias_low <> low")
    first = alias.groupBy("low", "alias_low").agg(F.min(F.struct("side", "p", "alias")).alias("f"))
    lists = first.groupBy("low").agg(F.sort_array(F.collect_list("f")).alias("fs")).select("low", F.col("fs.alias").alias("aliases"))
    return named.join(lists, "low", "left").select("head", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"))


def reject(accepted: DataFrame, rejected: DataFrame, new: DataFrame) -> DataFrame:
    """(term, reason) to reject -> term, reason, outcome: added, covered (an accepted term stands in it), or already rejected."""
    found = disposed(new.select(F.col("term").alias("concept")), accepted, rejected)
    outcome = F.when(F.col("by") == "accepted", "covered").when(F.col("by") == "rejected", "already rejected").otherwise("added")
    return new.join(found.withColumnRenamed("concept", "term"), "term").select("term", "reason", outcome.alias("outcome"))


def queue_moved(listed: DataFrame, live: DataFrame) -> DataFrame:
    """concept, side: what only the listed or only the live queue holds; a disposal of all is refused unless this is empty."""
    both = listed.select("concept", F.lit(1).alias("l")).distinct().join(live.select("concept", F.lit(1).alias("v")).distinct(), "concept", "full_outer")
    return both.where("l is null or v is null").select("concept", F.when(F.col("v").isNull(), "listed only").otherwise("live only").alias("side"))


def letter_buckets(heads: DataFrame, key: str = "head") -> DataFrame:
    """letter, heads: how many headwords stand under each letter, a dot for those that begin with none. A letter stays one in capitals: ẞ, not SS."""
    first = F.substring(key, 1, 1)
    large, title = F.upper(first), F.initcap(first)
    letter = F.when(F.length(large) == 1, large).when(first == "ß", "ẞ").when(F.length(title) == 1, title).otherwise(first)
    return heads.groupBy(F.when(letter.rlike(r"^\p{L}$"), letter).otherwise("·").alias("letter")).agg(F.count("*").alias("heads"))


def capture_refusals(captured: DataFrame, palette: DataFrame, before: DataFrame) -> DataFrame:
    """(conv_id, category) -> reason, n: categories that the palette lacks, and a coverage below that of the capture before."""
    odd = captured.join(palette.select("category").distinct(), "category", "left_anti").groupBy("category").agg(F.count("*").alias("n"))
    odd = odd.select(F.concat(F.lit("category "), F.coalesce("category", F.lit("null")), F.lit(" is not in the palette")).alias("reason"), "n")
    counts = captured.agg(F.count_distinct("conv_id").alias("now")).join(before.agg(F.count_distinct("conv_id").alias("was")))
    fell = counts.where("now < was").select(F.lit("coverage fell").alias("reason"), (F.col("was") - F.col("now")).alias("n"))
    return odd.union(fell)
