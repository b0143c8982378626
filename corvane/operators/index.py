"""Headwords and where they stand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import words

GRAM = 5
#: Characters by which words are looked up that may hold a short headword.
LETTERS = 4


def holding(words_: DataFrame, keys: DataFrame, letters: int = LETTERS) -> DataFrame:
    """k(k), keys(item_id, head, part) -> item_id, head, k: the words that hold the part, inside them or whole.

    The first ``letters`` characters of a part, all of them if it is shorter, join by equality with the runs of
    characters of the words; ``contains`` then decides. Nulls on either side hold nothing, an empty part is held by all.
    """
    runs = F.expr(f"array_distinct(flatten(transform(sequence(0, {letters}), n -> transform(sequence(1, greatest(1, length(k) - n + 1)), i -> substring(k, i, n)))))")
    found = words_.where("k is not null").select("k", F.explode(runs).alias("run"))
    return found.join(keys.withColumn("run", F.substring("part", 1, letters)), "run").where(F.contains("k", "part")).select("item_id", "head", "k")


def locators(docs: DataFrame, heads: DataFrame, gram: int = GRAM) -> DataFrame:
    """item_id, doc_id: documents that contain the headword's text.

    Inner words of a headword stand whole in any text that contains it, so runs of ``gram`` inner words join
    the two sides by equality; ``contains`` then decides. Headwords too short for such a run join by their
    longest inner word. Those of one or two words have no inner word and may stand inside longer words: their
    longer word is looked up among the distinct words of all texts, and those that hold it join as inner words do.

    A null text or headword gives no row, an empty headword every document with a text; repeated documents and
    headwords repeat their rows; other columns are ignored; empty tables give no rows.
    """
    split = F.split("text", " ")
    inner = heads.select("item_id", F.col("text").alias("head"), split.alias("w"))
    run = lambda w, n: F.array_join(w, " ") if n > 1 else w
    longest = lambda w: F.expr(f"array_max(transform({w}, x -> struct(length(x) as n, x as x))).x")
    long_ = inner.where(F.size("w") >= gram + 2).select("item_id", "head", run(F.slice("w", 2, gram), gram).alias("k"))
    short = inner.where((F.size("w") > 2) & (F.size("w") < gram + 2)).select("item_id", "head", longest("slice(w, 2, size(w) - 2)").alias("k"))
    brief = inner.where(F.size("w") <= 2).select("item_id", "head", longest("w").alias("part"))
    words = docs.select("doc_id", split.alias("w"))
    grams = words.select("doc_id", F.explode(F.array_distinct(F.expr(f"transform(slice(w, 1, greatest(0, size(w) - {gram - 1})), (x, i) -> array_join(slice(w, i + 1, {gram}), ' '))"))).alias("k"))
    ones = words.select("doc_id", F.explode(F.array_distinct("w")).alias("k"))
    short = short.union(holding(ones.select("k").distinct(), brief))
    pairs = grams.join(long_, "k").union(ones.join(short, "k")).select("doc_id", "item_id").distinct()
    texts = docs.select("doc_id", "text").join(pairs, "doc_id").join(heads.select("item_id", F.col("text").alias("head")), "item_id")
    return texts.where(F.contains("text", "head")).select("item_id", "doc_id")


def orphans(heads: DataFrame, found: DataFrame) -> DataFrame:
    """Headwords without a locator."""
    return heads.join(found, "item_id", "left_anti").select("item_id")


def uncovered(docs: DataFrame, heads: DataFrame, rejected: DataFrame, top: int = 50) -> DataFrame:
    """word, docs, count: the words in most documents that no headword covers and that are not rejected.

    A headword covers the words in which it stands between word boundaries: ``well`` covers ``well-known``. It is
    then a run of the word's parts, letters or a single mark, so the two sides join by equality.
    """
    found = docs.select("doc_id", F.explode(words(F.col("text"))).alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    ranked = found.groupBy("word").agg(F.count("doc_id").alias("docs"), F.sum("n").alias("count"))
    return _open(ranked, heads, rejected, top)


def advisory(docs: DataFrame, heads: DataFrame, rejected: DataFrame, stop: DataFrame, top: int = 50) -> DataFrame:
    """word, docs, count: as ``uncovered``, over words of four characters and more that begin with a letter, in lower case, without marks at their ends.

    Letters are those of ASCII; both apostrophes and the hyphen are marks. stop(word) are words that say nothing; the list is the
    caller's. What is shorter than four characters once its marks are gone still counts.
    """
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z][A-Za-z'\u2019-]{3,}"), F.lit(0))).alias("w"))
    found = found.select("doc_id", F.expr("trim(both '\\'\u2019-' from lower(w))").alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    ranked = found.groupBy("word").agg(F.count("doc_id").alias("docs"), F.sum("n").alias("count"))
    return _open(ranked, heads, rejected.select("text").union(stop.select("word")), top)


def _open(ranked: DataFrame, heads: DataFrame, rejected: DataFrame, top: int) -> DataFrame:
    """The first words of ranked(word, docs, count) that are not rejected and that no headword covers."""
    parts = ranked.select("word", F.regexp_extract_all("word", F.lit("[a-z]+|['\u2019-]"), F.lit(0)).alias("p"))
    runs = parts.select("word", F.explode(F.expr("flatten(transform(sequence(1, size(p)), i -> transform(sequence(1, size(p) - i + 1), n -> array_join(slice(p, i, n), ''))))")).alias("head"))
    covered = runs.join(heads.select(F.lower("text").alias("head")), "head", "left_semi").select("word")
    gone = covered.union(rejected.select(F.lower("text").alias("word")))
    return ranked.join(gone, "word", "left_anti").orderBy(F.desc("docs"), F.desc("count"), "word").limit(top)
