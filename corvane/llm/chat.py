"""Chat formatting with Spark expressions only: sorted turn structs, merged same-role turns, a loss mask.

Template: user ``[INST] .. [/INST]``, system ``<<SYS>> .. <</SYS>>``, assistant ``<s> .. </s>``, any other
role ``[ROLE]name[AS] .. [/ROLE]``; the texts of merged turns are parted by ``[PART]``. A backslash inside a
text is doubled, and a control string inside it gets a backslash after its first character, so the output
can be read back exactly and no text can pass for a turn mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import let

CONTROL = r"(<|\[)(?=/?s>|/?INST\]|/?<SYS>>|</SYS>>|/?ROLE\]|AS\]|PART\])"
BLOCK = r"(?s)(\[INST\]|<<SYS>>|<s>|\[ROLE\])(.*?)(\[/INST\]|<</SYS>>|</s>|\[/ROLE\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: the structs (turn, role, text) of each conversation in order; null role or text: empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    return conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, segments array<struct<text, loss>>: the segments concatenate to ``formatted``.

    Adjacent turns of one role become one block. Equal turn numbers are ordered by role and text; repeated
    rows stay; rows with null turn come first; a null conv_id is a conversation of its own.
    """
    df = turns_of(conversations)
    # both are bound once, so that no reordering of expressions evaluates them per turn
    starts = "filter(sequence(0, size(ts) - 1), i -> i = 0 or ts[i].role <> ts[i - 1].role)"
    blocks = "transform(st, (s, k) -> struct(ts[s].role as role, transform(slice(ts, s + 1, coalesce(get(st, k + 1), size(ts)) - s), t -> t.text) as texts))"
    df = df.withColumn("blocks", F.expr(let("ts", "turns", let("st", starts, blocks))))

    def segments(block: Column) -> Column:
        role = block["role"]
        open_ = F.when(role == "user", "[INST]").when(role == "system", "<<SYS>>").when(role == "assistant", "<s>").otherwise(F.concat(F.lit("[ROLE]"), escape(role), F.lit("[AS]")))
        close = F.when(role == "user", "[/INST]\n").when(role == "system", "<</SYS>>\n").when(role == "assistant", "</s>\n").otherwise("[/ROLE]\n")
        part = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
        texts = F.transform(block["texts"], lambda t, i: F.array(part(F.when(i > 0, "[PART]").otherwise(""), F.lit(False)), part(escape(t), role == "assistant")))
        return F.concat(F.array(part(open_, F.lit(False))), F.flatten(texts), F.array(part(close, F.lit(False))))

    df = df.withColumn("segments", F.flatten(F.transform("blocks", segments)))
    return df.select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns array<struct<role, text>> parsed from ``formatted`` alone."""
    marks, bodies = F.regexp_extract_all("formatted", F.lit(BLOCK), F.lit(1)), F.regexp_extract_all("formatted", F.lit(BLOCK), F.lit(2))

    def turns(mark: Column, body: Column) -> Column:
        named = mark == "[ROLE]"
        role = F.when(mark == "[INST]", "user").when(mark == "<<SYS>>", "system").when(mark == "<s>", "assistant").otherwise(unescape(F.substring_index(body, "[AS]", 1)))
        texts = F.split(F.when(named, F.substring(body, F.instr(body, "[AS]") + 4, F.length(body))).otherwise(body), r"\[PART\]", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    found = chats.withColumn("marks", marks).withColumn("bodies", bodies)
    return found.withColumn("turns", F.flatten(F.zip_with("marks", "bodies", turns))).drop("marks", "bodies")


def digest(conversations: DataFrame) -> DataFrame:
    """The columns of query op8, with conversation -1 added; turns from the output, loss text from its mask."""
    spark = conversations.sparkSession
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    back = read_back(formatted(conversations.select("conv_id", "turn", "role", "text").unionByName(extra)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    back = back.withColumn("loss", loss)
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
