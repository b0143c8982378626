"""Conversations as markdown and back, and the talk of session logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.functions.text import normalised, user_request

HEADING = r'(?m)^## (Human|Claude|Gemini) \((\d+)\)(?: <a id="([^"]+)"(?: data-at="([^"]+)")?></a>)?[ \t]*$'
MARK = "\x01"


def rendered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, md: a heading for each human or assistant turn with its number among its role's, parted by rules.

    Other roles are left out; a null text is empty. A conversation without such turns is absent. Texts of one
    conversation are put together in one row, as the file they become.
    """
    said = turns.where("role in ('user', 'assistant')").withColumn("n", F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")))
    head = F.format_string("## %s (%d)", F.when(F.col("role") == "user", "Human").otherwise("Claude"), "n")
    part = F.concat(head, F.lit("\n\n"), F.coalesce("text", F.lit("")), F.lit("\n\n---\n"))
    parts = said.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", part.alias("part")))).alias("parts"))
    return parts.select("conv_id", F.array_join(F.col("parts.part"), "\n").alias("md"))


def markdown_turns(files: DataFrame) -> DataFrame:
    """(conv_id, md) -> conv_id, place, side (H or A), n, anchor, at, body.

    A heading counts only if its number is the next of its side, so headings quoted inside a turn stay part of
    its body. Null and empty texts have no turns; repeated conv_ids are read as one file each by ``file_id``.
    """
    marked = F.regexp_replace(F.translate("md", MARK, ""), HEADING, f"{MARK}$0{MARK}")
    split = files.select("conv_id", F.monotonically_increasing_id().alias("file_id"), F.split(marked, MARK, -1).alias("ps")).where(F.size("ps") > 1)
    heads = F.transform(F.sequence(F.lit(1), F.floor(F.size("ps") / 2).cast("int")), lambda k: _head(F.get("ps", 2 * k - 1), F.get("ps", 2 * k)))
    heads = split.select("conv_id", "file_id", heads.alias("heads"))
    # the count of each side so far, and the places of the headings that were the next
    state = "named_struct('h', 0, 'a', 0, 'kept', cast(array() as array<int>))"
    step = """(s, i) -> case when heads[i].side = 'H' and heads[i].n = s.h + 1 then named_struct('h', s.h + 1, 'a', s.a, 'kept', concat(s.kept, array(i)))
        when heads[i].side = 'A' and heads[i].n = s.a + 1 then named_struct('h', s.h, 'a', s.a + 1, 'kept', concat(s.kept, array(i))) else s end"""
    kept = heads.withColumn("kept", F.expr(f"aggregate(sequence(0, size(heads) - 1), {state}, {step}, s -> s.kept)"))
    one = """transform(kept, (k, j) -> struct(j + 1 as place, heads[k].side as side, heads[k].n as n, heads[k].anchor as anchor, heads[k].at as at,
        concat(heads[k].body, array_join(transform(slice(heads, k + 2, coalesce(get(kept, j + 1), size(heads)) - k - 1), x -> x.head || x.body), '')) as body))"""
    return kept.select("conv_id", F.explode(F.expr(one)).alias("t")).select("conv_id", "t.*")


def _head(head: Column, body: Column) -> Column:
    part = lambda i: F.nullif(F.regexp_extract(head, HEADING, i), F.lit(""))
    side = F.when(part(1) == "Human", "H").otherwise("A")
    return F.struct(head.alias("head"), side.alias("side"), part(2).cast("int").alias("n"), part(3).alias("anchor"), part(4).alias("at"), body.alias("body"))


def turn_sequence(files: DataFrame) -> DataFrame:
    """conv_id, place, side, body: white space as one space, the closing rule left out."""
    body = F.regexp_replace(normalised(F.col("body")), r"\s*---$", "")
    return markdown_turns(files).select("conv_id", "place", "side", body.alias("body"))


def extents(files: DataFrame) -> DataFrame:
    """conv_id, human, assistant, total as the headings say."""
    return markdown_turns(files).groupBy("conv_id").agg(F.count_if(F.col("side") == "H").alias("human"), F.count_if(F.col("side") == "A").alias("assistant"), F.count("*").alias("total"))


def refusals(declared: DataFrame, files: DataFrame) -> DataFrame:
    """(conv_id, human, assistant) declared -> conv_id, reason: files whose headings hold other counts, or that declare none."""
    found = files.select("conv_id").join(extents(files), "conv_id", "left").select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(f"h_{c}") for c in ("human", "assistant")])
    both = found.join(declared.select("conv_id", "human", "assistant"), "conv_id", "left")
    none = F.col("human").isNull() | F.col("assistant").isNull()
    differs = (F.col("human") != F.col("h_human")) | (F.col("assistant") != F.col("h_assistant"))
    said = F.format_string("declares %d/%d and its headings hold %d/%d", "human", "assistant", "h_human", "h_assistant")
    return both.where(none | differs).select("conv_id", F.when(none, "declares no turn counts").otherwise(said).alias("reason"))


def blank(text: Column, blocks: Column, attachments: Column, files: Column) -> Column:
    """True for a message that holds nothing: no blocks at all, blank text, nothing attached. Null arrays are empty."""
    none = lambda x: F.coalesce(F.size(x), F.lit(-1)) <= 0
    return none(blocks) & (F.trim(F.coalesce(text, F.lit(""))) == "") & none(attachments) & none(files)


def empty_conversations(messages: DataFrame, conversations: DataFrame, is_blank: Column) -> DataFrame:
    """conv_id, is_empty: true where every message is blank; a conversation without messages is empty."""
    found = messages.groupBy("conv_id").agg(F.every(is_blank).alias("e"))
    return conversations.select("conv_id").distinct().join(found, "conv_id", "left").select("conv_id", F.coalesce("e", F.lit(True)).alias("is_empty"))


def _field(name: str, kind: str = "string") -> Column:
    return F.try_variant_get("record", f"$.{name}", kind)


def session_talk(records: DataFrame) -> DataFrame:
    """(session, pos, line JSON) of one harness -> session, pos, role, at, text: what was said, without side chains, meta records, tool results and blanks.

    The text is a bare string, else the text blocks parted by blank lines. Lines that are no JSON are left out.
    """
    df = records.select("session", "pos", F.try_parse_json("line").alias("record")).where("record is not null")
    blocks = F.try_variant_get("record", "$.message.content", "array<struct<type:string,text:string>>")
    parts = F.filter(F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: F.trim(b["text"])), lambda x: x != "")
    whole = F.schema_of_variant(F.variant_get("record", "$.message.content", "variant")) == "STRING"
    text = F.when(whole, F.trim(_field("message.content"))).otherwise(F.array_join(parts, "\n\n"))
    user, absent = _field("type") == "user", lambda n: F.try_variant_get("record", f"$.{n}", "variant").isNull()
    kept = df.where(_field("type").isin("user", "assistant") & ~F.coalesce(_field("isSidechain", "boolean"), F.lit(False)) & ~F.coalesce(_field("isMeta", "boolean"), F.lit(False)))
    kept = kept.where(~user | (absent("toolUseResult") & absent("sourceToolAssistantUUID")))
    return kept.select("session", "pos", F.when(user, "human").otherwise("assistant").alias("role"), _field("timestamp").alias("at"), text.alias("text")).where("text <> ''")


def session_facts(records: DataFrame) -> DataFrame:
    """session, title (the last that is not blank), created, last_activity: over all records, those that say nothing too. Stamps compare as text."""
    df = records.select("session", "pos", F.try_parse_json("line").alias("record")).where("record is not null")
    title = F.when((_field("type") == "ai-title") & (F.coalesce(_field("aiTitle"), F.lit("")) != ""), _field("aiTitle"))
    at = F.nullif(_field("timestamp"), F.lit(""))
    found = df.select("session", "pos", title.alias("title"), at.alias("at"))
    return found.groupBy("session").agg(
        F.coalesce(F.max_by("title", F.when(F.col("title").isNotNull(), F.col("pos"))), F.lit("")).alias("title"),
        F.coalesce(F.min("at"), F.lit("")).alias("created"), F.coalesce(F.max("at"), F.lit("")).alias("last_activity"),
    )


def step_talk(steps: DataFrame) -> DataFrame:
    """(session, pos, type, content) of the other harness -> session, pos, role, text: typed requests without their wrapping, and planner responses."""
    role = F.when(F.col("type") == "USER_INPUT", "human").when(F.col("type") == "PLANNER_RESPONSE", "assistant")
    text = F.when(F.col("type") == "USER_INPUT", user_request(F.col("content"))).otherwise(F.trim("content"))
    return steps.select("session", "pos", role.alias("role"), text.alias("text")).where("role is not null and text <> ''")


def files_written(calls: DataFrame) -> DataFrame:
    """(conv_id, pos, path, content) -> conv_id, path, content: of several writes of one path the last counts; blank paths write nothing."""
    best = calls.where("trim(path) <> ''").groupBy("conv_id", "path").agg(F.max_by("content", "pos").alias("content"))
    return best.select("conv_id", "path", "content")
