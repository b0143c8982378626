"""Registered queries of the conversation-corpus operators, each beside its SQL twin.

The driver's tables stand in for the archive: documents are units, conversations are turns, events are
dated readings, orders and lineitem give the file audit. Snapshots to compare are derived from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.functions.text import STOP_WORDS, human_size, normalised, number_twin, reason, safe_path, signed_change, slug, uuid7_instant, windows, words
from corvane.operators import audit, index, ordering, paths, relations, trajectory, turns, verdicts
from corvane.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function's name, with its SQL twin."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
_WORDS = f"""w as (select side, word, count(*) as n from (select case role when 'user' then 'human' when 'assistant' then 'assistant' end as side,
    unnest(regexp_extract_all(lower(text), '[a-z][a-z''\\-]{{2,}}')) as word from conversations) where side is not null and word not in ({_STOPS}) group by all)"""


@query(f'with {_WORDS} select side, word, n as "count", rank from (select *, row_number() over (partition by side order by n desc, word) as rank from w) where rank <= 120')
def word_freq_top(spark, sf_dir):
    return turns.top(turns.word_counts(table(spark, sf_dir, "conversations")), ["side"])


@query(f'with {_WORDS} select word, cast(sum(n) as bigint) as "count" from w group by word order by 2 desc, 1 limit 120')
def word_freq_both(spark, sf_dir):
    both = turns.word_counts(table(spark, sf_dir, "conversations")).groupBy("word").agg(F.sum("count").alias("count"))
    return turns.top(both, [])


_COUNTS = """select conv_id, count(*) filter (role = 'user') as human, count(*) filter (role = 'assistant') as assistant, count(*) as total,
    cast(coalesce(sum(octet_length(encode(text))), 0) as bigint) as bytes from {src} group by conv_id"""


@query(_COUNTS.format(src="conversations"))
def turn_counts_by_role(spark, sf_dir):
    return turns.counts(table(spark, sf_dir, "conversations"))


@query("select conv_id, turn, role, row_number() over (partition by conv_id, role order by turn) as n from conversations")
def turn_role_ordinal(spark, sf_dir):
    return turns.role_ordinals(table(spark, sf_dir, "conversations"))


@query(r"select conv_id, turn, trim(regexp_replace(text, '[ \t\n\r\f\x0B]+', ' ', 'g')) as text from conversations")
def turn_text_normalised(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", normalised(F.col("text")).alias("text"))


@query("""select o_orderkey, case when o_totalprice >= 5000 then row_number() over (partition by o_totalprice >= 5000 order by o_orderdate, o_orderkey) end as ordinal,
    case when o_totalprice >= 5000 then lpad(cast(row_number() over (partition by o_totalprice >= 5000 order by o_orderdate, o_orderkey) as varchar), 12, '0') end as name from orders""")
def corpus_ordinals(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    found = ordering.ordinals(orders, ["o_orderdate", "o_orderkey"], F.to_date("o_orderdate"), F.col("o_totalprice") >= 5000)
    return found.select("o_orderkey", "ordinal", F.lpad(F.col("ordinal").cast("string"), 12, "0").alias("name"))


@query("""with s as (select p_partkey, coalesce(nullif(left(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_'), 100), ''), 'conversation') as s from part)
    select p_partkey, case when p_partkey = min(p_partkey) over (partition by s) then s else s || '-' || p_partkey end as name from s""")
def slug_names_unique(spark, sf_dir):
    named = table(spark, sf_dir, "part").select("p_partkey", slug(F.col("p_name")).alias("s"))
    first = named.groupBy("s").agg(F.min("p_partkey").alias("first"))
    return named.join(first, "s").select("p_partkey", F.when(F.col("p_partkey") == F.col("first"), F.col("s")).otherwise(F.concat_ws("-", "s", "p_partkey")).alias("name"))


@query("select event_id, c_name as owner from events join customer on user_id = c_custkey where c_acctbal > 0")
def rekey_known(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("owner"))
    return table(spark, sf_dir, "events").select("event_id", "user_id").join(known, "user_id").select("event_id", "owner")


@query("select user_id, count(*) as n from events where user_id not in (select c_custkey from customer where c_acctbal > 0) group by user_id")
def rekey_unknown(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    counted = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return counted.join(known, "user_id", "left_anti")


@query("""with o as (select *, date_trunc('second', ts) as sec from events), c as (select *, user_id is distinct from lag(user_id) over (order by sec, user_id, event_id) as new from o),
    i as (select *, sum(new::int) over (order by sec, user_id, event_id) as island from c)
    select cast(island as bigint) as island, user_id, min(ts) as first, max(ts) as last, count(*) as n from i group by island, user_id""")
def spans_islands(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.date_trunc("second", "ts").alias("sec"))
    return ordering.islands(events, "user_id", "ts", ["sec", "user_id", "event_id"], F.to_date("sec"))


@query("select user_id, cast(ts as date) as day, min(ts) as first, max(ts) as last, count(*) as n from events group by user_id, day")
def spans_daily(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"))


@query("select user_id, max(ts) as dormant_from from events group by user_id")
def dormant_from(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("dormant_from"))


_AUDIT = """select distinct o_custkey % 100 as chat, concat('chat ', cast(o_custkey % 100 as string)) as chat_name,
    case when l_returnflag = 'R' then 'dl' when l_returnflag = 'A' and l_linestatus = 'F' then 'tooltip' when l_returnflag = 'A' then 'ef' when l_linestatus = 'O' then 'eh_out' else 'eh_wrk' end as source,
    concat('d', cast(l_partkey % 7 as string), '/f', cast(l_partkey % 400 as string)) as path, case when l_quantity < 25 then 'Y' else 'N' end as in_dl,
    case when l_quantity < 12 then 'identical' when l_quantity < 25 then 'newline_only' when l_quantity < 38 then 'differs' else 'not_present' end as dl_compare
    from {lineitem} join {orders} on l_orderkey = o_orderkey"""


def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit view."""
    return spark.sql(_AUDIT, lineitem=table(spark, sf_dir, "lineitem"), orders=table(spark, sf_dir, "orders"))


_AUDIT_CTE = f"with audit as ({_AUDIT.format(lineitem='lineitem', orders='orders')}) "


@query(_AUDIT_CTE + """select chat, any_value(chat_name) as chat_name, count(*) as extracted, count(*) filter (in_dl = 'Y') as downloaded, count(*) filter (in_dl = 'N') as copied
    from audit where source = 'ef' group by chat""")
def audit_q1_conditional_counts(spark, sf_dir):
    return audit.tally(file_audit(spark, sf_dir), ["ef"], "in_dl", {"downloaded": "Y", "copied": "N"})


@query(_AUDIT_CTE + """, n as (select chat, dl_compare, count(*) as n from audit where starts_with(source, 'eh_') group by all)
    select chat, 'chat ' || chat as chat_name, cast(sum(n) as bigint) as extracted, cast(coalesce(max(n) filter (dl_compare = 'identical'), 0) as bigint) as identical, cast(coalesce(max(n) filter (dl_compare = 'newline_only'), 0) as bigint) as newline_only,
    cast(coalesce(max(n) filter (dl_compare = 'differs'), 0) as bigint) as differs, cast(coalesce(max(n) filter (dl_compare = 'not_present'), 0) as bigint) as copied from n group by chat""")
def audit_q2_class_counts(spark, sf_dir):
    classes = {"identical": "identical", "newline_only": "newline_only", "differs": "differs", "copied": "not_present"}
    return audit.tally(file_audit(spark, sf_dir), ["eh_out", "eh_wrk"], "dl_compare", classes)


_SIDED = _AUDIT_CTE + """, sided as (select *, bool_or(source = 'tooltip') over same as is_shown, bool_or(source <> 'tooltip') over same as is_held from audit window same as (partition by chat, path)) """


@query(_SIDED + "select chat, chat_name, path from sided where is_shown and source = 'tooltip'")
def audit_q3_tooltip_paths(spark, sf_dir):
    return audit.shown(file_audit(spark, sf_dir)).select("chat", "chat_name", "path")


@query(_SIDED + "select chat, chat_name, path as tooltip_path from sided where is_shown and not is_held")
def audit_q4_tooltip_only(spark, sf_dir):
    rows = file_audit(spark, sf_dir)
    return audit.without_twin(audit.shown(rows), audit.on_disk(rows)).select("chat", "chat_name", F.col("path").alias("tooltip_path"))


@query(_SIDED + "select chat, chat_name, source, path from sided where is_held and not is_shown")
def audit_q5_disk_only(spark, sf_dir):
    rows = file_audit(spark, sf_dir)
    return audit.without_twin(audit.on_disk(rows), audit.shown(rows)).select("chat", "chat_name", "source", "path")


@query(_AUDIT_CTE + "select chat, chat_name, split_part(path, '/', 2) as base, " + ", ".join(
    f"string_agg(distinct path, ' | ' order by path) filter (source = '{s}') as {s}" for s in audit.SOURCES) + " from audit group by all")
def audit_pivot_joined(spark, sf_dir):
    return audit.pivoted(file_audit(spark, sf_dir))


@query("""select distinct page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as link from pages""")
def local_resources_distinct(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link")).distinct()


@query("select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages")
def html_embedded_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("""with h as (select doc_id, text as h from documents where doc_id % 5 <> 4), s as (select doc_id, case doc_id % 5 when 0 then text when 1 then left(text, length(text) // 2)
    when 2 then text || ' more' when 3 then 'x' || text else text end as s from documents)
    select doc_id, case when h is null then 'ABSENT' when starts_with(s, h) and starts_with(h, s) then 'IDENTICAL' when starts_with(s, h) then 'EXTENDS' when starts_with(h, s) then 'AHEAD' else 'DIVERGED' end as relation
    from s left join h using (doc_id)""")
def relation_prefix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text, kind = F.col("text"), F.col("doc_id") % 5
    cut = F.when(kind == 1, F.expr("left(text, int(length(text) div 2))")).when(kind == 2, F.concat(text, F.lit(" more"))).when(kind == 3, F.concat(F.lit("x"), text)).otherwise(text)
    return relations.by_prefix(docs.withColumn("text", cut), docs.where("doc_id % 5 <> 4"), "doc_id", "text")


@query("""with s as (select distinct conv_id, turn from conversations where (conv_id + turn) % 7 <> 0), h as (select distinct conv_id, turn from conversations where conv_id % 4 <> 3 and (conv_id + turn) % 5 <> 0),
    b as (select coalesce(s.conv_id, h.conv_id) as conv_id, s.turn is not null as i, h.turn is not null as j from s full join h on s.conv_id = h.conv_id and s.turn = h.turn),
    c as (select conv_id, count(*) filter (i) as ns, count(*) filter (j) as nh, count(*) filter (not j) as new, count(*) filter (not i) as missing from b group by conv_id)
    select conv_id, case when nh = 0 then 'ABSENT' when missing = 0 and new = 0 then 'IDENTICAL' when missing = 0 then 'EXTENDS' when new = 0 then 'AHEAD' else 'DIVERGED' end as relation, new, missing from c where ns > 0""")
def relation_uuid_sets(spark, sf_dir):
    said = table(spark, sf_dir, "conversations")
    return relations.by_atoms(said.where("(conv_id + turn) % 7 <> 0"), said.where("conv_id % 4 <> 3 and (conv_id + turn) % 5 <> 0"), "conv_id", "turn")


@query("select doc_id, holder from (select doc_id, min(doc_id) over (partition by coalesce(text, '')) as holder from documents) where doc_id <> holder")
def held_twice_identical(spark, sf_dir):
    return relations.held_twice(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("""with a as (select conv_id, list(role || chr(10) || text order by turn) as a from conversations group by conv_id),
    b as (select conv_id, list((case when conv_id % 4 = 1 and turn = 1 then 'other' else role end) || chr(10) || text order by turn) as b from conversations where conv_id % 4 <> 2 or turn < 2 group by conv_id)
    select conv_id, case when b is null then 'only mine' when a is null then 'only other' when a = b then 'identical' when b[1:len(a)] = a then 'appended' when a[1:len(b)] = b then 'stale' else 'divergent' end as state
    from a full join b using (conv_id)""")
def transcript_compare(spark, sf_dir):
    said = table(spark, sf_dir, "conversations")
    other = said.where("conv_id % 4 <> 2 or turn < 2").withColumn("role", F.when((F.col("conv_id") % 4 == 1) & (F.col("turn") == 1), "other").otherwise(F.col("role")))
    return turns.compare(said, other)


@query("""select event_id, user_id, case when row_number() over w = 1 or event_type is distinct from lag(event_type) over w then 'deposited' else 'unchanged' end as verdict
    from events window w as (partition by user_id order by ts, event_id)""")
def accumulate_trajectory(spark, sf_dir):
    return trajectory.deposits(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type").select("event_id", "user_id", "verdict")


@query("select user_id, date_trunc('hour', ts) as stamp, count(distinct event_type) as contents from events group by all having count(distinct event_type) > 1")
def accumulate_conflicts(spark, sf_dir):
    return trajectory.conflicts(table(spark, sf_dir, "events").withColumn("stamp", F.date_trunc("hour", "ts")), "user_id", "stamp", "event_type")


@query("""select event_id from (select event_id, event_type = lag(event_type) over (partition by user_id order by ts, event_id) as twin from events) where twin""")
def twin_detector(spark, sf_dir):
    found = trajectory.deposits(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type")
    return found.where("verdict = 'unchanged' and event_type is not null").select("event_id")


@query("""with e as (select event_id, user_id, ts - to_days(cast(8200 + event_id % 2600 as int)) as at from events), o as (select o_custkey, o_orderdate, max(o_orderkey) as k from orders group by all)
    select event_id, k as order_key from e asof left join o on e.user_id = o.o_custkey and o.o_orderdate < e.at""")
def asof_nearest_earlier(spark, sf_dir):
    at = F.expr("ts - make_dt_interval(int(8200 + event_id % 2600))")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", at.alias("at"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("order_key"))
    return ordering.as_of(events, orders, "user_id", "at", "order_key").select("event_id", "order_key")


@query("select left(c_name, 16) as short, count(*) as n from customer group by short having count(*) > 1")
def uuid8_census(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy(F.substring("c_name", 1, 16).alias("short")).agg(F.count("*").alias("n")).where("n > 1")


@query("select item_id, doc_id from benchmark b join documents d on contains(d.text, b.text)")
def headword_locators(spark, sf_dir):
    return index.locators(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("select item_id from benchmark b where not exists (select 1 from documents d where contains(d.text, b.text))")
def headword_orphans(spark, sf_dir):
    heads = table(spark, sf_dir, "benchmark")
    return index.orphans(heads, index.locators(table(spark, sf_dir, "documents"), heads))


@query("""with f as (select item_id, doc_id, row_number() over (partition by item_id order by doc_id) as r, count(*) over (partition by item_id) as n from benchmark b join documents d on contains(d.text, b.text))
    select item_id, doc_id, greatest(n - 4, 0) as more from f where r <= 4""")
def book_index_topk(spark, sf_dir):
    found = index.locators(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    shown = found.withColumn("r", F.row_number().over(Window.partitionBy("item_id").orderBy("doc_id"))).where("r <= 4")
    return shown.join(found.groupBy("item_id").agg(F.count("*").alias("n")), "item_id").select("item_id", "doc_id", F.greatest(F.col("n") - 4, F.lit(0)).alias("more"))


@query(f"""select word, count(distinct doc_id) as docs, count(*) as "count" from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z''\\-]{{2,}}')) as word from documents)
    where word not in ({_STOPS}) group by word order by 2 desc, 3 desc, 1 limit 50""")
def uncovered_words_top(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(words(F.col("text"))).alias("word"))
    per = found.groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    return per.groupBy("word").agg(F.count("*").alias("docs"), F.sum("n").alias("count")).orderBy(F.desc("docs"), F.desc("count"), "word").limit(50)


@query(f"""with t as (select item_id, unnest(regexp_extract_all(lower(text), '[a-z]{{3,}}')) as term from benchmark),
    w as (select word, count(distinct doc_id) as docs, count(*) as "count" from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z''\\-]{{2,}}')) as word from documents) where word not in ({_STOPS}) group by word)
    select word, docs, "count" from w where word not in (select term from t where item_id % 2 = 1)
    and not exists (select 1 from (select distinct term from t where item_id % 2 = 0) h where contains(w.word, h.term) and regexp_matches(w.word, '\\b' || h.term || '\\b')) order by 2 desc, 3 desc, 1 limit 50""")
def uncovered_words(spark, sf_dir):
    """Documents of all languages; the words of even benchmark items stand in for the headwords, those of odd ones for the rejected list."""
    terms = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("text"))
    return index.uncovered(table(spark, sf_dir, "documents"), terms.where("item_id % 2 = 0"), terms.where("item_id % 2 = 1"))


@query(f"""with t as (select item_id, unnest(regexp_extract_all(lower(text), '[a-z]{{3,}}')) as term from benchmark),
    d as (select doc_id, trim(lower(w), '''’-') as word from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z''’\\-]{{3,}}')) as w from documents)),
    w as (select word, count(distinct doc_id) as docs, count(*) as "count" from d group by word), p as (select word, unnest(regexp_extract_all(word, '[a-z]+')) as term from w)
    select word, docs, "count" from w where word not in (select term from t where item_id % 2 = 1) and word not in ({_STOPS}) and word not in (select word from p join (select distinct term from t where item_id % 2 = 0) h using (term)) order by 2 desc, 3 desc, 1 limit 50""")
def uncovered_words_advisory(spark, sf_dir):
    """As ``uncovered_words``, of words of four characters and more without marks at their ends."""
    terms = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("text"))
    stop = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    return index.advisory(table(spark, sf_dir, "documents"), terms.where("item_id % 2 = 0"), terms.where("item_id % 2 = 1"), stop)


@query("""select count(*) filter (d.doc_id is not null and l.doc_id is not null) as captured, count(*) filter (l.doc_id is null) as never, count(*) filter (d.doc_id is null) as gone, count(*) as total
    from (select distinct doc_id from documents where doc_id % 10 <> 3) d full join (select distinct doc_id from labels) l on d.doc_id = l.doc_id""")
def capture_coverage(spark, sf_dir):
    return verdicts.coverage(table(spark, sf_dir, "documents").where("doc_id % 10 <> 3"), table(spark, sf_dir, "labels"), "doc_id")


_JUDGED = "j as (select d.*, case when q is null then 'unjudged' when q = 1 then 'valid' else 'invalid' end as judgement from documents d left join (select doc_id, min(quality) as q from labels group by doc_id) l using (doc_id))"


@query(f"with {_JUDGED} select judgement, count(*) as n from j group by judgement")
def verdict_states(spark, sf_dir):
    return verdicts.judged(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", "quality").groupBy("judgement").agg(F.count("*").alias("n"))


@query(f"with {_JUDGED} select lang, source, count(*) as n from j where judgement = 'invalid' group by lang, source")
def invalid_by_reason(spark, sf_dir):
    found = verdicts.judged(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), table(spark, sf_dir, "labels"), "doc_id", "quality")
    return found.where("judgement = 'invalid'").groupBy("lang", "source").agg(F.count("*").alias("n"))


@query("select user_id, event_type, max_by(value, event_id) as value from events group by user_id, event_type")
def verdict_latest_per_family(spark, sf_dir):
    return verdicts.latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], "value", "event_id")


@query("with p as (" + _COUNTS.format(src="conversations where conv_id % 5 <> 1 and (turn < 3 or conv_id % 3 > 0)") + "), c as (" + _COUNTS.format(src="conversations where conv_id % 7 <> 1 and (turn < 2 or conv_id % 3 <> 1)") + """)
    select coalesce(p.conv_id, c.conv_id) as conv_id, case when p.conv_id is null then 'absent' when c.conv_id is null then 'gone' when c.human < p.human or c.assistant < p.assistant or c.bytes < p.bytes then 'regressed'
    when c.human <> p.human or c.assistant <> p.assistant or c.bytes <> p.bytes then 'lagging' else 'current' end as state from p full join c on p.conv_id = c.conv_id""")
def page_lag(spark, sf_dir):
    said = table(spark, sf_dir, "conversations")
    page = turns.counts(said.where("conv_id % 5 <> 1 and (turn < 3 or conv_id % 3 > 0)"))
    return relations.lag(page, turns.counts(said.where("conv_id % 7 <> 1 and (turn < 2 or conv_id % 3 <> 1)")), "conv_id", ["human", "assistant", "bytes"])


@query("""with a as (select c_custkey, c_name, c_mktsegment from customer where c_custkey % 9 <> 1), b as (select c_custkey, case when c_custkey % 8 = 2 then upper(c_name) || '!' else c_name end as c_name,
    case when c_custkey % 6 = 5 then null else c_mktsegment end as c_mktsegment from customer where c_custkey % 11 <> 1), j as (select coalesce(a.c_custkey, b.c_custkey) as c_custkey, a.c_custkey as ka, b.c_custkey as kb,
    a.c_name as n1, b.c_name as n2, a.c_mktsegment as m1, b.c_mktsegment as m2 from a full join b on a.c_custkey = b.c_custkey)
    select c_custkey, 'c_name' as "column", n1 as before, n2 as after from j where ka is not null and kb is not null and n1 is distinct from n2
    union all select c_custkey, 'c_mktsegment', m1, m2 from j where ka is not null and kb is not null and m1 is distinct from m2
    union all select c_custkey, null, case when ka is not null then 'held' end, case when kb is not null then 'held' end from j where ka is null or kb is null""")
def table_diff_rows(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    name = F.when(F.col("c_custkey") % 8 == 2, F.concat(F.upper("c_name"), F.lit("!"))).otherwise(F.col("c_name"))
    new = people.where("c_custkey % 11 <> 1").withColumn("c_name", name).withColumn("c_mktsegment", F.when(F.col("c_custkey") % 6 != 5, F.col("c_mktsegment")))
    return relations.table_diff(people.where("c_custkey % 9 <> 1"), new, "c_custkey")


@query("""select n.n_name, case when l.n_name is null then 'UNVERIFIED' when l.v = n.n_regionkey then 'OK' else 'DRIFT' end as state
    from nation n left join (select n_name, case when n_nationkey % 4 = 1 then n_regionkey + 1 else n_regionkey end as v from nation where n_nationkey % 6 <> 2) l using (n_name)""")
def reconcile_settings(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    live = nations.where("n_nationkey % 6 <> 2").select("n_name", F.when(F.col("n_nationkey") % 4 == 1, F.col("n_regionkey") + 1).otherwise(F.col("n_regionkey")).alias("n_regionkey"))
    return relations.reconcile(nations, live, "n_name", "n_regionkey")


@query("select sha256(text) as name, count(distinct source) as families from documents where text is not null group by name having count(distinct source) > 1")
def shared_names(spark, sf_dir):
    named = table(spark, sf_dir, "documents").where("text is not null").select(F.sha2("text", 256).alias("name"), "source").distinct()
    return named.groupBy("name").agg(F.count("source").alias("families")).where("families > 1")


@query("""select event_id, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as section from events""")
def log_section_fill(spark, sf_dir):
    marked = table(spark, sf_dir, "events").withColumn("mark", F.when(F.col("event_type") == "signup", F.col("event_id")))
    return trajectory.fill_forward(marked, "user_id", ["ts", "event_id"], "mark").select("event_id", "section")


@query("select left(text, 32) as session, arg_min(doc_id, (-n_chars, doc_id)) as doc_id, max(n_chars) as n_chars from documents group by session")
def session_argmax(spark, sf_dir):
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), "doc_id"))
    found = table(spark, sf_dir, "documents").groupBy(F.substring("text", 1, 32).alias("session")).agg(best.alias("b"))
    return found.select("session", "b.doc_id", (-F.col("b.n")).alias("n_chars"))


@query("""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from documents)
    select doc_id, cast(line_no as bigint) as line_no, line from (select *, row_number() over (partition by doc_id order by line_no) as r from l where contains(lower(line), 'the')) where r <= 3""")
def search_snippets(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).where(F.contains(F.lower("line"), F.lit("the")))
    first = lines.withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy("p"))).where("r <= 3")
    return first.select("doc_id", (F.col("p") + 1).cast("long").alias("line_no"), "line")


@query("select user_id % 10 as bucket, event_type, count(*) as n from events group by all")
def model_census(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy((F.col("user_id") % 10).alias("bucket"), "event_type").agg(F.count("*").alias("n"))


@query("""with w as (select distinct unnest(string_split(text, ' ')) as word from benchmark)
    select word, case when left(word, 1) <> lower(left(word, 1)) or word like '%ss' or length(word) < 4 then null when word like '%ies' then left(word, length(word) - 3) || 'y'
    when word like '%s' then left(word, length(word) - 1) when word like '%y' then left(word, length(word) - 1) || 'ies' else word || 's' end as twin from w""")
def word_number_twin(spark, sf_dir):
    found = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return found.select("word", number_twin(F.col("word")).alias("twin"))


@query("""with t as (select doc_id, text, regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') as l from documents),
    w as (select doc_id, unnest(list_concat([left(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9]+', '', 'g'), 60)],
    [substring(l, i + 1, 60) for i in range(0, cast(least(length(l), 300) as bigint), 60)])) as w from t) select doc_id, w from w where length(w) >= 25""")
def message_windows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(windows(F.col("text"))).alias("w"))


@query("""with r as (select doc_id, replace(left(text, 150), ': ', ' - ') as r from documents)
    select doc_id, case when length(r) <= 120 then r else left(r, 117) || '...' end as reason from r""")
def reason_cut(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", reason(F.concat(F.lit("Validation error: "), F.substring("text", 1, 150))).alias("reason"))


@query("""with n as (select doc_id, cast(n_chars as double) * n_chars * doc_id as n from documents)
    select doc_id, case when n < 1024 then format('{:.0f}B', n) when n < 1048576 then format('{:.0f}K', n / 1024) when n < 1073741824 then format('{:.0f}M', n / 1048576)
    when n < 1099511627776 then format('{:.0f}G', n / 1073741824) else format('{:.1f}T', n / 1099511627776) end as size from n""")
def size_phrase(spark, sf_dir):
    n = F.col("n_chars").cast("double") * F.col("n_chars") * F.col("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", human_size(n).alias("size"))


@query("""select l_orderkey, l_linenumber, cast(l_suppkey as varchar) || ' (' || case when l_suppkey >= l_partkey then '+' else '' end || cast(l_suppkey - l_partkey as varchar) || ')' as change from lineitem""")
def change_phrase(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", signed_change(F.col("l_partkey"), F.col("l_suppkey")).alias("change"))


@query("""with u as (select event_id, ts, lpad(printf('%x', (epoch_us(ts) // 1000)), 12, '0') as h from events)
    select event_id, case when event_id % 7 = 0 then null else make_timestamp((epoch_us(ts) // 1000) * 1000) end as at from u""")
def turn_instant(spark, sf_dir):
    h = F.lower(F.lpad(F.hex(F.unix_millis(F.col("ts").cast("timestamp"))), 12, "0"))
    anchor = F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.when(F.col("event_id") % 7 == 0, "-4").otherwise("-7"), F.lit("000-8000-000000000000"))
    return table(spark, sf_dir, "events").select("event_id", uuid7_instant(anchor).cast("timestamp_ntz").alias("at"))


_RAW = "concat(case page_id % 6 when 0 then '/home/claude/' when 1 then '/mnt/user-data/outputs/' when 2 then '/mnt/user-data/' when 3 then '/etc/' when 4 then 'a/../' else './b//' end, cast(page_id as string), '/f.txt')"


@query(f"""with p as (select page_id, {_RAW} as raw from pages), b as (select page_id, case when starts_with(raw, '/home/claude/') then substring(raw, 14) when starts_with(raw, '/mnt/user-data/outputs/') then substring(raw, 24)
    when starts_with(raw, '/mnt/user-data/') then substring(raw, 16) else raw end as b from p), l as (select page_id, b, list_filter(string_split(b, '/'), lambda x: x not in ('', '.')) as l from b)
    select page_id, case when b not like '/%' and not list_contains(l, '..') then array_to_string(l, '/') end as path from l""")
def path_sanitised(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", safe_path(F.expr(_RAW)).alias("path"))


_RELATION = "case doc_id % 5 when 0 then 'ABSENT' when 1 then 'IDENTICAL' when 2 then 'EXTENDS' when 3 then 'AHEAD' else 'DIVERGED' end"
_STATES = f"""s as (select doc_id, {_RELATION} as rel, case when doc_id % 13 = 5 then 'unlicensed' else judgement end as j from j),
    t as (select doc_id, case when doc_id % 11 = 0 then 'incomplete' when j = 'invalid' then 'invalid' when rel in ('AHEAD', 'DIVERGED') then 'would lose' when j = 'unlicensed' then 'unlicensed'
    when j = 'unjudged' then 'unjudged' when rel = 'IDENTICAL' then 'held already' else 'promotable' end as state, rel not in ('AHEAD', 'DIVERGED') and j = 'valid' as promotable from s)"""


def _staged(spark, sf_dir):
    units = verdicts.judged(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", "quality")
    rel, judgement = F.expr(_RELATION), F.when(F.col("doc_id") % 13 == 5, "unlicensed").otherwise(F.col("judgement"))
    state = verdicts.state(F.col("doc_id") % 11 == 0, rel, judgement, rel == "IDENTICAL")
    return units.select("doc_id", state.alias("state"), verdicts.promotable(rel, judgement).alias("promotable"))


@query(f"with {_JUDGED}, {_STATES} select * from t")
def unit_states(spark, sf_dir):
    return _staged(spark, sf_dir)


@query(f"""with {_JUDGED}, {_STATES}, d as (select unnest(['promotable', 'held already', 'would lose', 'invalid', 'unlicensed', 'unjudged', 'incomplete']) as state)
    select d.state, count(t.doc_id) as n from d left join t using (state) group by d.state""")
def state_tally(spark, sf_dir):
    return verdicts.tally(_staged(spark, sf_dir))


@query("""with m as (select distinct conv_id, turn from conversations where conv_id % 6 <> 4 and (conv_id % 3 <> 0 or turn < 3)),
    o as (select conv_id, turn, '2024-01-01T00:00:' || lpad(cast(turn as varchar), 2, '0') as stamp from conversations where conv_id % 5 <> 2 and (conv_id % 3 <> 1 or turn > 0) and (conv_id % 4 <> 3 or turn <> 2)),
    b as (select coalesce(m.conv_id, o.conv_id) as conv_id, m.turn as i, o.turn as j, o.stamp from m full join o on m.conv_id = o.conv_id and m.turn = o.turn),
    c as (select conv_id, count(i) as m, count(j) as o, count(*) filter (j is null) as here, count(*) filter (i is null) as there, max(stamp) filter (i is null) as newest from b group by conv_id)
    select conv_id, case when o = 0 then 'no-export' when here = 0 and there = 0 then 'in-sync' when there = 0 then 'ahead-of-export: +' || here || ' messages here'
    when here = 0 then 'stale: export holds ' || there || ' newer messages (through ' || newest || 'Z)' else 'anomaly: unique messages both here and in the export' end as currency from c where m > 0""")
def conversation_currency(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit("2024-01-01T00:00:"), F.lpad(F.col("turn").cast("string"), 2, "0")).alias("at"))
    other = said.where("conv_id % 5 <> 2 and (conv_id % 3 <> 1 or turn > 0) and (conv_id % 4 <> 3 or turn <> 2)")
    return relations.currency(said.where("conv_id % 6 <> 4 and (conv_id % 3 <> 0 or turn < 3)"), other, "conv_id", "turn", "at", "export")


@query("""select user_id, event_id, ts, event_type from (select *, event_type is distinct from lag(event_type) over (partition by user_id order by ts, event_id) as new from events) where new""")
def readings_collapsed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    found = trajectory.deposits(events, "user_id", ["ts", "event_id"], "event_type")
    return found.where("verdict = 'deposited'").select("user_id", "event_id", "ts", "event_type")


_PARENT = "case when turn = 0 then null when turn >= 2 and (conv_id + turn) % 4 = 1 then turn - 2 when (conv_id + turn) % 9 = 7 then turn + 1000 else turn - 1 end"


@query(f"""with recursive m as (select conv_id, turn, {_PARENT} as parent from conversations),
    p as (select conv_id, max(turn) as turn, 0 as hops from m group by conv_id union all select m.conv_id, m.parent, hops + 1 from p join m on p.conv_id = m.conv_id and p.turn = m.turn
    join m as q on q.conv_id = m.conv_id and q.turn = m.parent) select conv_id, turn, max(hops) over (partition by conv_id) - hops as place from p""")
def active_path(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(_PARENT).alias("parent"))
    return paths.active_path(said, said.groupBy("conv_id").agg(F.max("turn").alias("turn")), "conv_id", "turn", "parent").select("conv_id", "turn", F.col("place").cast("int").alias("place"))


@query(f"""with m as (select conv_id, turn, {_PARENT} as parent from conversations), c as (select m.conv_id, count(*) as n, count(*) filter (m.parent is null) as roots,
    count(*) filter (m.parent is not null and q.turn is null) as dangling from m left join m as q on q.conv_id = m.conv_id and q.turn = m.parent group by m.conv_id)
    select conv_id, roots, dangling from c where n > 1 and (roots <> 1 or dangling > 0)""")
def tree_problems(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(_PARENT).alias("parent"))
    return paths.tree_problems(said, "conv_id", "turn", "parent")
