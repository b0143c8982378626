"""Registered queries of the library operators beside their SQL twins. Inputs are derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import curation, library
from corvane.plans.archive import _DISPOSED, _curated
from corvane.plans.catalog import query
from corvane.session import table


@query("""with c as (select c_custkey as chat, md5(cast(c_custkey as varchar)) as uuid from customer where c_custkey % 6 <> 1), f as (select distinct case o_orderkey % 3 when 0 then 'talk-' || left(md5(cast(o_custkey as varchar)), 8) when 1 then left(md5(cast(o_custkey as varchar)), 8) || '-talk of it' else 'odd ' || o_custkey end as folder from orders)
    select folder, coalesce(min(c.chat), min(d.chat)) as chat, case when count(c.chat) > 0 then 'suffix' when count(d.chat) > 0 then 'prefix' else 'unknown' end as how from f left join c on left(c.uuid, 8) = right(folder, 8) left join c d on left(d.uuid, 8) = left(folder, 8) group by folder""")
def library_folders(spark, sf_dir):
    uuid = "md5(cast(cast({} as string) as binary))"
    chats = table(spark, sf_dir, "customer").where("c_custkey % 6 <> 1").selectExpr("c_custkey as chat", uuid.format("c_custkey") + " as uuid")
    key = "left(" + uuid.format("o_custkey") + ", 8)"
    folders = table(spark, sf_dir, "orders").selectExpr(f"case o_orderkey % 3 when 0 then 'talk-' || {key} when 1 then {key} || '-talk of it' else 'odd ' || o_custkey end as folder").distinct()
    return library.resolved_folders(folders, chats)


@query("""select conv_id, unnest([0, 1, 2])::int as place, unnest(['u' || turn, 'v' || turn, null]) as uuid, unnest([role, null, 'no id']) as name, unnest([true, false, false]) as valid from conversations where turn = 1""")
def exports_atomised(spark, sf_dir):
    item = "array(to_json(named_struct('uuid', 'u' || turn, 'name', role, 'chat_messages', array(named_struct('text', text)))), to_json(named_struct('uuid', 'v' || turn)), to_json(named_struct('name', 'no id', 'chat_messages', array(1))))"
    said = table(spark, sf_dir, "conversations").where("turn < 3").selectExpr("conv_id", f"case turn when 1 then '[' || array_join({item}, ',') || ']' when 2 then 'no json' end as body")
    return library.atomised(said, "conv_id", "body")


@query("""select event_id, case event_id % 4 when 0 then 'doc ' || user_id when 1 then 'pre ' || user_id else 'thumb ' || user_id end as url from events where event_id % 4 < 3 union all select event_id, 'doc' from events where event_id % 2 = 1""")
def asset_handles(spark, sf_dir):
    one = "named_struct('document_url', if(event_id % 4 = 0, 'doc ' || user_id, null), 'preview_url', if(event_id % 4 < 2, 'pre ' || user_id, null), 'thumbnail_url', if(event_id % 4 < 3, 'thumb ' || user_id, null))"
    other = "named_struct('document_url', if(event_id % 2 = 1, 'doc', null), 'preview_url', cast(null as string), 'thumbnail_url', cast(null as string))"
    return library.asset_handles(table(spark, sf_dir, "events").selectExpr("event_id", f"array({one}, {other}) as files"), ["event_id"], "files")


@query("select event_id, ordinal from (select event_id, event_type, row_number() over (order by ts, event_id) as ordinal from events) where event_type <> 'error'")
def legacy_numbers(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return library.legacy_numbers(events, ["ts", "event_id"], F.to_date("ts"), F.col("event_type") == "error").select("event_id", "ordinal")


@query("""with l as (select doc_id, 1 + doc_id // 3 as place from documents where doc_id % 3 = 0), c as (select doc_id from documents where doc_id % 4 <> 0) select doc_id, cast(coalesce(place, (select max(place) from l) + row_number() over (partition by place is null order by doc_id)) as bigint) as ordinal from c left join l using (doc_id)""")
def ordinals_listed_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    listing = docs.where("doc_id % 3 = 0").selectExpr("doc_id", "1 + doc_id div 3 as place")
    return library.listed_first(docs.where("doc_id % 4 <> 0"), listing, "doc_id", F.expr("doc_id div 1000000"))


@query("""select doc_id, case when doc_id % 3 = 0 then 'in extraction' when doc_id % 5 = 0 then 'library only' when doc_id % 2 = 0 then 'unharvested: ' || lang else 'unharvested: unknown' end as standing from documents""")
def harvest_standing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return library.harvested(docs, docs.where("doc_id % 3 = 0"), docs.where("doc_id % 5 = 0"), docs.where("doc_id % 2 = 0").withColumnRenamed("lang", "reason"), "doc_id")


@query("""select source, cast(greatest(count(*) - 2 * count(*) filter (doc_id % 7 < 3 and source <> 'src1'), 0) as bigint) as lag from documents group by source""")
def capture_lag(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    covered = docs.where("doc_id % 7 < 3 and source <> 'src1'")
    return library.capture_lag(docs, covered.union(covered), "source")


@query("""select case when l_orderkey % 5 = 1 then 'no datum' when l_orderkey % 7 = 1 then 'no record' when l_linenumber > 2 then 'incomplete' else 'complete' end as standing, count(*) as n from lineitem group by 1""")
def pair_census(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").selectExpr("if(l_orderkey % 5 = 1, null, 'd') as datum", "if(l_orderkey % 7 = 1, null, 'r') as record", "if(l_linenumber = 1, null, array('a', 'b' || l_linenumber)) as categories", "array('a', 'b2', 'c') as members")
    return library.pair_census(pairs)


@query("""with e as (select user_id, event_id, event_type = 'purchase' as s from events where event_type <> 'view'), m as (select *, case when not s and lag(s) over w then 1 else 0 end as o from e window w as (partition by user_id order by event_id)),
    n as (select *, sum(o) over (partition by user_id order by event_id) as message from m) select user_id, cast(message as bigint) as message, min(event_id) as first, max(event_id) as last, count(*) filter (s) as signatures from n group by user_id, message""")
def message_segments(spark, sf_dir):
    """Purchases stand for signature lines, views for blank ones."""
    lines = table(spark, sf_dir, "events").withColumn("line", F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")))
    return library.segments(lines, "user_id", "event_id", "line", F.col("event_type") == "purchase")


@query("select event_type, count(*) as n, strftime(min(ts), '%Y-%m-%d') as since, strftime(max(ts), '%Y-%m-%d') as until from events group by event_type")
def corpus_title(spark, sf_dir):
    return library.title_range(table(spark, sf_dir, "events"), ["event_type"], "ts")


@query("""with n as (select r_name, n_name, row_number() over (partition by r_name order by n_name) as r, count(*) over (partition by r_name) as c from nation join region on n_regionkey = r_regionkey)
    select r_name, string_agg(n_name, ', ' order by r) || case when max(c) > 4 then ', …' else '' end as names from n where r <= 4 group by r_name""")
def labels_first_shown(spark, sf_dir):
    both = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return library.first_shown(both, "r_name", "n_name")


@query("select distinct l_suppkey as unit, l_linenumber as name from lineitem where l_linenumber > 2")
def surplus_files(spark, sf_dir):
    files = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey as unit", "l_linenumber as name")
    return library.surplus(files, table(spark, sf_dir, "supplier").selectExpr("s_suppkey as unit", "explode(array(1, 2)) as name"))


@query("select conv_id, turn, 'f/' || turn as path, text from conversations where turn % 3 > 0")
def created_files(spark, sf_dir):
    calls = "array(named_struct('type', 'text', 'name', 'create_file', 'path', 'no', 'text', 'no'), named_struct('type', 'tool_use', 'name', 'create_file', 'path', if(turn % 3 > 0, 'f/' || turn, ' '), 'text', text), named_struct('type', 'tool_use', 'name', 'view', 'path', 'no', 'text', 'no'))"
    return library.created_files(table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", f"{calls} as content"), ["conv_id", "turn"], "content")


@query("select item_id as book, case when item_id % 4 = 0 then 'waits' when item_id % 4 = 1 then 'current' else 'stale' end as standing from benchmark")
def index_standing(spark, sf_dir):
    digest = "sha2(text, 256)"
    return library.index_standing(table(spark, sf_dir, "benchmark").selectExpr("item_id as book", f"if(item_id % 4 = 0, null, {digest}) as judged", f"case item_id % 4 when 1 then {digest} when 2 then 'old' end as rendered"))


@query("""with f as (select r_regionkey as stamp, 'acc ' || (n_nationkey % (1 + r_regionkey % 2)) as account, 'field ' || n_name as field, n_name as text from nation join region on n_regionkey = r_regionkey where r_regionkey <> 4 or n_nationkey = (select min(n_nationkey) from nation where n_regionkey = 4)),
    c as (select *, count(*) over (partition by stamp, account) as k, row_number() over (partition by stamp, account order by field) as r from f), m as (select *, (select count(distinct account) from f g where g.stamp = c.stamp) as a from c)
    select stamp, string_agg(case when a > 1 and r = 1 then '# ' || account || chr(10) || chr(10) else '' end || case when k > 1 then '## ' || field || chr(10) || chr(10) else '' end || text, chr(10) || chr(10) order by account, field) as markdown from m group by stamp""")
def memory_sections(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    both = nation.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    least = nation.where("n_regionkey = 4").agg(F.min("n_nationkey").alias("least"))
    both = both.join(least).where("r_regionkey <> 4 or n_nationkey = least")
    return library.memory_markdown(both.selectExpr("r_regionkey as stamp", "'acc ' || n_nationkey % (1 + r_regionkey % 2) as account", "'field ' || n_name as field", "' ' || n_name || ' ' as text"), "stamp")


@query("select case when p_partkey % 5 = 0 then '(none)' else p_type end as layer, count(*) as n from part group by 1")
def schema_layers(spark, sf_dir):
    return library.layers(table(spark, sf_dir, "part").selectExpr("if(p_partkey % 5 = 0, p_name, '[' || p_type || '] ' || p_name) as description"), "description")


@query(f"""with {_DISPOSED} select concept from d where "by" is null and concept not like 'B%'""")
def candidate_queue(spark, sf_dir):
    """Concepts not disposed of that a text anchors: here all but those that begin with B."""
    concepts, accepted, rejected = _curated(spark, sf_dir)
    return curation.queue(concepts, accepted, rejected, concepts.where("concept not like 'B%'"))
