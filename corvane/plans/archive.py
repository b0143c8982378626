"""More registered queries beside their SQL twins: projections, copies, curation, standing. Inputs are derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import copies, curation, projection, standing, trajectory, turns
from corvane.plans.catalog import _COUNTS, query
from corvane.session import table

L = r"[\p{L}\p{N}_]"
_TERMS = "terms as (select item_id, unnest([string_split(text, ' ')[1], string_split(text, ' ')[2] || ' ' || string_split(text, ' ')[3]]) as term from benchmark)"
#: A term stands in a text as whole words where it does so with every run of word characters put between marks.
_BOUND = f"""marked as materialized (select doc_id, regexp_replace(lower(text), '({L}+)', chr(31) || '\\1' || chr(31), 'g') as text from documents),
    pats as (select distinct item_id, regexp_replace(lower(term), '({L}+)', chr(31) || '\\1' || chr(31), 'g') as pat from terms where trim(term) <> '')"""
_LOC = f"{_TERMS}, {_BOUND}, loc as (select distinct item_id, doc_id from marked join pats on contains(text, pat))"


def _heads(spark, sf_dir):
    w = F.split("text", " ")
    return table(spark, sf_dir, "benchmark").select("item_id", F.get(w, F.lit(0)).alias("head"), F.array(F.concat_ws(" ", F.get(w, F.lit(1)), F.get(w, F.lit(2)))).alias("aliases"))


def _located(spark, sf_dir):
    return curation.term_locators(table(spark, sf_dir, "documents"), curation.terms_of(_heads(spark, sf_dir)))


@query(f"with {_LOC} select item_id, doc_id from loc")
def term_locators(spark, sf_dir):
    """The first word of each benchmark item and its next two stand for a headword and an alias."""
    return _located(spark, sf_dir)


@query(f"with {_LOC} select item_id, count(*) as count, case when count(distinct lang) = 1 then min(lang) else 'both' end as provider from loc join documents using (doc_id) group by item_id")
def concept_table(spark, sf_dir):
    found = _located(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return curation.concept_table(found, "lang")


@query(f"with {_LOC} select count(distinct item_id) as located, (select count(*) from benchmark) as accepted, count(*) as locators, count(distinct source) as conversations from loc join documents using (doc_id)")
def index_summary(spark, sf_dir):
    found = _located(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return curation.index_summary(_heads(spark, sf_dir), found, "source")


_CONCEPTS = "select distinct c_mktsegment || ' ' || lower(n_name) as concept from customer join nation on c_nationkey = n_nationkey"
_ACCEPTED = "select n_name as term from nation where n_nationkey % 3 = 0"
_REJECTED = "select c_mktsegment || ' ' || n_name as term, 'odd' as reason from customer join nation on c_nationkey = n_nationkey where n_nationkey % 5 = 1"


def _curated(spark, sf_dir):
    names = {n: table(spark, sf_dir, n) for n in ("customer", "nation")}
    asked = lambda q: spark.sql(q.replace("from customer", "from {customer}").replace("join nation", "join {nation}").replace("from nation", "from {nation}"), **{k: v for k, v in names.items() if k in q})
    return asked(_CONCEPTS), asked(_ACCEPTED), asked(_REJECTED)


_DISPOSED = f"""concepts as ({_CONCEPTS}), acc as ({_ACCEPTED}), rej as ({_REJECTED}), d as (select concept, case when exists (select 1 from acc where regexp_matches(concept, '(?i)(?:^|[^A-Za-z0-9_])' || term || '(?:$|[^A-Za-z0-9_])')) then 'accepted'
    when lower(concept) in (select lower(term) from rej) then 'rejected' end as "by" from concepts)"""


@query(f"with {_DISPOSED} select * from d")
def concepts_disposed(spark, sf_dir):
    return curation.disposed(*_curated(spark, sf_dir))


@query(f"with {_DISPOSED} select concept, 'listed only' as side from d where \"by\" = 'accepted' union all select concept, 'live only' from d where \"by\" is null and concept like 'A%'")
def queue_moved(spark, sf_dir):
    found = curation.disposed(*_curated(spark, sf_dir))
    listed = found.where("`by` = 'accepted' or (`by` is null and concept not like 'A%')")
    return curation.queue_moved(listed, found.where("`by` is null"))


@query(f"""with {_DISPOSED} select concept as term, 'new' as reason, case when "by" = 'accepted' then 'covered' when "by" = 'rejected' then 'already rejected' else 'added' end as outcome from d""")
def reject_outcomes(spark, sf_dir):
    concepts, accepted, rejected = _curated(spark, sf_dir)
    return curation.reject(accepted, rejected, concepts.select(F.col("concept").alias("term"), F.lit("new").alias("reason")))


@query("""with o as (select n_name as head, [lower(r_name), 'x' || n_nationkey] as aliases, 0 as side from nation join region on n_regionkey = r_regionkey where n_nationkey % 4 <> 1
    union all select lower(n_name), [r_name, upper('x' || n_nationkey), 'new'], 1 from nation join region on n_regionkey = r_regionkey where n_nationkey % 3 <> 1),
    h as (select lower(head) as low, arg_min(head, side) as head from o group by low), a as (select lower(head) as low, side, p, aliases[p] as alias from (select *, unnest(range(1, len(aliases) + 1)) as p from o)),
    f as (select low, lower(alias) as al, min((side, p, alias)) as f from a where lower(alias) <> low group by all)
    select h.head, array_to_string(list(f.f[3] order by f.f), ',') as aliases from h left join f using (low) group by h.head""")
def accept_merged(spark, sf_dir):
    both = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    old = both.where("n_nationkey % 4 <> 1").selectExpr("n_name as head", "array(lower(r_name), 'x' || n_nationkey) as aliases")
    new = both.where("n_nationkey % 3 <> 1").selectExpr("lower(n_name) as head", "array(r_name, upper('x' || n_nationkey), 'new') as aliases")
    return curation.accept(old, new).select("head", F.array_join("aliases", ",").alias("aliases"))


@query("""with h as (select distinct split_part(text, ' ', 1) as head from documents where text <> '') select case when regexp_matches(upper(left(head, 1)), '^\\p{L}$') then upper(left(head, 1)) else '·' end as letter, count(*) as heads from h group by letter""")
def letter_buckets(spark, sf_dir):
    return curation.letter_buckets(table(spark, sf_dir, "documents").where("text <> ''").select(F.split_part("text", F.lit(" "), F.lit(1)).alias("head")).distinct())


@query("""select 'category ' || source || ' is not in the palette' as reason, count(*) as n from documents where source in ('src1', 'src7') group by source
    union all select 'coverage fell', (select count(distinct conv_id) from conversations) - (select count(distinct doc_id) from documents) where (select count(distinct conv_id) from conversations) > (select count(distinct doc_id) from documents)""")
def capture_refusals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), F.col("source").alias("category"))
    return curation.capture_refusals(docs, docs.where("category not in ('src1', 'src7')"), table(spark, sf_dir, "conversations"))


# Turns of rendered markdown: each text quotes headings that are not the next of their side.
_QUOTED = "text || chr(10) || '## Human (1)' || chr(10) || '## Claude (99)'"


def _rendered(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").where("conv_id % 10 <> 7 or role <> 'system'")
    first = "case when role = 'assistant' then text || chr(10) || '## Human (1)' || chr(10) || '## Claude (99)' else text end"
    return projection.rendered(said.selectExpr("conv_id", "turn", "role", f"{first} as text"))


@query("""select conv_id, count(*) filter (role = 'user') as human, count(*) filter (role = 'assistant') as assistant, count(*) as total from conversations where role in ('user', 'assistant') group by conv_id
    having min(case when role = 'user' then turn end) < min(case when role = 'assistant' then turn end) or count(*) filter (role = 'assistant') = 0""")
def turns_sequential_accept(spark, sf_dir):
    """Conversations that a user opens: there a quoted first heading is never the next."""
    opened = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min(F.expr("case when role = 'user' then turn end")).alias("u"), F.min(F.expr("case when role = 'assistant' then turn end")).alias("a")).where("u < a or (a is null and u is not null)")
    return projection.extents(_rendered(spark, sf_dir).join(opened, "conv_id", "left_semi"))


@query(r"""with t as (select conv_id, row_number() over (partition by conv_id order by turn) as place, case role when 'user' then 'H' else 'A' end as side, trim(regexp_replace(text, '[ \t\n\r\f\x0B]+', ' ', 'g')) as body
    from conversations where role in ('user', 'assistant')) select conv_id, place::int as place, side, regexp_replace(body, '\s*---$', '') as body from t""")
def turn_sequences(spark, sf_dir):
    return projection.turn_sequence(projection.rendered(table(spark, sf_dir, "conversations")))


@query("""with c as (select conv_id, count(*) filter (role = 'user') as h, count(*) filter (role = 'assistant') as a from conversations where role in ('user', 'assistant') group by conv_id)
    select conv_id, case when conv_id % 5 = 0 then 'declares no turn counts' else 'declares ' || (h + 1) || '/' || a || ' and its headings hold ' || h || '/' || a end as reason from c where conv_id % 5 = 0 or conv_id % 3 = 0""")
def render_refusals(spark, sf_dir):
    said = table(spark, sf_dir, "conversations")
    declared = turns.counts(said.where("role in ('user', 'assistant')")).where("conv_id % 5 <> 0").withColumn("human", F.when(F.col("conv_id") % 3 == 0, F.col("human") + 1).otherwise(F.col("human")))
    return projection.refusals(declared, projection.rendered(said))


@query("""select conv_id, bool_and(coalesce(trim(case when (conv_id + turn) % 2 = 0 or conv_id % 4 = 0 then ' ' else text end), '') = '' and conv_id % 8 <> 4) as is_empty from conversations group by conv_id""")
def conversations_empty(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").selectExpr("conv_id", "case when (conv_id + turn) % 2 = 0 or conv_id % 4 = 0 then ' ' else text end as text", "if(conv_id % 8 = 4, array('f'), array()) as files", "cast(null as array<string>) as blocks")
    return projection.empty_conversations(said, said, projection.blank(F.col("text"), F.col("blocks"), F.col("blocks"), F.col("files")))


_RECORD = """to_json(named_struct('type', case when (conv_id + turn) % 13 = 5 then 'ai-title' when role = 'system' then 'summary' else role end, 'aiTitle', if((conv_id + turn) % 13 = 5, if(turn % 2 = 0, 'title ' || turn, ''), null),
    'isSidechain', if((conv_id + turn) % 7 = 3, true, null), 'isMeta', if((conv_id + turn) % 11 = 3, true, null), 'toolUseResult', if((conv_id + turn) % 5 = 2, 'x', null), 'timestamp', '2024-01-01T00:00:' || lpad(cast(turn as string), 2, '0') || 'Z',
    'message', named_struct('content', array(named_struct('type', 'thinking', 'text', 'hm'), named_struct('type', 'text', 'text', ' ' || text || ' '), named_struct('type', 'text', 'text', ' ')))))"""


def _records(spark, sf_dir):
    return table(spark, sf_dir, "conversations").selectExpr("conv_id as session", "turn as pos", f"{_RECORD} as line")


@query("""select conv_id as session, turn as pos, case role when 'user' then 'human' else 'assistant' end as role, '2024-01-01T00:00:' || lpad(cast(turn as varchar), 2, '0') || 'Z' as at, trim(text) as text from conversations
    where role in ('user', 'assistant') and (conv_id + turn) % 13 <> 5 and (conv_id + turn) % 7 <> 3 and (conv_id + turn) % 11 <> 3 and (role <> 'user' or (conv_id + turn) % 5 <> 2) and trim(text) <> ''""")
def session_talk(spark, sf_dir):
    return projection.session_talk(_records(spark, sf_dir))


@query("""select conv_id as session, coalesce(arg_max('title ' || turn, turn) filter ((conv_id + turn) % 13 = 5 and turn % 2 = 0), '') as title, '2024-01-01T00:00:' || lpad(cast(min(turn) as varchar), 2, '0') || 'Z' as created,
    '2024-01-01T00:00:' || lpad(cast(max(turn) as varchar), 2, '0') || 'Z' as last_activity from conversations group by conv_id""")
def session_facts(spark, sf_dir):
    return projection.session_facts(_records(spark, sf_dir))


@query("""select conv_id as session, turn as pos, case role when 'user' then 'human' else 'assistant' end as role, trim(text) as text from conversations where role in ('user', 'assistant') and trim(text) <> ''""")
def step_talk(spark, sf_dir):
    kind = "case role when 'user' then 'USER_INPUT' when 'assistant' then 'PLANNER_RESPONSE' else 'CHECKPOINT' end as type"
    return projection.step_talk(table(spark, sf_dir, "conversations").selectExpr("conv_id as session", "turn as pos", kind, "case when role = 'user' and turn % 3 = 0 then '<EXTRA>a</EXTRA><USER_REQUEST>\n' || text || '\n</USER_REQUEST>' else text end as content"))


@query("""select conv_id, 'd/' || turn % 3 as path, arg_max(text, turn) as content from conversations where turn % 5 <> 4 group by all""")
def files_written(spark, sf_dir):
    return projection.files_written(table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn as pos", "if(turn % 5 = 4, ' ', 'd/' || turn % 3) as path", "text as content"))


@query("""select conv_id, turn, unnest(['/home/claude/a' || turn || '.txt', 'b']) as path, unnest([replace(text, chr(10), ' ') || chr(10) || 'x', 'two']) as content from conversations where text is not null""")
def heredoc_files(spark, sf_dir):
    command = "'ls && cat > /home/claude/a' || turn || '.txt << ''EOF''\n' || replace(text, '\n', ' ') || '\nx\nEOF\ncat >> no << ''E''\nq\nE\ncat > b <<''END''\ntwo\nEND\ncat > c << PLAIN\nz\nPLAIN' as command"
    found = table(spark, sf_dir, "conversations").where("text is not null").selectExpr("conv_id", "turn", command)
    return found.select("conv_id", "turn", F.inline(tx.heredocs(F.col("command"))))


@query("""select doc_id, cast(n_chars as varchar) as n, case when doc_id % 2 = 0 then lang || ': x' else source end as k, case when doc_id % 3 = 0 then 'abcdef01-0000-4000-8000-' || lpad(cast(doc_id as varchar), 12, '0') else 'c' || doc_id end as id, 'body ' || doc_id as body from documents""")
def frontmatter_items(spark, sf_dir):
    uuid = "if(doc_id % 3 = 0, 'uuid: abcdef01-0000-4000-8000-' || lpad(cast(doc_id as string), 12, '0') || '\n', '')"
    md = f"'---\n' || {uuid} || 'k: old\nno item\nn: ' || n_chars || '\nk: ' || if(doc_id % 2 = 0, lang || ': x', source) || '\n---\n\n' || 'body ' || doc_id"
    df = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{md} as md")
    whole = F.concat(F.col("md"), F.lit("\n<https://a.b/chat/c"), F.col("doc_id").cast("string"), F.lit("/?q=1#x>"))
    items = tx.frontmatter(F.col("md"))
    return df.select("doc_id", items["n"].alias("n"), items["k"].alias("k"), tx.conversation_id(whole).alias("id"), tx.without_frontmatter(F.col("md")).alias("body"))


@query("""select conv_id, turn, case when turn % 3 = 2 then trim(text) else trim(text) || chr(10) || chr(10) || 'end' end as text, role in ('user', 'system') as binary from conversations where trim(text) <> ''""")
def block_texts(spark, sf_dir):
    blocks = "array(named_struct('type', 'tool_use', 'text', 'no'), named_struct('type', 'text', 'text', '  ' || text), named_struct('type', 'text', 'text', if(turn % 3 = 2, ' ', ' end ')))"
    df = table(spark, sf_dir, "conversations").where("trim(text) <> ''").selectExpr("conv_id", "turn", f"{blocks} as content", "case role when 'user' then 'image/png' when 'system' then 'application/pdf' when 'assistant' then 'text/plain' end as mime")
    return df.select("conv_id", "turn", tx.block_text(F.col("content")).alias("text"), tx.binary_mime(F.col("mime")).alias("binary"))


# Copies: documents of one source are the files of a unit, by name; the held side is cut or lacks some.
_HELD = "case when doc_id % 5 = 1 and source like '%1' then left(text, length(text) // 2) when source like '%2' and doc_id % 5 = 2 then text || ' more' when source like '%3' and doc_id % 7 = 3 then 'x' || text else text end"


def _files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null")
    held = docs.where("source not like '%4' and (source not like '%5' or doc_id % 3 <> 0)").selectExpr("source as unit", "doc_id as name", _HELD.replace(" // ", " div ") + " as text")
    return docs.selectExpr("source as unit", "doc_id as name", "text"), held


_FILES = f"s as (select source as unit, doc_id as name, text from documents where text is not null), h as (select source as unit, doc_id as name, {_HELD} as text from documents where text is not null and source not like '%4' and (source not like '%5' or doc_id % 3 <> 0))"


@query(f"""with {_FILES}, b as (select s.unit, h.name is not null as inh, starts_with(s.text, h.text) as le, starts_with(h.text, s.text) as ge from s left join h on s.unit = h.unit and s.name = h.name)
    select unit, case when not bool_or(inh) then 'ABSENT' when bool_and(coalesce(le, true)) and bool_and(coalesce(ge, false)) then 'IDENTICAL' when bool_and(coalesce(le, true)) then 'EXTENDS'
    when bool_and(coalesce(ge, false)) then 'AHEAD' else 'DIVERGED' end as relation from b group by unit""")
def relation_file_prefix(spark, sf_dir):
    return copies.relate("prefix", *_files(spark, sf_dir))


@query("with s as (" + _COUNTS.format(src="conversations where conv_id % 3 > 0 or turn < 3") + "), h as (" + _COUNTS.format(src="conversations where conv_id % 5 <> 1 and (conv_id % 3 < 2 or turn < 2 or role = 'user')") + """)
    select s.conv_id, case when h.conv_id is null then 'ABSENT' when h.human = s.human and h.total = s.total then 'IDENTICAL' when h.human <= s.human and h.total <= s.total then 'EXTENDS'
    when s.human <= h.human and s.total <= h.total then 'AHEAD' else 'DIVERGED' end as relation from s left join h using (conv_id)""")
def relation_turn_extent(spark, sf_dir):
    said = table(spark, sf_dir, "conversations")
    return copies.relate("turn-extent", turns.counts(said.where("conv_id % 3 > 0 or turn < 3")), turns.counts(said.where("conv_id % 5 <> 1 and (conv_id % 3 < 2 or turn < 2 or role = 'user')")), "conv_id", ["human", "total"])


@query(f"""with {_FILES}, b as (select s.name, case when h.name is null then 'ABSENT' when s.text = h.text then 'IDENTICAL' end as r from s left join h on s.name = h.name and s.unit = h.unit)
    select name, coalesce(r, 'EXTENDS') as mirror, coalesce(r, 'DIVERGED') as whole from b""")
def relation_mirror_whole(spark, sf_dir):
    s, h = (df.select("name", F.sha2("text", 256).alias("digest")) for df in _files(spark, sf_dir))
    a = copies.relate("mirror", s, h, "name", "digest").withColumnRenamed("relation", "mirror")
    return a.join(copies.relate("whole", s, h, "name", "digest").withColumnRenamed("relation", "whole"), "name")


@query(f"""with {_FILES} select s.name, case when h.name is null then 'ABSENT' when s.text = h.text then 'IDENTICAL' when starts_with(s.text, h.text) then 'EXTENDS' when starts_with(h.text, s.text) then 'AHEAD' else 'DIVERGED' end as relation,
    case when h.name is null then 'written' when s.text = h.text then 'kept' when starts_with(s.text, h.text) then 'fast-forwarded' when starts_with(h.text, s.text) then 'kept' else 'conflict' end as action,
    octet_length(encode(s.text)) - coalesce(octet_length(encode(h.text)), 0) as growth from s left join h on s.name = h.name and s.unit = h.unit""")
def log_placement(spark, sf_dir):
    return copies.placed(*_files(spark, sf_dir), "name", "text")


@query(f"""with {_FILES}, b as (select s.unit, case when h.name is null then 'ABSENT' when s.text = h.text then 'IDENTICAL' when starts_with(s.text, h.text) then 'EXTENDS' when starts_with(h.text, s.text) then 'AHEAD' else 'DIVERGED' end as relation
    from s left join h on s.name = h.name and s.unit = h.unit) select unit, relation, count(*) as n from b group by all""")
def tree_tally(spark, sf_dir):
    return copies.tree_tally(*_files(spark, sf_dir), "unit", "name", "text")


_ATOMS = "a as (select distinct user_id % 2 as g, user_id as k, event_type || '/' || cast(ts as date) % 4 as atom from events where user_id <= 60 or event_id % 9 = 0)".replace("cast(ts as date) % 4", "(day(ts) % 6)")


@query(f"""with {_ATOMS}, n as (select g, k, count(*) as n from a group by all), p as (select x.k, y.k as holder, count(*) as shared from a x join a y on x.g = y.g and x.atom = y.atom and x.k <> y.k group by all),
    q as (select p.k, p.holder, nx.n, ny.n as m from p join n nx on nx.k = p.k join n ny on ny.k = p.holder where p.shared = nx.n)
    select k, coalesce(arg_min(holder, (-m, holder)) filter (m > n), min(holder) filter (m = n)) as holder, case when count(*) filter (m > n) > 0 then 'contained' else 'identical' end as how from q group by k
    having count(*) filter (m > n) > 0 or min(holder) filter (m = n) < k""")
def held_twice_contained(spark, sf_dir):
    units = table(spark, sf_dir, "events").where("user_id <= 60 or event_id % 9 = 0").selectExpr("user_id % 2 as g", "user_id as k", "event_type || '/' || (day(ts) % 6) as atom")
    return copies.contained(units, ["g"], "k", "atom")


_CUTS = "select doc_id, case when doc_id % 4 = 1 then text else left(text, cast(20 + doc_id % 90 as int)) end as text from documents where text <> ''"


@query(f"with u as ({_CUTS}) select a.doc_id, arg_min(b.doc_id, (-length(b.text), b.doc_id)) as holder from u a join u b on starts_with(b.text, a.text) and length(b.text) > length(a.text) group by a.doc_id")
def prefix_duplicates(spark, sf_dir):
    return copies.prefix_duplicates(spark.sql(_CUTS.replace("from documents", "from {documents}"), documents=table(spark, sf_dir, "documents")), "doc_id", "text")


@query("""select user_id, arg_min(event_id, (-length(props), event_type <> 'click', event_id)) as place from events group by user_id""")
def fuller_copy(spark, sf_dir):
    return copies.fuller(table(spark, sf_dir, "events").selectExpr("user_id", "length(props) as size", "event_type = 'click' as near", "event_id"), "user_id", "size", "near", "event_id")


@query(f"with {_FILES} select s.name, min(p) as peer from s join (select *, 'room' || (name % 3) as p from h union all select *, 'room9' from h where name % 2 = 0) h on s.name = h.name where starts_with(h.text, s.text) group by s.name")
def held_by_peer(spark, sf_dir):
    mine, held = _files(spark, sf_dir)
    peers = held.withColumn("peer", F.concat(F.lit("room"), (F.col("name") % 3).cast("string"))).union(held.where("name % 2 = 0").withColumn("peer", F.lit("room9")))
    return copies.held_by_peer(mine, peers, "name", "text")


@query("""with a as (select distinct 'export-' || lpad(cast(day(ts) as varchar), 2, '0') as export, event_type as component, user_id as atom from events), d as (select distinct event_type as component, user_id as atom from events where user_id % 3 = 0),
    k as (select * from a anti join d using (component, atom)), n as (select export as earlier, lead(export) over (order by export) as later from (select distinct export from a))
    select n.earlier, n.later, count(k.atom) as missing from n left join (select k.export, k.component, k.atom, n.later from k join n on n.earlier = k.export where not exists (select 1 from k z where z.export = n.later and z.component = k.component and z.atom = k.atom)) k
    on k.export = n.earlier where n.later is not null group by all""")
def export_containment(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    atoms = events.selectExpr("'export-' || lpad(cast(day(ts) as string), 2, '0') as export", "event_type as component", "user_id as atom")
    return copies.export_containment(atoms, events.where("user_id % 3 = 0").selectExpr("event_type as component", "user_id as atom"))


@query("""with e as (select conv_id, turn, conv_id % 9 = 2 as blank from conversations where conv_id % 6 <> 1 and (conv_id % 4 <> 1 or turn > 0)), c as (select distinct conv_id, turn from conversations where conv_id % 3 <> 2 and (conv_id % 5 <> 1 or turn < 2)),
    b as (select coalesce(e.conv_id, c.conv_id) as conv_id, e.turn as e, c.turn as c, e.blank from e full join c on e.conv_id = c.conv_id and e.turn = c.turn),
    g as (select conv_id, count(e) as e, count(c) as c, count(*) filter (c is null) as there, count(*) filter (e is null) as here, bool_and(blank) as blank from b group by conv_id)
    select conv_id, case when c = 0 and blank then 'blank' when c = 0 then 'export-only' when e = 0 then 'capture-only' when there = 0 and here = 0 then 'in-sync' when there = 0 then 'capture-ahead' when here = 0 then 'capture-stale' else 'anomaly' end as standing, there from g""")
def capture_standing(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").withColumnRenamed("turn", "message")
    return copies.capture_standing(said.where("conv_id % 6 <> 1 and (conv_id % 4 <> 1 or message > 0)"), said.where("conv_id % 3 <> 2 and (conv_id % 5 <> 1 or message < 2)"), F.col("conv_id") % 9 == 2)


@query("""with l as (select user_id, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) as at from events where user_id % 7 <> 0 group by user_id), c as (select user_id, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) as at from events where user_id % 5 <> 0 and (user_id % 3 > 0 or event_id % 2 = 0) group by user_id)
    select coalesce(l.user_id, c.user_id) as user_id, case when c.user_id is null then 'new' when l.user_id is null then 'no longer listed' when l.at > c.at then 'grown' else 'current' end as standing from l full join c on l.user_id = c.user_id""")
def account_standing(spark, sf_dir):
    last = lambda df: df.groupBy("user_id").agg(F.max(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("at"))
    events = table(spark, sf_dir, "events")
    return copies.account_standing(last(events.where("user_id % 7 <> 0")), last(events.where("user_id % 5 <> 0 and (user_id % 3 > 0 or event_id % 2 = 0)")), "user_id", "at")


@query("with h as (" + _COUNTS.format(src="conversations where conv_id % 5 <> 1 and (conv_id % 4 > 0 or turn < 3)") + "), a as (" + _COUNTS.format(src="conversations where conv_id % 7 <> 2 and (conv_id % 3 > 0 or turn < 4)") + """)
    select coalesce(h.conv_id, a.conv_id) as conv_id, case when a.conv_id is null or a.human < h.human or a.total < h.total then 'held' else 'arriving' end as kept from h full join a on h.conv_id = a.conv_id""")
def monotone_guard(spark, sf_dir):
    said = table(spark, sf_dir, "conversations")
    return copies.monotone(turns.counts(said.where("conv_id % 5 <> 1 and (conv_id % 4 > 0 or turn < 3)")), turns.counts(said.where("conv_id % 7 <> 2 and (conv_id % 3 > 0 or turn < 4)")), "conv_id", ["human", "total"])


@query("""with f as (select user_id, date_trunc('hour', ts) as stamp, event_id, event_type, row_number() over (partition by user_id, date_trunc('hour', ts) order by event_id) as r from events),
    w as (select user_id, stamp, event_type as c, row_number() over p as k, lag(event_type) over p as b from f where r = 1 window p as (partition by user_id order by stamp))
    select event_id, case when r = 1 and (w.k = 1 or f.event_type is distinct from w.b) then 'deposited' when f.event_type is not distinct from w.c then 'unchanged' else 'conflict' end as verdict from f join w using (user_id, stamp)""")
def accumulate_verdicts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.date_trunc("hour", "ts").alias("stamp"), "event_type")
    return trajectory.accumulated(events, "user_id", "stamp", "event_id", "event_type").select("event_id", "verdict")


@query("""with r as (select user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type from events group by user_id)
    select user_id, event_id, event_type from r where not exists (select 1 from events d where d.user_id = r.user_id and d.event_type = r.event_type and d.event_id % 3 = 0)""")
def rolling_readings(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return trajectory.rolling(events, events.where("event_id % 3 = 0"), "user_id", "event_id", "event_type")


# Standing: documents are staged units, labels their verdicts.
_RECORD_ROWS = """select d.doc_id as unit, d.source as fam, case when d.doc_id % 11 = 3 then 'old' else 'd' || d.doc_id end as digest, case when d.doc_id % 10 <> 4 then 'f' || d.doc_id % 3 end as family, 'v' || (9 + d.doc_id % 3) as version,
    case when d.doc_id % 23 = 1 then 'other' else 'd' || d.doc_id end as datum_digest, case when d.doc_id % 29 <> 2 then 's' || d.doc_id % 5 end as schema_digest, case when l.quality = 1 then 'valid' else 'invalid' end as verdict
    from documents d join labels l on d.doc_id = l.doc_id"""
_UNITS = "select doc_id as unit, case when doc_id % 17 <> 5 then 'p' end as pipeline, doc_id % 19 <> 6 as judged_by, 'd' || doc_id as digest from documents"
_PUBLISHED = "select 'f0' as family, 'v10' as version, 's1' as schema_digest union all select 'f1', 'v11', 's2'"


@query(f"""with r as ({_RECORD_ROWS}), u as ({_UNITS}), m as ({_PUBLISHED}), b as (select u.unit, r.family, case when pipeline is null or not judged_by then 'NONE' when r.unit is null then 'UNSEEN' when r.digest <> u.digest then 'CHANGED' when r.family is null then 'UNJUDGED' end as whole,
    case when datum_digest <> u.digest then 'CHANGED' when r.schema_digest is null then 'UNJUDGED' when m.schema_digest is null or m.schema_digest <> r.schema_digest then case when m.version = r.version then 'UNJUDGED' when m.version is null then 'UNLICENSED'
    when cast(substring(r.version, 2) as int) < cast(substring(m.version, 2) as int) then 'SUPERSEDED' else 'UNLICENSED' end when verdict <> 'valid' then 'INVALID' end as one from u left join r on r.unit = u.unit left join m on m.family = r.family)
    select unit, coalesce(min(whole), arg_min(one, family) filter (one is not null), 'VALID') as judgement from b group by unit""")
def unit_judgements(spark, sf_dir):
    names = {n: table(spark, sf_dir, n) for n in ("documents", "labels")}
    record = spark.sql(_RECORD_ROWS.replace("from documents", "from {documents}").replace("join labels", "join {labels}"), **names)
    units = spark.sql(_UNITS.replace("from documents", "from {documents}"), documents=names["documents"])
    return standing.judgement(units, record, spark.sql(_PUBLISHED))


_VERDICTS = "select event_type as schema, user_id as item, 'v' || (8 + event_id % 5) as version, event_id as at, case when value > 50 then 'valid' when value > 20 then 'invalid' else 'odd' end as verdict from events"


def _verdicts(spark, sf_dir):
    return spark.sql(_VERDICTS.replace("from events", "from {events}"), events=table(spark, sf_dir, "events"))


@query(f"""with v as ({_VERDICTS}), n as (select schema, arg_max(version, cast(substring(version, 2) as int)) as newest from v where schema <> 'view' group by schema), l as (select schema, item, version, arg_max(verdict, "at") as verdict from v group by all)
    select l.schema, item, version, case verdict when 'valid' then '✓' when 'invalid' then '✗' else '?' end as symbol, coalesce(version = newest, false) as is_latest from l left join n using (schema)""")
def verdict_matrix(spark, sf_dir):
    found = _verdicts(spark, sf_dir)
    return standing.matrix(found, standing.latest_versions(found.where("schema <> 'view'")))


@query(f"""with v as ({_VERDICTS}), n as (select schema, arg_max(version, cast(substring(version, 2) as int)) as version from v group by schema), i as (select distinct 'click' as schema, c_custkey as item from customer),
    a as (select schema, item, bool_or(verdict = 'valid') as ok from v join n using (schema, version) group by all), p as (select distinct schema, item from v)
    select count(*) as items, count(a.ok) as at_latest, count(*) filter (a.ok) as valid, count(p.item) as processed from i left join a using (schema, item) left join p using (schema, item)""")
def audit_totals(spark, sf_dir):
    found = _verdicts(spark, sf_dir)
    return standing.audit_totals(table(spark, sf_dir, "customer").selectExpr("'click' as schema", "c_custkey as item"), found, standing.latest_versions(found))


@query("""select l_orderkey as item, l_linenumber as schema, l_partkey as digest, l_suppkey as schema_digest from lineitem l where not (l_orderkey % 3 = 0 and l_linenumber <> 2)""")
def owed_validations(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as item", "l_linenumber as schema", "l_partkey as digest", "l_suppkey as schema_digest")
    records = items.where("item % 3 = 0").withColumn("digest", F.when(F.col("schema") == 2, F.lit(-1)).otherwise(F.col("digest")))
    return standing.owed_validations(items, records)


@query("select doc_id as unit, case when doc_id % 4 = 0 then 'unprocessed' else 'changed since its output' end as why from documents where doc_id % 4 = 0 or doc_id % 4 = 3")
def owed_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    return standing.owed(docs, docs.where("unit % 4 <> 0").withColumn("digest", F.when(F.col("unit") % 4 == 3, "old").otherwise(F.col("digest"))))


@query("""select source, count(*) filter (doc_id % 3 = 0) as valid, count(*) filter (doc_id % 3 = 1) as invalid, count(*) filter (false) as no_family from documents group by source""")
def kind_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").selectExpr("source", "case doc_id % 3 when 0 then 'valid' when 1 then 'invalid' end as judged")
    return standing.kind_counts(docs, "source", "judged", ["valid", "invalid", "no-family"])


@query("select source, lang, count(*) as n, cast(coalesce(sum(n_chars), 0) as bigint) as bytes from documents group by source, lang")
def store_census(spark, sf_dir):
    return standing.census(table(spark, sf_dir, "documents"), ["source", "lang"], "n_chars")


@query("""with f as (select event_type as stage, user_id % 40 as fault, user_id as subject, min(event_id) as pos from events group by all)
    select stage, fault, string_agg(cast(subject as varchar), ', ' order by pos, subject) as subjects, count(*) as n from f group by stage, fault""")
def fault_groups(spark, sf_dir):
    return standing.fault_groups(table(spark, sf_dir, "events").selectExpr("event_id as pos", "event_type as stage", "user_id as subject", "user_id % 40 as fault"))


@query("""with r as (select event_type as type, case when user_id % 2 = 0 then ['a', 'type', 'u'] else ['type', 'value'] end as keys from events) select type, (select count(*) from r s where s.type = t.type) as records, string_agg(k, ',' order by k) as keys
    from (select distinct type, unnest(keys) as k from r) t group by type""")
def record_survey(spark, sf_dir):
    line = "if(user_id % 2 = 0, to_json(named_struct('type', event_type, 'u', user_id, 'a', 1)), to_json(named_struct('type', event_type, 'value', value)))"
    return standing.survey(table(spark, sf_dir, "events").selectExpr(f"{line} as line"), "line", "type")


@query("""select case when user_id % 2 = 0 then 'MAY' else 'MUST' end as modality, event_type as command, 'unit ' || user_id % 7 as thing, cast(sum(event_id % 3) as bigint) as n, cast(max(event_id % 3) as bigint) as most from events group by all""")
def acts_folded(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("if(user_id % 2 = 0, 'MAY', 'MUST') as modality", "event_type as command", "'unit ' || user_id % 7 as thing", "event_id % 3 as n")
    return standing.acts(rows).join(standing.acts(rows, once=True).withColumnRenamed("n", "most"), ["modality", "command", "thing"])


@query("""with s as (select lang as kind, case doc_id % 6 when 0 then 'promotable' when 1 then 'unjudged' when 2 then 'invalid' when 3 then 'held already' when 4 then 'incomplete' else 'would lose' end as state from documents)
    select case when state in ('promotable', 'unjudged') then 'MAY' else 'MUST' end as modality, case state when 'promotable' then 'promote' when 'unjudged' then 'rehearse' when 'incomplete' then 'capture again' else 'look into' end as command,
    kind as thing, count(*) as n from s where state <> 'held already' group by all""")
def staged_acts(spark, sf_dir):
    state = "case doc_id % 6 when 0 then 'promotable' when 1 then 'unjudged' when 2 then 'invalid' when 3 then 'held already' when 4 then 'incomplete' else 'would lose' end as state"
    return standing.staged_acts(table(spark, sf_dir, "documents").selectExpr("doc_id as unit", "lang as kind", state))


@query("""with p as (select distinct 'cache/' || l_suppkey % 7 || '/' || l_partkey % 30 || '/f' || l_linenumber as path from lineitem) select path from p where not (starts_with(path, 'cache/1/') or starts_with(path, 'cache/2/5/') or path = 'cache/3/4/f1')""")
def orphan_files(spark, sf_dir):
    present = table(spark, sf_dir, "lineitem").selectExpr("'cache/' || l_suppkey % 7 || '/' || l_partkey % 30 || '/f' || l_linenumber as path").distinct()
    return standing.orphans(present, spark.createDataFrame([("cache/1",), ("cache/2/5",), ("cache/3/4/f1",), ("cac",)], "path string"))


@query("""select coalesce(d.doc_id, l.doc_id) as doc_id, case when l.doc_id is null then 'undone' else 'undeclared' end as side from (select distinct doc_id from documents where doc_id % 2 = 0) d full join (select distinct doc_id from labels) l on d.doc_id = l.doc_id
    where d.doc_id is null or l.doc_id is null""")
def declared_differences(spark, sf_dir):
    return standing.difference(table(spark, sf_dir, "documents").where("doc_id % 2 = 0"), table(spark, sf_dir, "labels"), "doc_id")


@query("""with i as (select distinct md5(cast(c_custkey as varchar)) as id from customer), t as (select distinct left(md5(cast(o_custkey as varchar)), cast(1 + o_orderkey % 6 as int)) as typed from orders union select md5('7'))
    select typed, case when count(id) = 1 then max(id) end as id from t left join i on starts_with(id, typed) group by typed""")
def prefix_resolution(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").select(F.md5(F.col("c_custkey").cast("string").cast("binary")).alias("id"))
    typed = table(spark, sf_dir, "orders").select(F.expr("left(md5(cast(cast(o_custkey as string) as binary)), int(1 + o_orderkey % 6))").alias("typed"))
    return standing.resolved(typed.union(ids.where("id = md5(cast('7' as binary))")).distinct(), ids)


_SIDES = "select event_type as side, 'w' || user_id as word, count(*) as count from events where {} group by all"


@query(f"with o as ({_SIDES.format('user_id % 5 > 0')}), n as ({_SIDES.format('user_id % 7 > 0 and event_id % 10 > 0')}) " + """select coalesce(o.side, n.side) as side, count(*) filter (o.word is null) as entered, count(*) filter (n.word is null) as "left",
    count(*) filter (o.count <> n.count) as moved from o full join n on o.side = n.side and o.word = n.word group by 1""")
def word_table_diff(spark, sf_dir):
    rows = lambda c: table(spark, sf_dir, "events").where(c).groupBy(F.col("event_type").alias("side"), F.concat(F.lit("w"), "user_id").alias("word")).agg(F.count("*").alias("count"))
    return standing.word_table_diff(rows("user_id % 5 > 0"), rows("user_id % 7 > 0 and event_id % 10 > 0"))


@query("""with o as (select s_suppkey, s_nationkey as g, cast(s_acctbal as bigint) as b from supplier where s_suppkey % 9 <> 1), n as (select s_suppkey, s_nationkey as g, cast(s_acctbal as bigint) + case when s_suppkey % 4 = 0 then 10 else 0 end as b from supplier where s_suppkey % 8 <> 2)
    select coalesce(n.g, o.g) as g, count(*) filter (o.s_suppkey is null) as added, count(*) filter (n.s_suppkey is null) as removed, count(*) filter (o.b <> n.b) as changed, cast(coalesce(sum(n.b), 0) - coalesce(sum(o.b), 0) as bigint) as b
    from o full join n on o.s_suppkey = n.s_suppkey group by 1""")
def table_diff_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_nationkey as g", "cast(rint(s_acctbal) as long) as b")
    return standing.table_diff_totals(rows.where("s_suppkey % 9 <> 1"), rows.where("s_suppkey % 8 <> 2").withColumn("b", F.expr("b + if(s_suppkey % 4 = 0, 10, 0)")), "s_suppkey", "g", ["b"])


@query("select 'n_regionkey' as \"column\", 'removed' as change union all select 'r_name', 'added'")
def columns_changed(spark, sf_dir):
    old = table(spark, sf_dir, "nation")
    return standing.columns_changed(old, old.withColumn("r_name", F.lit("x")).drop("n_regionkey"))


@query("select p_partkey, p_brand, case when p_partkey % 5 = 0 then 'missing' else 'drifted' end as state from part where p_partkey % 5 = 0 or p_partkey % 7 = 0")
def reference_drift(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.sha1(F.col("p_name").cast("binary")).alias("sha"))
    return standing.reference_drift(rows, rows.where("p_partkey % 5 <> 0").withColumn("sha", F.when(F.col("p_partkey") % 7 == 0, "new").otherwise(F.col("sha"))), ["p_partkey", "p_brand"])


@query("""select n_name, case when n_nationkey % 6 = 2 then 'look at ' || n_name when n_nationkey % 4 = 1 then 'set ' || n_name || ' to ' || n_regionkey end as remedy from nation""")
def settings_remedies(spark, sf_dir):
    state = F.expr("case when n_nationkey % 6 = 2 then 'UNVERIFIED' when n_nationkey % 4 = 1 then 'DRIFT' else 'OK' end")
    return table(spark, sf_dir, "nation").select("n_name", standing.remedy(state, F.col("n_name"), F.col("n_regionkey")).alias("remedy"))


# Functions on text.
@query("""select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso, strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when event_id % 3 = 0 then '.5' else 'Z' end as trimmed,
    case event_id % 4 when 0 then null when 1 then to_timestamp(1700000000 + event_id)::timestamp else date_trunc('second', ts) end as instant from events""")
def stamps(spark, sf_dir):
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    name = F.expr("case event_id % 4 when 0 then 'data-x' when 1 then 'data-' || (1700000000 + event_id) || '-ab12cd34' when 2 then date_format(ts, 'yyyy-MM-dd-HH-mm-ss') else 'data-' || date_format(ts, 'yyyy-MM-dd-HH-mm-ss') || '-1700000000' end")
    df = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("name", name)
    stamp = F.concat(at, F.expr("case when event_id % 3 = 0 then '.5' when event_id % 3 = 1 then 'Z' else '.123Z' end"))
    return df.select("event_id", tx.iso(F.col("ts")).alias("iso"), tx.trimmed_instant(stamp).alias("trimmed"), tx.export_instant(F.col("name")).cast("timestamp_ntz").alias("instant"))


@query("""select doc_id, left(sha256(coalesce(text, '')), 16) as fp, regexp_replace(lang || '/' || source || ' é_' || doc_id, '[^\\p{L}\\p{N}]', '-', 'g') as key, case when doc_id % 3 = 0 then -1 else doc_id end as version, n_chars || ' (was ' || doc_id || ')' as change,
    case when doc_id % 4 < 2 then 'mac-' || doc_id end as machine, case when doc_id % 4 = 1 then lang end as provider from documents""")
def text_keys(spark, sf_dir):
    line = F.expr("case doc_id % 4 when 0 then 'Signature: mac-' || doc_id when 1 then 'Signature: mac-' || doc_id || '/' || lang || '/ab12cd34  ' when 2 then ' Signature: mac' else 'Signature: <mac>/x/y' end")
    sign = tx.signature(F.col("line"))
    df = table(spark, sf_dir, "documents").withColumn("line", line)
    return df.select("doc_id", tx.fingerprint(F.coalesce("text", F.lit(""))).alias("fp"), tx.project_key(F.expr("lang || '/' || source || ' é_' || doc_id")).alias("key"), tx.version_number(F.expr("if(doc_id % 3 = 0, 'none', 'v' || doc_id || '.2')")).alias("version"),
                     tx.was(F.col("n_chars"), F.col("doc_id")).alias("change"), sign["machine"].alias("machine"), sign["provider"].alias("provider"))


@query("""with a as (select conv_id, list(role order by turn) as a, list(case when turn = conv_id % 5 then 'x' else role end order by turn) as b from conversations group by conv_id)
    select conv_id, case when conv_id % 7 = 3 then null when conv_id % 5 < len(a) then conv_id % 5 end::int as place from a""")
def divergences(spark, sf_dir):
    ordered = lambda c: F.sort_array(F.collect_list(F.struct("turn", F.expr(c).alias("r"))))["r"]
    said = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(ordered("role").alias("a"), ordered("if(turn = conv_id % 5 and conv_id % 7 <> 3, 'x', role)").alias("b"))
    return said.select("conv_id", tx.divergence(F.col("a"), F.col("b")).alias("place"))
