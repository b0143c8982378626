"""Registered queries of node tables, rules and reference walks beside their SQL twins. Each event is told as a small JSON document."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import nodes, schemas, units
from corvane.plans.catalog import query
from corvane.session import table, weighed

_TEXT = """'{"type":"' || event_type || '","user":' || user_id || ',"props":' || props || ',"title":"t' || event_id || '","tags":["' || event_type || '",' || (event_id % 5) || ',null,{"$ref":"#/definitions/' || event_type || '"}]' || case when event_id % 7 = 0 then '' else ',"stop":' || (event_id % 3) end || case when event_id % 11 = 0 then '' else '}' end"""
_TREE = f"""docs as (select event_id as doc, {_TEXT} as text from events), tree as (select doc, replace(replace(replace(substr(replace(t.fullkey, '"', ''), 2), '.', '/'), '[', '/'), ']', '') as pointer,
    replace(replace(regexp_replace(substr(replace(t.fullkey, '"', ''), 2), '\\[[0-9]+\\]', '/*', 'g'), '.', '/'), '[', '/') as pattern,
    case t.type when 'VARCHAR' then 'string' when 'UBIGINT' then 'integer' when 'BIGINT' then 'integer' when 'DOUBLE' then 'number' else lower(t.type) end as kind, t.value ->> '$' as raw, t.key as step
    from (select * from docs where json_valid(text)) d, json_tree(d.text::json) t), nodes as (select doc, pointer, pattern, kind, step, case when kind not in ('object', 'array', 'null') then raw end as value from tree)"""


def event_documents(spark, sf_dir, tasks=None):
    """The events' documents; dealt out to that many tasks before they are told, as a table of one row group is one task."""
    events = table(spark, sf_dir, "events")
    if tasks:
        events = events.select("event_id", "event_type", "user_id", "props").repartition(tasks, "event_id")
    return events.select(F.col("event_id").alias("doc"), F.expr(_TEXT).alias("text"))


def draft_moves(spark):
    """The grammar of draft-04 schemas."""
    return schemas.grammar(nodes.nodes(spark.createDataFrame([("meta", schemas.META_SCHEMA)], "doc string, text string")))


def event_tree(spark, sf_dir):
    return nodes.nodes(event_documents(spark, sf_dir))


@query(f"with {_TREE} select doc, pointer, pattern, kind, value from nodes")
def json_nodes(spark, sf_dir):
    return event_tree(spark, sf_dir).select("doc", "pointer", "pattern", "kind", "value")


@query(f"with {_TREE} select doc, pointer, value from nodes where kind = 'string'")
def json_strings(spark, sf_dir):
    return nodes.strings(event_tree(spark, sf_dir))


@query(f"with {_TREE} select d.doc, a.pointer, n.kind from (select doc, unnest(['/props/k', '/tags/2', '/tags/9', '/stop', '']) as pointer from docs) a join docs d using (doc) left join nodes n on n.doc = d.doc and n.pointer = a.pointer")
def pointers_resolved(spark, sf_dir):
    asked = event_documents(spark, sf_dir).select("doc", F.explode(F.expr("array('/props/k', '/tags/2', '/tags/9', '/stop', '')")).alias("pointer"))
    return nodes.resolved(event_tree(spark, sf_dir), asked)


@query(f"with {_TREE} select pattern, doc, pointer from nodes where pattern in ('/tags/*', '/props/k', '/none')")
def pattern_places(spark, sf_dir):
    return nodes.at_patterns(event_tree(spark, sf_dir), spark.sql("select explode(array('/tags/*', '/props/k', '/none')) as pattern"))


@query(f"with {_TREE}, r as (select *, row_number() over (partition by pattern order by doc, pointer) as k from nodes where value is not null and pattern in ('/tags/*', '/stop', '/none')) select pattern, doc, value from r where k = 1")
def claims_falsified(spark, sf_dir):
    return nodes.falsified(event_tree(spark, sf_dir), spark.sql("select explode(array('/tags/*', '/stop', '/none')) as pattern"))


@query(f"with {_TREE} select doc, sha256(string_agg(pointer || '=' || kind || coalesce('=' || value, ''), chr(10) order by pointer || '=' || kind || coalesce('=' || value, ''))) as digest from nodes where pointer <> '/title' group by doc")
def restriction_digests(spark, sf_dir):
    return schemas.restriction_digests(event_tree(spark, sf_dir), draft_moves(spark))


@query(f"with {_TREE}, k as (select * from nodes where pointer <> '/title') select a.doc as base, a.doc + 1 as refined, a.pointer from k a join docs on docs.doc = a.doc + 1 left join k b on b.doc = a.doc + 1 and b.pointer = a.pointer and b.kind = a.kind and coalesce(b.value, '') = coalesce(a.value, '') where b.doc is null")
def restrictions_changed(spark, sf_dir):
    docs = event_documents(spark, sf_dir)
    pairs = docs.select((F.col("doc") - 1).alias("base"), F.col("doc").alias("refined"))
    return schemas.unrefined(event_tree(spark, sf_dir), pairs, draft_moves(spark))


@query(f"with {_TREE} select value as target, left(pattern, length(pattern) - 5) as pattern, count(*) as n from nodes where step = '$ref' group by all")
def definition_references(spark, sf_dir):
    return nodes.references(event_tree(spark, sf_dir))


_RULES = """select col1 as pattern, col2 as rule, col3 as arg from (select inline(array(struct('/type', 'union', array('click', 'purchase', 'signup')), struct('/stop', 'enum', array('0', '2')), struct('/user', 'type', array('string')),
    struct('/props/k', 'maximum', array('90')), struct('', 'required', array('type', 'stop')), struct('/props', 'closed', array('j')))))"""
_FAULTS = """found as (select doc, pointer, 'union' as rule, '''' || value || ''' is not a type the union declares: click, purchase, signup' as said from nodes where pointer = '/type' and value not in ('click', 'purchase', 'signup')
    union all select doc, pointer, 'enum', value || ' is not one of 0, 2' from nodes where pointer = '/stop' and value not in ('0', '2')
    union all select doc, pointer, 'type', value || ' is not of type string' from nodes where pointer = '/user' and kind <> 'string'
    union all select doc, pointer, 'maximum', value || ' is more than the maximum of 90' from nodes where pointer = '/props/k' and cast(value as double) > 90
    union all select doc, '', 'required', '''stop'' is a required property' from nodes where pointer = '' and doc not in (select doc from nodes where pointer = '/stop')
    union all select doc, '/props', 'closed', '''k'' was unexpected' from nodes where pointer = '/props/k')"""


def _rules(spark):
    return spark.sql(_RULES)


@query(f"with {_TREE}, {_FAULTS} select doc, pointer, rule, said from found")
def rule_faults(spark, sf_dir):
    return nodes.faults(weighed(event_tree(spark, sf_dir)), _rules(spark))


@query(f"with {_TREE}, {_FAULTS}, r as (select *, row_number() over (partition by doc order by case when rule = 'union' then 0 else 1 end, pointer, rule, said) as k from found) select doc, json_valid(text) and said is null as valid, pointer, case when json_valid(text) then said else 'no JSON' end as said from docs left join (select * from r where k = 1) using (doc)")
def document_verdicts(spark, sf_dir):
    docs, tree = event_documents(spark, sf_dir), weighed(event_tree(spark, sf_dir))
    return nodes.verdicts(docs, tree, nodes.faults(tree, _rules(spark)))


@query("""with recursive n as (select count(*) as n from part), e as (select p_partkey as source, unnest([p_partkey * 2, p_partkey * 2 + 1, p_partkey // 2]) as target from part where p_partkey % 10 <> 7), r as (select 3::bigint as node, 0 as depth union select e.target, depth + 1 from r join e on e.source = r.node where e.target between 1 and (select n from n) and depth < 30)
    select node, min(depth) as depth from r group by node""")
def definitions_reached(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    n = parts.count()
    edges = parts.where("p_partkey % 10 <> 7").select(F.col("p_partkey").alias("source"), F.explode(F.expr("array(p_partkey * 2, p_partkey * 2 + 1, p_partkey div 2)")).alias("target"))
    return nodes.reached(edges.where(F.col("target").between(1, n)), spark.range(3, 4).toDF("node"))


@query("""with recursive r as (select p_partkey as node, p_partkey as place, 0 as d from part union all select node, place // 2, d + 1 from r where place > 1 and place % 9 <> 4), s as (select node, max_by(place, d) as top from r group by node) select node, case when top % 9 = 4 then 'layer ' || top end as layer from s""")
def layer_of_nearest(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"))
    parents = parts.select("node", F.expr("case when node > 1 then node div 2 end").alias("up"))
    return nodes.nearest(parents, parts.where("node % 9 = 4").select("node", F.concat(F.lit("layer "), "node").alias("layer")))


_FILES = """select 'store/' || o_orderpriority || '/' || o_orderstatus || '/' || (o_orderkey % 50) || '/f' || o_orderkey || '.json' as path from orders where o_orderkey % 9 <> 0 union all select 'loose/' || o_orderkey from orders where o_orderkey % 9 = 0"""


def _listing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stored = orders.where("o_orderkey % 9 <> 0").selectExpr("'store/' || o_orderpriority || '/' || o_orderstatus || '/' || (o_orderkey % 50) || '/f' || o_orderkey || '.json' as path")
    return stored.union(orders.where("o_orderkey % 9 = 0").selectExpr("'loose/' || o_orderkey as path"))


def _stores(spark, sf_dir):
    selections = spark.sql("select 'logs' as name, 'store/<provider>' as template, 2 as depth union all select 'odd', 'nowhere', 1")
    providers = table(spark, sf_dir, "orders").selectExpr("'logs' as name", "o_orderpriority as provider").where("provider <> '5-LOW'").distinct()
    return units.declared(selections, providers)


_UNITS = f"""f as ({_FILES}), d as (select 'logs' as name, split_part(path, '/', 2) as provider, regexp_extract(path, '^[^/]+/[^/]+/[^/]+/[^/]+') as address, count(distinct path) as files from f where path like 'store/%' and path not like 'store/5-LOW/%' group by all)"""


@query("select distinct 'logs' as name, o_orderpriority as provider, 'store/' || o_orderpriority as folder, 2 as depth from orders where o_orderpriority <> '5-LOW' union all select 'odd', null, 'nowhere', 1")
def stores_declared(spark, sf_dir):
    return _stores(spark, sf_dir)


@query(f"with {_UNITS} select * from d")
def units_scanned(spark, sf_dir):
    return units.scanned(_listing(spark, sf_dir), _stores(spark, sf_dir))


@query(f"with {_UNITS} select *, 'declared' as measure from d union all select distinct null, null, path, 1, 'prefix' from f where path like 'loose/%' or path like 'store/5-LOW/%'")
def units_all(spark, sf_dir):
    return units.all_units(_listing(spark, sf_dir), _stores(spark, sf_dir))


@query("""with m as (select distinct l_orderkey as unit, l_returnflag as category from lineitem), k as (select * from (values ('A', 'a.json'), ('A', 'index.json'), ('N', 'n.json')) as v(category, member)), h as (select l_orderkey as unit, unnest(['index.json', case when l_quantity > 25 then 'n.json' end]) as member from lineitem)
    select distinct unit, coalesce(member, 'unknown category ' || category) as lacking from m left join k using (category) where not exists (select 1 from h where h.unit = m.unit and h.member = coalesce(k.member, 'unknown category ' || m.category))""")
def parts_missing(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    members = spark.sql("select inline(array(named_struct('category', 'A', 'member', 'a.json'), named_struct('category', 'A', 'member', 'index.json'), named_struct('category', 'N', 'member', 'n.json')))")
    held = items.select(F.col("l_orderkey").alias("unit"), F.explode(F.expr("array('index.json', case when l_quantity > 25 then 'n.json' end)")).alias("member"))
    return units.missing_parts(items.selectExpr("l_orderkey as unit", "l_returnflag as category"), members, held)
