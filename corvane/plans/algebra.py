"""Registered queries of schemas and definitions beside their SQL twins. Parts are told as small schemas, events as the documents they judge."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from corvane.operators import definitions, nodes, schemas, validation
from corvane.plans.catalog import query
from corvane.plans.structure import draft_moves, event_documents, event_tree
from corvane.session import table, weighed


def _told(spark, sf_dir, text):
    return weighed(nodes.nodes(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc"), F.expr(text).alias("text"))))


_SCHEMA = """'{"title":"t","properties":{"title":{"type":"string","description":"d' || p_partkey || '","enum":["' || p_brand || '"]},"id":{"anyOf":[{"$ref":"#/definitions/d"},{"items":{"default":{"properties":{"q":{}}},"minimum":' || p_size || '}}]}},"definitions":{"d":{"id":"z","not":{"maximum":' || (p_size % 5) || '}}},"default":{"properties":{"w":{"title":"t"}}},"dependencies":{"title":["id"],"id":{"title":"x"}}}'"""
_NODES = f"""n as (select doc, replace(replace(replace(substr(replace(t.fullkey, '"', ''), 2), '.', '/'), '[', '/'), ']', '') as pointer, lower(t.type) as kind, t.value ->> '$' as raw from (select p_partkey as doc, {_SCHEMA} as text from part) d, json_tree(d.text::json) t)"""
#: Schemas stand where this matches a pointer: the language of the grammar's paths.
_AT = "((/(properties|patternProperties|definitions|dependencies)/[^/]+)|(/(items|not|additionalProperties|additionalItems))|(/(allOf|anyOf|oneOf|items)/[0-9]+))*"


@query(f"""with {_NODES} select doc, pointer, case when kind = 'object' and regexp_full_match(pointer, '{_AT}') then 'schema' when kind = 'object' and regexp_full_match(pointer, '{_AT}/(properties|patternProperties|definitions|dependencies)') then 'map'
    when kind = 'array' and regexp_full_match(pointer, '{_AT}/(allOf|anyOf|oneOf|items)') then 'list' else 'value' end as position from n""")
def schema_positions(spark, sf_dir):
    return schemas.positions(_told(spark, sf_dir, _SCHEMA), draft_moves(spark)).select("doc", "pointer", "position")


@query(f"with {_NODES} select doc, pointer, case when kind not in ('object', 'array') then raw end as value from n where not regexp_matches(pointer, '^{_AT}/(title|description|default|id|[$]schema)(/|$)') or regexp_full_match(pointer, '{_AT}')")
def schema_restrictions(spark, sf_dir):
    placed = schemas.positions(_told(spark, sf_dir, _SCHEMA), draft_moves(spark))
    return schemas.restrictions(placed).select("doc", "pointer", "value")


@query("""select event_id as doc, '{"props":{"k":' || (props ->> '$.k') || '}' || case when event_id % 7 = 0 then '' else ',"stop":' || (event_id % 3) end || ',"tags":["' || event_type || '",' || (event_id % 5) || ',null,{"$ref":"#/definitions/' || event_type || '"}],"title":"t' || event_id || '","type":"' || event_type || '","user":' || user_id || '}' as json
    from events where event_id % 11 <> 0""")
def documents_canonical(spark, sf_dir):
    return schemas.canonical(event_tree(spark, sf_dir))


_UNION = {
    "type": "object", "required": ["type"],
    "oneOf": [{"properties": {"type": {"enum": ["click"]}, "stop": {"enum": [0, 1]}}, "required": ["stop"]}, {"properties": {"type": {"enum": ["view"]}, "user": {"maximum": 100}}}, {"$ref": "#/definitions/purchase"}],
    "definitions": {"purchase": {"properties": {"type": {"enum": ["purchase"]}, "props": {"properties": {"k": {"minimum": 50}}}}}},
}
_JUDGED = """j as (select event_id as doc, event_id, event_type as t, user_id as u, cast(props ->> '$.k' as int) as k, case when event_id % 7 <> 0 then event_id % 3 end as stop from events),
    v as (select *, case when event_id % 11 = 0 then 'broken' when t = 'click' and stop is null then 'stop' when t in ('click', 'signup', 'error') and stop = 2 then 'none' when t = 'view' and u > 100 then 'user' when t = 'purchase' and k < 50 then 'k' when t in ('signup', 'error') then 'type' end as f from j)"""


def _judged(spark, sf_dir):
    asked = event_documents(spark, sf_dir, nodes.TASKS_A_CORE * spark.sparkContext.defaultParallelism).select("doc", F.lit("union").alias("schema"), "text")
    rules = nodes.nodes(spark.createDataFrame([("union", json.dumps(_UNION))], "doc string, text string"))
    return rules, validation.judged(asked, rules)


@query(f"""with {_JUDGED} select doc, f is null as valid, case f when 'stop' then '' when 'none' then '' when 'user' then '/user' when 'k' then '/props/k' when 'type' then '/type' end as pointer,
    case f when 'stop' then 'required' when 'user' then 'maximum' when 'k' then 'minimum' end as keyword, case f when 'stop' then '/oneOf/0' when 'user' then '/oneOf/1/properties/user' when 'k' then '/definitions/purchase/properties/props/properties/k' when 'none' then '' when 'type' then '' end as schema_pointer,
    case f when 'broken' then 'no JSON' when 'stop' then '''stop'' is a required property' when 'none' then 'matches none of: alternative, alternative, purchase' when 'user' then u || ' is greater than the maximum of 100'
      when 'k' then k || ' is less than the minimum of 50' when 'type' then '''' || t || ''' is not a type the union declares - declared: [''click'', ''purchase'', ''view'']' end as said from v""")
def documents_validated(spark, sf_dir):
    return _judged(spark, sf_dir)[1].drop("schema", "text")


@query(f"""with {_JUDGED} select doc, case f when 'user' then '/user' when 'k' then '/props/k' end as pointer, case f when 'user' then cast(u as varchar) else cast(k as varchar) end as held, case f when 'user' then '{{"maximum":100}}' else '{{"minimum":50}}' end as fragment, 0 as others
    from v where f in ('user', 'k')""")
def failures_inspected(spark, sf_dir):
    rules, found = _judged(spark, sf_dir)
    shown = definitions.inspected_texts(found.where("keyword in ('maximum', 'minimum')"), rules)
    return shown.select("doc", "pointer", "held", "fragment", F.size("others").alias("others"))


_CHAIN = """'{"properties":{"s":{"$ref":"#/definitions/d0"}},"definitions":{' || array_join(transform(sequence(0, cast(p_size % 4 as int)), i -> '"d' || i || '":{"properties":{"n":{"items":{"$ref":"#/definitions/d' || ((i + 1) % (p_size % 4 + 1)) || '"}}}}'), ',') || '}}'"""


@query("select p_partkey as schema, '/definitions/d' || i as target, '/s' || repeat('/n/*', i::int) as pattern, 1 as n from (select p_partkey, unnest(range(0, p_size % 4 + 1)) as i from part)")
def definition_patterns(spark, sf_dir):
    tree = _told(spark, sf_dir, _CHAIN)
    asked = tree.where("parent = '/definitions'").select(F.col("doc").alias("schema"), F.col("pointer").alias("target"))
    return definitions.patterns(tree, asked).drop("within")


@query("select p_partkey as schema, 'd' || i as name, '/s' || repeat('/n/0', i::int) as path from (select p_partkey, unnest(range(0, p_size % 4 + 1)) as i from part)")
def definition_first_paths(spark, sf_dir):
    return definitions.first_paths(_told(spark, sf_dir, _CHAIN))


_FOUR = """'{"definitions":{"a":{"type":"object","properties":{"x":{"$ref":"#/definitions/b"}}},"b":{"enum":["' || p_brand || '",1]},"c":{"minimum":' || p_size || '},"e":{"$ref":"#/definitions/c"}' || case when p_partkey % 2 = 0 then ',"f":{}' else '' end || '}}'"""


@query("""with p as (select a.p_partkey as mine, b.p_partkey as witness, a.p_brand <> b.p_brand as brand, a.p_size <> b.p_size as size from part a join part b on b.p_partkey = a.p_partkey + 1)
    select mine, witness, unnest(['a', 'b']) as name, false as absent from p where brand union all select mine, witness, unnest(['c', 'e']), false from p where size union all select mine, witness, 'f', true from p where mine % 2 = 1""")
def definition_disagreements(spark, sf_dir):
    tree = _told(spark, sf_dir, _FOUR)
    pairs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("mine"), (F.col("p_partkey") + 1).alias("witness"))
    return definitions.disagreements(definitions.colours(tree), pairs)


_PARTS = """'{"definitions":{"whole":{"allOf":[{"$ref":"#/definitions/base"},{"$ref":"#/definitions/size"}],"required":["s"]},"base":{"type":"object","required":["a"],"properties":{"a":{"type":"string"}}},"size":{"properties":{"s":{"enum":[' || p_size || ']},"a":{"type":"' || case when p_partkey % 3 = 0 then 'null' else 'string' end || '"}}}}}'"""


@query("""select p_partkey as schema, pointer, case pointer when '/properties/s/enum' then '[' || p_size || ']' else json end as json, case when pointer = '/properties/a/type' and p_partkey % 3 = 0 then '"null"' end as conflict
    from part, (values ('', null), ('/type', '"object"'), ('/required', '["a","s"]'), ('/properties', null), ('/properties/a', null), ('/properties/a/type', '"string"'), ('/properties/s', null), ('/properties/s/enum', '')) as v(pointer, json)""")
def definitions_flattened(spark, sf_dir):
    return definitions.flattened(_told(spark, sf_dir, _PARTS)).where("name = 'whole'").drop("name")


@query("""with recursive s as (select p_partkey as name, case when p_partkey % 97 = 1 then 'message' when p_partkey % 89 = 2 then 'result' end as kind from part),
    w as (select p_partkey as name, p_partkey as place from part union all select name, place // 2 from w where place % 5 <> 3 and place > 0),
    d as (select w.name, min(kind) as kind from w join s on s.name = w.place where kind is not null group by w.name),
    a as (select p_partkey as name, p_partkey as place from part union all select a.name, place // 3 from a left join d on d.name = a.place where place % 5 = 3 and d.kind is null), e as (select name, min(place) as place from a group by name)
    select e.name, coalesce(d.kind, '') as kind from e left join d on d.name = e.place""")
def definition_kinds(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("name"))
    seeds = parts.where("name % 97 = 1").selectExpr("name", "'message' as kind", "0 as rank").union(parts.where("name % 97 <> 1 and name % 89 = 2").selectExpr("name", "'result'", "1"))
    bases = parts.where("name % 5 <> 3 and name > 0").selectExpr("name", "name div 2 as base")
    return definitions.classified(parts, bases, seeds, parts.where("name % 5 = 3").selectExpr("name", "name div 3 as member"))
