"""Schemas as node tables: what each node is by the grammar of a meta-schema, restrictions, canonical text, equality of subtrees.

A meta-schema is read as a tree automaton. Its states are its own nodes; a value that a state describes moves, by one step, to the
state that describes what stands there. So a node is a schema because the meta-schema says so, and a property that is named like
a keyword is a name. Tables of transitions are as long as the meta-schema; documents are walked by joins, a level at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.session import weighed

#: Keywords that say something and restrict nothing. Those that hold schemas are walked and kept.
ANNOTATIONS = ("default", "definitions", "description", "title", "id", "$id", "$schema")

#: The draft-04 meta-schema, as far as it tells where schemas stand (a fixed value of that standard).
META_SCHEMA = """{"definitions": {"schemaArray": {"type": "array", "items": {"$ref": "#"}}, "stringArray": {"type": "array", "items": {"type": "string"}}},
"type": "object", "properties": {"id": {}, "$schema": {}, "title": {}, "description": {}, "default": {}, "multipleOf": {}, "maximum": {}, "exclusiveMaximum": {}, "minimum": {},
"exclusiveMinimum": {}, "maxLength": {}, "minLength": {}, "pattern": {}, "additionalItems": {"anyOf": [{"type": "boolean"}, {"$ref": "#"}]},
"items": {"anyOf": [{"$ref": "#"}, {"$ref": "#/definitions/schemaArray"}]}, "maxItems": {}, "minItems": {}, "uniqueItems": {}, "maxProperties": {}, "minProperties": {},
"required": {"$ref": "#/definitions/stringArray"}, "additionalProperties": {"anyOf": [{"type": "boolean"}, {"$ref": "#"}]},
"definitions": {"type": "object", "additionalProperties": {"$ref": "#"}}, "properties": {"type": "object", "additionalProperties": {"$ref": "#"}},
"patternProperties": {"type": "object", "additionalProperties": {"$ref": "#"}},
"dependencies": {"type": "object", "additionalProperties": {"anyOf": [{"$ref": "#"}, {"$ref": "#/definitions/stringArray"}]}},
"enum": {}, "type": {}, "format": {}, "allOf": {"$ref": "#/definitions/schemaArray"}, "anyOf": {"$ref": "#/definitions/schemaArray"},
"oneOf": {"$ref": "#/definitions/schemaArray"}, "not": {"$ref": "#"}}}"""


def depth(pointer: str = "pointer") -> Column:
    """Steps of a pointer."""
    return F.length(pointer) - F.length(F.replace(pointer, F.lit("/"), F.lit("")))


def grammar(meta: DataFrame) -> DataFrame:
    """The node table of one meta-schema -> state, within (object or array), step (null: any other), next, schema: where a value moves, and whether ``next`` may be a schema.

    Alternatives of a state (references and unions, followed to a fixpoint) move as it does; the kind of the value tells them apart.
    """
    meta = weighed(meta)
    to = meta.where("step = '$ref' and kind = 'string' and value like '#%'").select(F.col("parent").alias("source"), F.expr("substr(value, 2)").alias("target"))
    union = meta.where(F.element_at(F.split("parent", "/"), -1).isin("anyOf", "oneOf", "allOf")).select(F.expr("left(parent, length(parent) - 6)").alias("source"), F.col("pointer").alias("target"))
    links = weighed(to.union(union).distinct())
    means = weighed(meta.select(F.col("pointer").alias("state"), F.col("pointer").alias("is")).distinct())
    while True:
        more = means.join(links, means["is"] == links.source).select("state", F.col("target").alias("is")).distinct().join(means, ["state", "is"], "left_anti")
        more = weighed(more)
        if more.isEmpty():
            break
        means = weighed(means.union(more))
    named = meta.where("parent like '%/properties'").select(F.expr("left(parent, length(parent) - 11)").alias("is"), F.lit("object").alias("within"), "step", F.col("pointer").alias("next"))
    other = meta.where("step in ('additionalProperties', 'items') and kind = 'object'").select(F.col("parent").alias("is"), F.when(F.col("step") == "items", "array").otherwise("object").alias("within"), F.lit(None).cast("string").alias("step"), F.col("pointer").alias("next"))
    schemas = means.where(F.col("is") == "").select(F.col("state").alias("next"), F.lit(True).alias("schema"))
    moves = means.join(named.union(other), "is").select("state", "within", "step", "next").distinct()
    return weighed(moves.join(schemas, "next", "left").select("state", "within", "step", "next", F.coalesce("schema", F.lit(False)).alias("schema")))


def positions(tree: DataFrame, moves: DataFrame) -> DataFrame:
    """tree of documents that are schemas, and a grammar -> tree plus position: schema, map or list (of schemas), else value.

    Where a node stands follows from its steps and the kinds on the way alone, so each shape (pointer, within, kind) is placed once,
    however many documents hold it. Each level of nesting is one join of (state, step) with the table of moves, until no state is
    left, so plain values are never walked. An empty table gives no rows.
    """
    tree = weighed(tree)
    return _by_shape(tree, _placed(tree, moves)).withColumn("position", F.coalesce("position", F.lit("value")))


def _by_shape(tree: DataFrame, known: DataFrame, how: str = "left") -> DataFrame:
    """tree with what is known of the shapes (p, w, k) of its nodes."""
    return tree.join(weighed(known), (tree.pointer == F.col("p")) & (tree.within == F.col("w")) & (tree.kind == F.col("k")), how).drop("p", "w", "k")


def _placed(tree: DataFrame, moves: DataFrame) -> DataFrame:
    """p, w, k, position: the shapes that a state describes."""
    moves = moves.select("state", F.col("within").alias("in_"), F.col("step").alias("by"), "next", "schema")
    holds = moves.where("by is null and schema").select("state", F.col("in_").alias("kind"), F.lit(True).alias("holds")).distinct()
    shapes = weighed(tree.select("pointer", "parent", "step", "within", "kind").distinct().withColumn("depth", depth()))
    level = shapes.where("pointer = ''").select("pointer", "within", "kind", F.lit("").alias("state"), F.lit(True).alias("schema"))
    found, at = [], 0
    while True:
        level = weighed(level.join(F.broadcast(holds), ["state", "kind"], "left"))
        if level.isEmpty():
            break
        called = F.when(F.expr("schema and kind = 'object'"), "schema").when(F.expr("holds and kind = 'object'"), "map").when(F.expr("holds and kind = 'array'"), "list")
        found.append(level.select(F.col("pointer").alias("p"), F.col("within").alias("w"), F.col("kind").alias("k"), called.alias("position")).where("position is not null"))
        at += 1
        over = level.select(F.col("pointer").alias("over"), F.concat("within", F.when(F.col("kind") == "object", "o").otherwise("a")).alias("over_within"), F.col("kind").alias("over_kind"), "state")
        pairs = shapes.where(F.col("depth") == at).join(over, (F.col("parent") == F.col("over")) & (F.col("within") == F.col("over_within"))).select("pointer", "within", "step", "kind", "state", "over_kind")
        by_name = pairs.join(F.broadcast(moves), (pairs.state == moves.state) & (pairs.over_kind == moves.in_) & moves.by.eqNullSafe(pairs.step), "left").select(pairs["*"], "next", "schema")
        rest = moves.where("by is null").select(F.col("state").alias("s"), F.col("in_").alias("w"), F.col("next").alias("other"), F.col("schema").alias("other_schema"))
        moved = by_name.join(F.broadcast(rest), (by_name.state == rest.s) & (by_name.over_kind == rest.w), "left")
        level = moved.select("pointer", "within", "kind", F.coalesce("next", "other").alias("state"), F.expr("case when next is null then other_schema else schema end").alias("schema"))
        # several moves may be open to a value; it is a schema if one of them says so
        level = level.where("state is not null").groupBy("pointer", "within", "kind").agg(F.max(F.struct("schema", "state")).alias("m")).select("pointer", "within", "kind", "m.state", "m.schema")
    if not found:
        return level.select(F.col("pointer").alias("p"), F.col("within").alias("w"), F.col("kind").alias("k"), F.lit("value").alias("position"))
    return reduce(DataFrame.union, found)


def restrictions(placed: DataFrame, annotations: tuple[str, ...] = ANNOTATIONS) -> DataFrame:
    """positions -> the nodes that restrict: no keyword that only says something, at any schema, and nothing below it.

    A property that is named like a keyword stays, and so does an annotation that holds schemas. Judged by shapes, as ``positions``.
    """
    shapes = weighed(placed.select("pointer", "parent", "step", "within", "kind", "position").distinct())
    schemas = shapes.where("position = 'schema'").select(F.col("pointer").alias("p"), F.concat("within", F.lit("o")).alias("w"))
    said = shapes.where(F.col("step").isin(*annotations) & (F.col("position") == "value"))
    level = weighed(said.join(schemas, (said.parent == schemas.p) & (said.within == schemas.w), "left_semi").select("pointer", "within", "kind"))
    gone = [level]
    while not level.where("kind in ('object', 'array')").isEmpty():
        over = level.select(F.col("pointer").alias("p"), F.concat("within", F.when(F.col("kind") == "object", "o").otherwise("a")).alias("w"))
        level = weighed(shapes.join(over, (shapes.parent == F.col("p")) & (shapes.within == F.col("w"))).select("pointer", "within", "kind"))
        gone.append(level)
    gone = reduce(DataFrame.union, gone).select(F.col("pointer").alias("p"), F.col("within").alias("w"), F.col("kind").alias("k"))
    return _by_shape(placed, gone, "left_anti")


def restriction_digests(tree: DataFrame, moves: DataFrame) -> DataFrame:
    """doc, digest: of the nodes that restrict, in the order of their pointers; equal for documents that restrict alike. The list that is sorted is as long as one document."""
    lines = F.array_sort(F.collect_list(F.concat_ws("=", "pointer", "kind", "value")))
    return restrictions(positions(tree, moves)).groupBy("doc").agg(F.sha2(F.array_join(lines, "\n"), 256).alias("digest"))


def unrefined(tree: DataFrame, pairs: DataFrame, moves: DataFrame) -> DataFrame:
    """pairs(base, refined) of documents -> base, refined, pointer: restrictions of the base that the other lacks or changes."""
    kept = weighed(restrictions(positions(tree, moves)).select("doc", "pointer", "kind", F.coalesce("value", F.lit("")).alias("value")))
    owed = weighed(pairs).join(kept.withColumnRenamed("doc", "base"), "base")
    return owed.join(kept.withColumnRenamed("doc", "refined"), ["refined", "pointer", "kind", "value"], "left_anti").select("base", "refined", "pointer")


_ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"} | {chr(i): f"\\u{i:04x}" for i in range(32) if chr(i) not in "\n\r\t\b\f"}


def quoted(text: Column) -> Column:
    """A JSON string as ``json.dumps`` writes it without escaping what is not ASCII."""
    plain = F.concat(F.lit('"'), text, F.lit('"'))
    escaped = reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), _ESCAPES.items(), text)
    return F.when(text.rlike(r'["\\\x00-\x1f]'), F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(plain)


def canonical(tree: DataFrame) -> DataFrame:
    """tree -> doc, json: each document written with sorted keys and no spaces, the inverse of ``nodes``.

    A document's nodes are put in the order of their paths, which is that of the text; each writes itself and closes what the next one
    is not in. One shuffle of nodes; a document's text is one value in any case.
    """
    return _written(tree, F.collect_list(_part("path")))


def texts(tree: DataFrame) -> DataFrame:
    """As ``canonical``, keys in the order in which the document has them. Repeated rows count once."""
    return _written(tree, F.collect_set(_part("place", "path")))


def _part(*order: str) -> Column:
    """What a node says of itself, behind the columns that order the nodes."""
    opened = F.when(F.col("kind") == "object", "{").when(F.col("kind") == "array", "[").when(F.col("kind") == "string", quoted(F.col("value"))).when(F.col("kind") == "null", "null").otherwise(F.col("value"))
    named = F.when(F.right("within", F.lit(1)) == "o", F.concat(quoted(F.element_at("path", -1)), F.lit(":"), opened)).otherwise(opened)
    around = F.concat("within", F.when(F.col("kind") == "object", "o").when(F.col("kind") == "array", "a").otherwise(""))
    return F.struct(*order, named.alias("said"), around.alias("around"), F.col("within").alias("over"))


def _written(tree: DataFrame, parts: Column) -> DataFrame:
    written = """transform(parts, (x, i) -> concat(x.said, reverse(translate(substr(x.around, size(coalesce(get(parts, i + 1).path, array())) + 1), 'oa', '}]')),
        case when i + 1 < size(parts) and size(get(parts, i + 1).path) <= length(x.around) - if(x.around = x.over, 0, 1) then ',' else '' end))"""
    return tree.groupBy("doc").agg(F.array_sort(parts).alias("parts")).select("doc", F.array_join(F.expr(written), "").alias("json"))


def digests(tree: DataFrame) -> DataFrame:
    """doc, digest: the SHA-256 of the canonical text, equal for documents that differ in layout and order of keys alone."""
    return canonical(tree).select("doc", F.sha2(F.col("json").cast("binary"), 256).alias("digest"))
