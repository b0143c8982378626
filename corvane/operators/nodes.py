"""JSON documents as tables of nodes, rules judged on them, and walks over references by joins to a fixpoint.

A node is a row (doc, pointer, parent, step, pattern, kind, value, place, path, within): its JSON pointer, that of the node above,
the step from there, the pointer with ``*`` for array places, one of object, array, string, integer, number, boolean and
null, the text of a single value, its place in the document as written, its steps in a form that sorts, and o or a for each object or array
around it, the outermost first. Rules and patterns then meet nodes by equality, whatever the size of the corpus.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.session import settled, weighed

_KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}
_FIELDS = [("pointer", pa.string()), ("parent", pa.string()), ("step", pa.string()), ("pattern", pa.string()), ("kind", pa.string()), ("value", pa.string()), ("place", pa.int64()), ("path", pa.list_(pa.string())), ("within", pa.string())]
#: Nodes of one Arrow batch at least, save the last.
_AT_ONCE = 20_000
#: Tasks that read texts, for each core.
TASKS_A_CORE = 4


def _walk(value: object, out: tuple[list, ...]) -> Iterator[None]:
    """Adds the nodes of a value to the columns, in the order written, each before what it holds. Stops where these are full, for the caller to empty them."""
    pointers, parents, steps, patterns, kinds, values, places, paths, withins = (c.append for c in out)
    place, left = 0, [(value, "", None, None, "", [], "")]
    while left:
        value, pointer, parent, step, pattern, path, within = left.pop()
        kind = _KINDS[type(value)]
        pointers(pointer), parents(parent), steps(step), patterns(pattern), kinds(kind), places(place), paths(path), withins(within)
        place += 1
        if kind == "string":
            values(value)
        elif kind == "object":
            values(None)
            within += "o"
            for k in reversed(value):
                w = k.replace("~", "~0").replace("/", "~1") if "~" in k or "/" in k else k
                left.append((value[k], f"{pointer}/{w}", pointer, w, f"{pattern}/{w}", [*path, k], within))
        elif kind == "array":
            values(None)
            within, pattern = within + "a", pattern + "/*"
            for i in range(len(value) - 1, -1, -1):
                left.append((value[i], f"{pointer}/{i}", pointer, str(i), pattern, [*path, f"{i:012}"], within))
        else:
            values(None if value is None else json.dumps(value))
        if len(out[0]) >= _AT_ONCE:
            yield


def _whole(x: object) -> object:
    """Texts without halves of surrogate pairs, which no column can hold."""
    return x.encode("utf-8", "replace").decode() if isinstance(x, str) else [_whole(y) for y in x] if isinstance(x, list) else x


#: Halves of surrogate pairs come only from their escapes.
_HALF = re.compile(r"\\u[dD][89a-fA-F]")


def nodes(docs: DataFrame) -> DataFrame:
    """docs(doc, text) -> doc, pointer, parent, step, pattern, kind, value, place, path, within. One pass over texts that are dealt out evenly first.
    The table is marked as too large to broadcast: by its texts Spark would take it for small.

    A null text and one that is no JSON (one nested deeper than the parser goes included) give no rows. Integers are of any
    length; of a key that an object names twice the last value counts. Repeated documents repeat their rows; a null doc
    stays null; other columns are ignored; an empty table gives no rows. A document is held whole by its task.
    """
    kind = docs.schema["doc"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, out, owner = b.column(0), tuple([] for _ in _FIELDS), []

            def made():
                columns = [pa.array(c, t) for c, (_, t) in zip(out, _FIELDS, strict=True)]
                rows = pa.RecordBatch.from_arrays([doc.take(pa.array(owner)), *columns], names=["doc", *(n for n, _ in _FIELDS)])
                for c in (*out, owner):
                    c.clear()
                return rows

            for i, text in enumerate(b.column(1).to_pylist()):
                try:
                    value = json.loads(text or "")
                except (ValueError, RecursionError):
                    continue
                halves = _HALF.search(text)
                walk, more = _walk(value, out), True
                while more:
                    at = len(owner)
                    more = next(walk, True) is None
                    owner.extend([i] * (len(out[0]) - at))
                    if halves:
                        for c in out:
                            c[at:] = [_whole(x) for x in c[at:]]
                    if more:
                        yield made()
            if owner:
                yield made()

    ddl = f"doc {kind.simpleString()}, pointer string, parent string, step string, pattern string, kind string, value string, place long, path array<string>, within string"
    # a small file is one task of texts, whatever its nodes
    spread = docs.select("doc", F.col("text").cast("string")).repartition(TASKS_A_CORE * docs.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, ddl).hint("merge")


def strings(tree: DataFrame) -> DataFrame:
    """doc, pointer, value: all strings at any depth."""
    return tree.where("kind = 'string'").select("doc", "pointer", "value")


def resolved(tree: DataFrame, pointers: DataFrame) -> DataFrame:
    """pointers(doc, pointer) -> doc, pointer, kind: what each pointer leads to, null where it leads nowhere."""
    return pointers.select("doc", "pointer").join(tree.select("doc", "pointer", "kind").distinct(), ["doc", "pointer"], "left")


def at_patterns(tree: DataFrame, patterns: DataFrame) -> DataFrame:
    """patterns(pattern) -> pattern, doc, pointer: the places that a pattern with ``*`` for array places names."""
    return tree.join(weighed(patterns.select("pattern").distinct()), "pattern").select("pattern", "doc", "pointer")


def falsified(tree: DataFrame, claims: DataFrame) -> DataFrame:
    """claims(pattern) that nothing stands there -> pattern, doc, value: the least document in which a value does, and its least pointer's."""
    held = tree.where("value is not null").join(weighed(claims.select("pattern").distinct()), "pattern")
    return held.groupBy("pattern").agg(F.min(F.struct("doc", "pointer", "value")).alias("m")).select("pattern", "m.doc", "m.value")


def references(tree: DataFrame) -> DataFrame:
    """target, pattern, n: where each definition is referred to by ``$ref``, without the step of the reference itself."""
    found = tree.where("step = '$ref' and kind = 'string'")
    return found.groupBy(F.col("value").alias("target"), F.expr("left(pattern, length(pattern) - 5)").alias("pattern")).agg(F.count("*").alias("n"))


def faults(tree: DataFrame, rules: DataFrame) -> DataFrame:
    """rules(pattern, rule, arg array<string>) -> doc, pointer, rule, said: every breach.

    Rules: ``type`` (kinds; number admits integers), ``enum`` (values), ``union`` (types that the union declares), ``minimum``
    and ``maximum`` (one number), ``required`` (keys) and ``closed`` (all keys that may stand there). A rule on a pattern that a
    document lacks says nothing; an unknown rule is ignored.
    """
    met = tree.join(weighed(rules.select("pattern", "rule", "arg")), "pattern")
    listed = F.array_join("arg", ", ")
    shown = F.coalesce(F.when(F.col("kind") == "string", F.concat(F.lit("'"), "value", F.lit("'"))), F.col("value"), F.col("kind"))
    one = met.select("doc", "pointer", "rule", F.expr("""case rule
        when 'type' then not (array_contains(arg, kind) or (kind = 'integer' and array_contains(arg, 'number')))
        when 'enum' then not coalesce(array_contains(arg, value), false) when 'union' then not coalesce(array_contains(arg, value), false)
        when 'minimum' then kind in ('integer', 'number') and try_cast(value as double) < try_cast(arg[0] as double)
        when 'maximum' then kind in ('integer', 'number') and try_cast(value as double) > try_cast(arg[0] as double) end""").alias("broken"),
        F.concat(shown, F.when(F.col("rule") == "type", " is not of type ").when(F.col("rule") == "enum", " is not one of ").when(F.col("rule") == "union", " is not a type the union declares: ")
                 .when(F.col("rule") == "minimum", " is less than the minimum of ").otherwise(" is more than the maximum of "), listed).alias("said"))
    below = tree.select("doc", F.col("parent").alias("pointer"), "step")
    owed = met.where("rule = 'required' and kind = 'object'").select("doc", "pointer", "rule", F.explode("arg").alias("step"))
    lacking = owed.join(below, ["doc", "pointer", "step"], "left_anti").select("doc", "pointer", "rule", F.concat(F.lit("'"), "step", F.lit("' is a required property")).alias("said"))
    shut = met.where("rule = 'closed' and kind = 'object'").select("doc", "pointer", "rule", "arg").join(below, ["doc", "pointer"])
    surplus = shut.where("not array_contains(arg, step)").select("doc", "pointer", "rule", F.concat(F.lit("'"), "step", F.lit("' was unexpected")).alias("said"))
    return one.where("broken").drop("broken").union(lacking).union(surplus)


def verdicts(docs: DataFrame, tree: DataFrame, found: DataFrame) -> DataFrame:
    """doc, valid, pointer, said: one legible fault for each document, that of the deepest union that declares no such type, else the first by pointer.

    Documents without a node (no JSON) are invalid and said to be so.
    """
    depth = F.size(F.split("pointer", "/"))
    first = found.groupBy("doc").agg(F.min(F.struct(F.when(F.col("rule") == "union", -depth).otherwise(0).alias("d"), "pointer", "rule", "said")).alias("m"))
    judged = docs.select("doc").distinct().hint("merge").join(tree.select("doc", F.lit(True).alias("read")).where("pointer = ''").distinct(), "doc", "left").join(first, "doc", "left")
    said = F.when(F.col("read").isNull(), "no JSON").otherwise(F.col("m.said"))
    return judged.select("doc", said.isNull().alias("valid"), "m.pointer", said.alias("said"))


def reached(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """edges(source, target), roots(node) -> node, depth: what the roots reach, by the fewest steps. Cycles end; nulls reach nothing."""
    front = settled(roots.select("node").where("node is not null").distinct().withColumn("depth", F.lit(0)))
    found, depth = front, 0
    while not front.isEmpty():
        depth += 1
        step = front.join(edges, front.node == edges.source).select(F.col("target").alias("node")).where("node is not null").distinct()
        front = settled(step.join(found, "node", "left_anti").withColumn("depth", F.lit(depth)))
        found = settled(found.union(front))
    return found


def nearest(parents: DataFrame, placed: DataFrame) -> DataFrame:
    """parents(node, up), placed(node, layer) -> node, layer: that of the node itself or of the nearest one above, null if none has any.

    Paths are halved: each round joins a node with what the node above it knows, so a chain of n takes log n rounds. One
    row a node; of repeated layers the least counts. Nodes on a cycle without a layer get none.
    """
    state = settled(parents.select("node", "up").join(placed.groupBy("node").agg(F.min("layer").alias("layer")), "node", "left"))
    left = state.count()
    while left > 1:
        above = state.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("layer").alias("over"))
        state = settled(state.join(above, "up", "left").select("node", F.when(F.col("layer").isNull() & F.col("over").isNull(), F.col("next")).alias("up"), F.coalesce("layer", "over").alias("layer")))
        if state.where("layer is null and up is not null").isEmpty():
            break
        left = left / 2
    return state.select("node", "layer")
