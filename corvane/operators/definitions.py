"""Definitions of schemas: where instances hold them, which mean the same, how they conjoin, what they descend from.

All work on node tables of schemas (``nodes.nodes``); each walk is a join to a fixpoint whose rounds are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corvane.functions.draft04 import canonical, deeply, parsed, places, standing, unescaped
from corvane.operators.schemas import quoted, texts
from corvane.operators.validation import number, single, subtrees
from corvane.session import settled, weighed

DEFINITION = "^/definitions/[^/]+"
#: Keys of a schema that only tell of it.
DOCUMENTATION = ("description", "title", "examples", "$comment")

#: Steps of a pointer within a schema -> steps within an instance: names of properties, * for items; unions stand where they are.
_PATTERN = """aggregate(split({p}, '/'), named_struct('next', 'skip', 'said', cast(array() as array<string>), 'within', ''), (a, x) -> case
    when a.next = 'skip' then named_struct('next', 'key', 'said', a.said, 'within', a.within)
    when a.next = 'name' then named_struct('next', 'key', 'said', concat(a.said, array(x)), 'within', concat(a.within, 'o'))
    when x = 'properties' then named_struct('next', 'name', 'said', a.said, 'within', a.within)
    when x = 'items' then named_struct('next', 'key', 'said', concat(a.said, array('*')), 'within', concat(a.within, 'a'))
    when x in ('allOf', 'anyOf', 'oneOf') then named_struct('next', 'skip', 'said', a.said, 'within', a.within)
    else named_struct('next', 'key', 'said', a.said, 'within', a.within) end)"""


#: For each part of a pointer within a schema its group among what stands beside it: properties 0, items 1, oneOf 2, anyOf 3, allOf 4; null where it is only a step on the way.
_GROUPS = """aggregate(split(p, '/'), named_struct('next', 'root', 'key', '', 'said', cast(array() as array<int>)), (a, x) -> case
    when a.next = 'root' then named_struct('next', 'key', 'key', '', 'said', concat(a.said, array(cast(null as int))))
    when a.next = 'name' then named_struct('next', 'key', 'key', '', 'said', concat(a.said, array(0)))
    when a.next = 'index' then named_struct('next', 'key', 'key', '', 'said', concat(a.said, array(case a.key when 'oneOf' then 2 when 'anyOf' then 3 else 4 end)))
    when x = 'properties' then named_struct('next', 'name', 'key', x, 'said', concat(a.said, array(cast(null as int))))
    when x = 'items' then named_struct('next', 'key', 'key', x, 'said', concat(a.said, array(1)))
    else named_struct('next', 'index', 'key', x, 'said', concat(a.said, array(cast(null as int)))) end, a -> a.said)"""


def sites(schemas: DataFrame) -> DataFrame:
    """schema, owner (a definition's pointer, '' for the root), target, said, within: every reference, with what the steps to it mean in an instance.

    One that lies below another to the same target is not told.
    """
    found = schemas.where("step = '$ref' and kind = 'string' and value like '#/%'").select(F.col("doc").alias("schema"), F.col("parent").alias("site"), F.expr("substr(value, 2)").alias("target"))
    above = found.select(F.col("schema").alias("a"), F.col("site").alias("b"), F.col("target").alias("c"))
    found = found.join(above, F.col("schema").eqNullSafe(F.col("a")) & (F.col("target") == F.col("c")) & F.startswith("site", F.concat("b", F.lit("/"))), "left_anti")
    owner = F.regexp_extract("site", DEFINITION, 0)
    found = found.withColumn("owner", owner).withColumn("p", F.expr("substr(site, length(owner) + 1)"))
    return found.withColumn("w", F.expr(_PATTERN.format(p="p"))).select("schema", "owner", "target", "site", "w.said", "w.within")


def patterns(schemas: DataFrame, asked: DataFrame) -> DataFrame:
    """asked(schema, target) of schema pointers -> schema, target, pattern, within, n: the instance patterns at which each stands, and by how many chains of references.

    Chains are followed from the target to the root; one that comes back to a definition it has passed ends there.
    """
    schemas = weighed(schemas)
    edges = weighed(sites(schemas)).select(F.col("schema").alias("es"), "owner", F.col("target").alias("to"), F.col("said").alias("before"), F.col("within").alias("before_within"))
    front = asked.select("schema", "target").distinct().select("schema", "target", F.col("target").alias("at"), F.expr("cast(array() as array<string>)").alias("said"), F.lit("").alias("within"), F.array("target").alias("seen"))
    front, done = weighed(front), []
    while True:
        met = front.join(edges, F.col("schema").eqNullSafe(F.col("es")) & (F.col("at") == F.col("to")))
        met = weighed(met.select("schema", "target", F.col("owner").alias("at"), F.concat("before", "said").alias("said"), F.concat("before_within", "within").alias("within"), "seen"))
        done.append(met.where("at = ''"))
        front = met.where("at <> '' and not array_contains(seen, at)").withColumn("seen", F.concat("seen", F.array("at")))
        if front.isEmpty():
            break
    pattern = F.concat_ws("", F.transform("said", lambda x: F.concat(F.lit("/"), x)))
    return reduce(DataFrame.union, done).groupBy("schema", "target", pattern.alias("pattern"), "within").agg(F.count("*").alias("n"))


def occurrences(tree: DataFrame, found: DataFrame, owners: DataFrame) -> DataFrame:
    """patterns and owners(doc, schema) -> doc, schema, target, pointer, n: every place of an instance where a definition stands."""
    own = weighed(owners.select(F.col("doc").alias("od"), "schema").distinct())
    nodes = tree.select("doc", "pointer", F.col("pattern").alias("np"), F.col("within").alias("nw"))
    held = nodes.join(own, F.col("doc").eqNullSafe(F.col("od")))
    p = weighed(found).select(F.col("schema").alias("ps"), "target", "pattern", "within", "n")
    met = held.join(p, F.col("schema").eqNullSafe(F.col("ps")) & (F.col("np") == F.col("pattern")) & (F.col("nw") == F.col("within")))
    return met.groupBy("doc", "schema", "target", "pointer").agg(F.sum("n").alias("n"))


def inspected(verdicts: DataFrame, tree: DataFrame, schemas: DataFrame) -> DataFrame:
    """verdicts (of ``validation``) and node tables -> as ``inspected_texts``, the documents that failed put together from their nodes."""
    failed = weighed(verdicts.where("not valid and pointer is not null").select("doc", "schema", "pointer", "schema_pointer"))
    mine = tree.join(failed.select(F.col("doc").alias("fd")).distinct(), F.col("doc").eqNullSafe(F.col("fd")), "left_semi")
    whole = texts(mine).select(F.col("doc").alias("td"), F.col("json").alias("text")).hint("merge")
    return inspected_texts(failed.join(whole, F.col("doc").eqNullSafe(F.col("td")), "left").withColumn("valid", F.lit(False)), schemas)


def inspected_texts(verdicts: DataFrame, schemas: DataFrame) -> DataFrame:
    """verdicts with the texts judged (of ``validation.judged``) -> doc, schema, pointer, schema_pointer, held, fragment, others: each failure with what
    stands there, the failing node of the schema, both as canonical text, and the sorted places of the document where that node is referred to.

    A verdict without a place (no JSON) is left out; a node that nothing refers to has no other places. Failures are written once,
    with their texts, and each is looked through in its task; what is joined is nodes of schemas alone.
    """
    schemas = weighed(schemas)
    failed = settled(verdicts.where("not valid and pointer is not null").select("doc", "schema", "pointer", "schema_pointer", "text"))
    said = weighed(failed.select("schema", F.col("schema_pointer").alias("target")).distinct())
    fragment = subtrees(schemas, said.select(F.col("schema").alias("doc"), F.col("target").alias("pointer"))).select(F.col("doc").alias("sd"), F.col("pointer").alias("sp"), F.col("json").alias("fragment"))
    found = patterns(schemas, said).groupBy(F.col("schema").alias("ps"), F.col("target").alias("pt")).agg(F.collect_list(F.struct("pattern", "within")).alias("patterns"))
    said = said.join(fragment, F.col("schema").eqNullSafe(F.col("sd")) & (F.col("target") == F.col("sp")), "left").join(found, F.col("schema").eqNullSafe(F.col("ps")) & (F.col("target") == F.col("pt")), "left")
    said = weighed(said.select(F.col("schema").alias("ks"), "target", "fragment", "patterns"))
    met = failed.join(said.drop("fragment"), F.col("schema").eqNullSafe(F.col("ks")) & (F.col("schema_pointer") == F.col("target")), "left").drop("ks", "target")
    kept = ["doc", "schema", "pointer", "schema_pointer"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, others = [], []
            for text, pointer, looked in zip(*[b.column(c).to_pylist() for c in ("text", "pointer", "patterns")], strict=True):
                value = parsed(text)
                found = standing(value, [unescaped(x) for x in pointer.split("/")[1:]])
                held.append(deeply(canonical, found[0]) if found else None)
                others.append(sorted({at for p in looked or () for at in places(value, p["pattern"], p["within"])}))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(held, pa.string()), pa.array(others, pa.list_(pa.string()))], names=[*kept, "held", "others"])

    shown = met.mapInArrow(run, StructType([*[met.schema[c] for c in kept], StructField("held", StringType()), StructField("others", ArrayType(StringType()))]))
    shown = shown.join(said.drop("patterns"), F.col("schema").eqNullSafe(F.col("ks")) & (F.col("schema_pointer") == F.col("target")), "left")
    return shown.select("doc", "schema", "pointer", "schema_pointer", "held", "fragment", "others")


def first_paths(schemas: DataFrame) -> DataFrame:
    """schema, name, path: the place in an instance where each definition is met first, depth first from the root; null where it is never met.

    A node that refers to another is what it refers to; else its properties come in the order written, then items, oneOf, anyOf and allOf.
    Paths are compared by these ranks, step by step. The least path to a definition extends the least one to the definition before it,
    so each round keeps one path for each and tries all references from it; none passes a definition twice.
    """
    schemas = weighed(schemas)
    refs = schemas.where("step = '$ref' and kind = 'string' and value like '#/%'").select(F.col("doc").alias("schema"), F.col("parent").alias("site"), F.expr("substr(value, 2)").alias("target"))
    refs = refs.withColumn("owner", F.regexp_extract("site", DEFINITION, 0)).withColumn("p", F.expr("substr(site, length(owner) + 1)"))
    refs = refs.where(F.col("p").rlike("^(/properties/[^/]+|/items|/(oneOf|anyOf|allOf)/[0-9]+)*$"))
    # the ranks of the steps to a site, and whether a reference stands before it
    steps = refs.withColumn("k", F.explode(F.expr("sequence(0, size(split(p, '/')) - 1)"))).withColumn("above", F.expr("concat(owner, array_join(slice(split(p, '/'), 1, k + 1), '/'))"))
    placed = schemas.select(F.col("doc").alias("d"), "pointer", "place", F.col("step").alias("s"))
    steps = steps.join(placed, F.col("schema").eqNullSafe(F.col("d")) & (F.col("above") == F.col("pointer"))).drop("d", "pointer", "s")
    steps = steps.withColumn("g", F.expr(f"get({_GROUPS}, k)")).withColumn("rank", F.when(F.col("g").isNotNull(), F.struct("g", "place")))
    stop = refs.select(F.col("schema").alias("rs"), F.col("site").alias("rp"))
    steps = steps.join(stop, F.col("schema").eqNullSafe(F.col("rs")) & (F.col("above") == F.col("rp")) & (F.col("above") != F.col("site")), "left")
    edges = steps.groupBy("schema", "owner", "site", "p", "target").agg(F.array_sort(F.collect_list(F.when(F.col("rank").isNotNull(), F.struct("k", "rank")))).alias("ranks"), F.count("rp").alias("stops"))
    edges = weighed(edges.where("stops = 0").select(F.col("schema").alias("es"), "owner", "target", F.col("ranks.rank").alias("more"), F.expr(_PATTERN.format(p="p")).alias("w")).withColumn("then", F.expr("transform(w.said, (x, i) -> if(substr(w.within, i + 1, 1) = 'a', '0', x))")).drop("w"))
    none = "cast(array() as array<struct<g:int,place:bigint>>)"
    best = schemas.where("pointer = ''").select(F.col("doc").alias("schema"), F.lit("").alias("at"), F.expr(none).alias("ranks"), F.expr("cast(array() as array<string>)").alias("path"), F.array(F.lit("")).alias("seen")).distinct()
    best = weighed(best)
    front = best
    while True:
        new = front.join(edges, F.col("schema").eqNullSafe(F.col("es")) & (F.col("at") == F.col("owner"))).where("not array_contains(seen, target)")
        new = new.select("schema", F.col("target").alias("at"), F.concat("ranks", "more").alias("ranks"), F.concat("path", "then").alias("path"), F.concat("seen", F.array("target")).alias("seen"))
        both = new.withColumn("new", F.lit(True)).unionByName(best.withColumn("new", F.lit(False)))
        kept = weighed(both.groupBy("schema", "at").agg(F.min(F.struct("ranks", "new", "path", "seen")).alias("m")).select("schema", "at", "m.ranks", "m.path", "m.seen", "m.new"))
        front, best = kept.where("new").drop("new"), kept.drop("new")
        if front.isEmpty():
            break
    names = schemas.where("parent = '/definitions'").select(F.col("doc").alias("schema"), F.col("pointer").alias("name"))
    paths = best.select(F.col("schema").alias("bs"), "at", F.concat(F.lit("/"), F.array_join("path", "/")).alias("path"))
    out = names.join(paths, F.col("schema").eqNullSafe(F.col("bs")) & (F.col("name") == F.col("at")), "left")
    return out.select("schema", F.expr("substr(name, 14)").alias("name"), F.when(F.col("path") == "/", "").otherwise(F.col("path")).alias("path"))


def colours(schemas: DataFrame, fold: bool = False, unordered: tuple[str, ...] = ("enum", "required", "anyOf")) -> DataFrame:
    """schema, pointer, colour: nodes of one colour mean the same, whatever their definitions are called.

    Classes are refined until they are stable: a node's colour is of its kind, its value and the colours of what it holds, by step, as
    a bag where order says nothing; one that refers to another has that one's colour, so references may go round. ``fold`` leaves
    case and ``_`` of keys aside. Give it ``schemas.restrictions`` to leave annotations out. Keys beside a reference say nothing, and so
    does an empty ``additionalProperties``.
    """
    t = weighed(schemas.where("doc is not null"))
    empty = t.select(F.col("doc").alias("cd"), F.col("parent").alias("cp")).where("cp is not null").distinct()
    vacant = t.where("step = 'additionalProperties' and kind = 'object'").join(empty, (F.col("doc") == F.col("cd")) & (F.col("pointer") == F.col("cp")), "left_anti").select(F.col("doc").alias("vd"), F.col("pointer").alias("vp"))
    t = t.join(vacant, (F.col("doc") == F.col("vd")) & (F.col("pointer") == F.col("vp")), "left_anti")
    ref = t.where("step = '$ref' and kind = 'string' and value like '#%'").select(F.col("doc").alias("rd"), F.col("parent").alias("rp"), F.expr("substr(value, 2)").alias("target"))
    there = t.select(F.col("doc").alias("td"), F.col("pointer").alias("tp"))
    ref = ref.join(there, (F.col("rd") == F.col("td")) & (F.col("target") == F.col("tp")), "left_semi")
    # what each reference means in the end: chains are halved until none is left; those that only go round stay as they are
    rounds = 0
    ref = weighed(ref.distinct())
    while ref.count() >> rounds:
        on = ref.select(F.col("rd").alias("od"), F.col("rp").alias("op"), F.col("target").alias("onward"))
        ref = weighed(ref.join(on, (F.col("rd") == F.col("od")) & (F.col("target") == F.col("op")), "left").select("rd", "rp", F.coalesce("onward", "target").alias("target")))
        rounds += 1
    step = F.col("step") if not fold else F.lower(F.replace(F.col("step"), F.lit("_"), F.lit("")))
    bag = F.expr("right(within, 1) = 'a'") & F.element_at(F.split("parent", "/"), -1).isin(*unordered)
    kind = F.when(F.col("kind").isin("integer", "number"), "number").otherwise(F.col("kind"))
    t = t.join(ref, (F.col("doc") == F.col("rd")) & (F.col("pointer") == F.col("rp")), "left").select(
        F.col("doc").alias("schema"), "pointer", "parent", F.when(bag, "").otherwise(F.coalesce(step, F.lit(""))).alias("by"), "target", F.coalesce("target", "pointer").alias("means"), F.sha2(F.concat_ws(":", kind, single()), 256).alias("own"))
    t = weighed(t)
    state = weighed(t.select("schema", "pointer", "own"))
    classes, state = 0, state.withColumnRenamed("own", "colour")
    while True:
        c = state.select(F.col("schema").alias("cs"), F.col("pointer").alias("cp"), "colour")
        meant = (F.col("schema") == F.col("cs")) & (F.col("means") == F.col("cp"))
        found = state.agg(F.count_distinct("colour")).first()[0]
        if found == classes:
            return t.select("schema", "pointer", "means").join(c, meant).select("schema", "pointer", "colour")
        classes = found
        held = t.where("parent is not null").join(c, meant).groupBy(F.col("schema").alias("hs"), F.col("parent").alias("hp")).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "by", "colour"))), ",").alias("held"))
        held = held.join(t.where("target is not null").select(F.col("schema").alias("ts"), F.col("pointer").alias("tp")), (F.col("hs") == F.col("ts")) & (F.col("hp") == F.col("tp")), "left_anti")
        state = weighed(t.join(held, (F.col("schema") == F.col("hs")) & (F.col("pointer") == F.col("hp")), "left").select("schema", "pointer", F.sha2(F.concat_ws("|", "own", F.coalesce("held", F.lit(""))), 256).alias("colour")))


def falsified(found: DataFrame, edges: DataFrame) -> DataFrame:
    """colours and edges(edge, schema, pointer) that say all their places are one shape -> edge: those whose places are not, or are not there."""
    c = found.select(F.col("schema").alias("cs"), F.col("pointer").alias("cp"), "colour")
    met = edges.join(c, F.col("schema").eqNullSafe(F.col("cs")) & (F.col("pointer") == F.col("cp")), "left")
    return met.groupBy("edge").agg((F.count_distinct("colour") + F.count_if(F.col("colour").isNull())).alias("n")).where("n > 1").select("edge")


def disagreements(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """colours and pairs(mine, witness) of schemas -> mine, witness, name, absent: the witness's definitions that are not there or not the same in mine."""
    named = weighed(found.where("pointer like '/definitions/%' and pointer not like '/definitions/%/%'").select("schema", F.expr("substr(pointer, 14)").alias("name"), "colour"))
    theirs = weighed(pairs).join(named, F.col("witness") == F.col("schema")).select("mine", "witness", "name", F.col("colour").alias("theirs"))
    ours = named.select(F.col("schema").alias("os"), F.col("name").alias("on"), F.col("colour").alias("ours"))
    met = theirs.join(ours, (F.col("mine") == F.col("os")) & (F.col("name") == F.col("on")), "left")
    return met.where("ours is null or ours <> theirs").select("mine", "witness", "name", F.col("ours").isNull().alias("absent"))


def atoms(schemas: DataFrame) -> DataFrame:
    """schema, pointer, json: the nodes of a schema down to its lists, which are one value; null for objects."""
    single_ = F.when(F.col("kind").isin("integer", "number"), number("value")).when(F.col("kind") == "string", quoted(F.col("value"))).when(F.col("kind") == "null", "null").otherwise(F.col("value"))
    outer = schemas.where("not contains(within, 'a')")
    lists = subtrees(schemas, outer.where("kind = 'array'").select("doc", "pointer")).select(F.col("doc").alias("ld"), F.col("pointer").alias("lp"), F.col("json").alias("list"))
    outer = outer.join(lists, F.col("doc").eqNullSafe(F.col("ld")) & (F.col("pointer") == F.col("lp")), "left")
    return outer.select(F.col("doc").alias("schema"), "pointer", F.when(F.col("kind") == "array", F.col("list")).when(F.col("kind") != "object", single_).alias("json"))


def conjoined(parts: DataFrame) -> DataFrame:
    """parts(whole, n, pointer, json) of node tables in order -> whole, pointer, json, conflict: the nodes of all, one a place.

    Objects unite; equal values stay; of keys that document the last counts; lists called ``required`` unite in order; any other two values
    at a place are a conflict, which names the second (the first stands), and so is a value where another part has an object.
    """
    key = F.element_at(F.split("pointer", "/"), -1)
    g = parts.groupBy("whole", "pointer").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", F.coalesce("json", F.lit("{}")).alias("json"), F.col("json").isNull().alias("object")))), lambda x: F.struct(x["json"].alias("json"), x["object"].alias("object"))).alias("l"))
    g = g.withColumns({"key": key, "first": F.expr("l[0].json"), "object": F.expr("l[0].object"), "other": F.expr("get(filter(l, x -> x.json <> l[0].json or x.object <> l[0].object), 0).json"), "last": F.element_at("l", -1)})
    united = F.expr("to_json(array_distinct(flatten(transform(l, x -> coalesce(from_json(x.json, 'array<string>'), array())))))")
    lists = (F.col("key") == "required") & F.expr("forall(l, x -> x.json like '[%')")
    told = F.col("key").isin(*DOCUMENTATION)
    value = F.when(F.col("other").isNull(), F.col("first")).when(told, F.col("last.json")).when(lists, united).otherwise(F.col("first"))
    is_object = F.when(told, F.col("last.object")).otherwise(F.col("object"))
    return g.select("whole", "pointer", F.when(~is_object, value).alias("json"), F.when(F.col("other").isNotNull() & ~told & ~lists, F.col("other")).alias("conflict"))


def flattened(schemas: DataFrame) -> DataFrame:
    """schema, name, pointer, json, conflict: every definition with its ``allOf`` resolved, the members' own first, then what stands beside it.

    Definitions are done in the order of their references, all whose members are done in one round; such as refer to themselves, or to one
    that is not there, give no rows. Inline members of members are resolved too. Lists are one value (see ``atoms``).
    """
    schemas = weighed(schemas)
    names = schemas.where("parent = '/definitions' and kind = 'object'").select(F.col("doc").alias("schema"), F.col("pointer").alias("owner"))
    # pieces of a definition: its own keys and, as deep as allOf stands in allOf, those of its members, in order
    inside = schemas.where(F.col("pointer").rlike(DEFINITION)).select(F.col("doc").alias("schema"), "pointer", F.regexp_extract("pointer", DEFINITION, 0).alias("owner"), F.regexp_extract("pointer", DEFINITION + "(/allOf/[0-9]+)*", 0).alias("piece"), "step", "kind", "value", "within", "path")
    rest = F.expr("substr(pointer, length(piece) + 1)")
    body = inside.where(~rest.rlike("^/allOf(/|$)"))
    ref = body.where("step = '$ref' and kind = 'string' and pointer = concat(piece, '/$ref') and piece <> owner").select("schema", "owner", "piece", F.expr("substr(value, 2)").alias("target"))
    relative = F.expr("array_join(slice(split(pointer, '/'), size(split(piece, '/')) + 1, 1000000), '/')")
    # the members of a piece come before its own keys
    order = F.concat(F.transform(F.filter(F.split(F.expr("substr(piece, length(owner) + 1)"), "/"), lambda x: x.rlike("^[0-9]+$")), lambda x: x.cast("long")), F.array(F.lit(1 << 40)))
    trees = body.select(F.struct("schema", "owner", "piece").alias("doc"), F.concat(F.when(relative == "", "").otherwise(F.concat(F.lit("/"), relative))).alias("pointer"), "kind", "value", F.expr("right(within, length(within) - size(split(piece, '/')) + 1)").alias("within"), F.expr("slice(path, size(split(piece, '/')), 1000000)").alias("path"))
    own = weighed(atoms(trees).select("schema.*", "pointer", "json").withColumn("order", order))
    own = own.join(ref.select(F.col("schema").alias("xs"), F.col("owner").alias("xo"), F.col("piece").alias("xp")), F.col("schema").eqNullSafe(F.col("xs")) & (F.col("owner") == F.col("xo")) & (F.col("piece") == F.col("xp")), "left_anti")
    owed = weighed(ref.withColumn("order", order))
    done = None
    left = weighed(names)
    while True:
        finished = done.select(F.col("schema").alias("ds"), F.col("owner").alias("do")).distinct() if done is not None else names.where("false").select(F.col("schema").alias("ds"), F.col("owner").alias("do"))
        waits = owed.join(finished, F.col("schema").eqNullSafe(F.col("ds")) & (F.col("target") == F.col("do")), "left_anti").select(F.col("schema").alias("ws"), F.col("owner").alias("wo"))
        ready = weighed(left.join(waits, F.col("schema").eqNullSafe(F.col("ws")) & (F.col("owner") == F.col("wo")), "left_anti"))
        if ready.isEmpty():
            break
        now = ready.select(F.col("schema").alias("ns"), F.col("owner").alias("no"))
        mine = lambda df: df.join(now, F.col("schema").eqNullSafe(F.col("ns")) & (F.col("owner") == F.col("no")), "left_semi")  # noqa: E731, B023
        parts = mine(own).select("schema", "owner", "order", "pointer", "json", F.lit(None).cast("string").alias("before"))
        if done is not None:
            got = done.select(F.col("schema").alias("gs"), F.col("owner").alias("go"), "pointer", "json", F.col("conflict").alias("before"))
            parts = parts.unionByName(mine(owed).join(got, F.col("schema").eqNullSafe(F.col("gs")) & (F.col("target") == F.col("go"))).select("schema", "owner", "order", "pointer", "json", "before"))
        made = conjoined(parts.select(F.struct("schema", "owner").alias("whole"), F.col("order").alias("n"), "pointer", "json"))
        kept = parts.where("before is not null").groupBy(F.struct("schema", "owner").alias("w"), F.col("pointer").alias("p")).agg(F.min("before").alias("before"))
        made = made.join(kept, F.col("whole").eqNullSafe(F.col("w")) & (F.col("pointer") == F.col("p")), "left").select("whole.*", "pointer", "json", F.coalesce("conflict", "before").alias("conflict"))
        done = weighed(made if done is None else done.unionByName(made))
        left = weighed(left.join(now, F.col("schema").eqNullSafe(F.col("ns")) & (F.col("owner") == F.col("no")), "left_anti"))
    if done is None:
        return names.select("schema", F.col("owner").alias("name"), F.lit("").alias("pointer"), F.lit("").alias("json"), F.lit("").alias("conflict")).where("false")
    return done.select("schema", F.expr("substr(owner, 14)").alias("name"), "pointer", "json", "conflict")


def refines(flat: DataFrame, pairs: DataFrame) -> DataFrame:
    """flattened and pairs(schema, base, defn) -> schema, base, defn, bearing: ``holds`` where the base adds nothing to the definition, ``same`` where
    both say the same, ``override`` where a place of both is in conflict, else ``unbearable``. Documentation is left aside; enum and required go by their members."""
    key = F.element_at(F.split("pointer", "/"), -1)
    members = F.expr("to_json(array_sort(from_json(json, 'array<string>')))")
    kept = flat.where(~key.isin(*DOCUMENTATION)).select("schema", "name", "pointer", F.when(key.isin("enum", "required") & F.startswith("json", F.lit("[")), members).otherwise(F.coalesce("json", F.lit("{}"))).alias("form"), key.alias("key"))
    mine = kept.select(F.col("schema").alias("ms"), F.col("name").alias("mn"), F.col("pointer").alias("mp"), F.col("form").alias("mform"))
    asked = pairs.select("schema", "base", "defn").distinct()
    base = asked.join(kept.withColumnRenamed("schema", "ks"), F.col("schema").eqNullSafe(F.col("ks")) & (F.col("base") == F.col("name")))
    met = base.join(mine, F.col("schema").eqNullSafe(F.col("ms")) & (F.col("defn") == F.col("mn")) & (F.col("pointer") == F.col("mp")), "left")
    united = (F.col("key") == "required") & F.startswith("form", F.lit("[")) & F.startswith("mform", F.lit("["))
    adds = F.when(united, F.expr("size(array_except(from_json(form, 'array<string>'), from_json(mform, 'array<string>'))) > 0"))
    said = met.groupBy("schema", "base", "defn").agg(F.count_if(F.col("mform").isNull() | F.coalesce(adds, F.lit(False))).alias("more"), F.count_if((F.col("mform") != F.col("form")) & ~united).alias("against"), F.count_if(F.col("mform") == F.col("form")).alias("alike"), F.count("*").alias("all"))
    total = kept.groupBy(F.col("schema").alias("ts"), F.col("name").alias("tn")).agg(F.count("*").alias("total"))
    said = said.join(total, F.col("schema").eqNullSafe(F.col("ts")) & (F.col("defn") == F.col("tn")))
    bearing = F.when(F.col("against") > 0, "override").when(F.col("more") > 0, "unbearable").when((F.col("alike") == F.col("all")) & (F.col("all") == F.col("total")), "same").otherwise("holds")
    return said.select("schema", "base", "defn", bearing.alias("bearing"))


def classified(names: DataFrame, bases: DataFrame, seeds: DataFrame, stands_for: DataFrame) -> DataFrame:
    """names(name), bases(name, base), seeds(name, kind, rank), stands_for(name, member) -> name, kind.

    A name is of the first kind, by rank, of which it descends from a seed; one that stands for others (an alias for one, a union for
    several) and descends from none is of their kind if it is the same for all of those that are names. Else the kind is ''. Strata:
    descent to its fixpoint, then round by round the names whose members are all judged; what goes round in a circle stays ''.
    """
    reach = weighed(seeds.select("name", "kind", "rank").distinct())
    front = reach
    while not front.isEmpty():
        new = front.select(F.col("name").alias("b"), "kind", "rank").join(bases, F.col("b") == F.col("base")).select("name", "kind", "rank").distinct()
        front = weighed(new.join(reach, ["name", "kind", "rank"], "left_anti"))
        reach = weighed(reach.union(front))
    descent = reach.groupBy("name").agg(F.min(F.struct("rank", "kind")).alias("m")).select("name", "m.kind")
    all_ = names.select("name").where("name is not null").distinct().join(descent, "name", "left")
    inner = stands_for.select("name", "member").distinct().join(all_.select(F.col("name").alias("member")), "member", "left_semi")
    state = weighed(all_.join(inner.select(F.col("name").alias("n"), F.lit(True).alias("open")).distinct(), F.col("name") == F.col("n"), "left").select("name", F.when(F.col("kind").isNull() & F.col("open").isNull(), "").otherwise(F.col("kind")).alias("kind")))
    while True:
        of = state.select(F.col("name").alias("member"), F.col("kind").alias("member_kind"))
        told = inner.join(of, "member").groupBy(F.col("name").alias("n")).agg(F.count_if(F.col("member_kind").isNull()).alias("owed"), F.count_distinct("member_kind").alias("kinds"), F.min("member_kind").alias("first"))
        met = state.join(told, F.col("name") == F.col("n"), "left")
        new = weighed(met.select("name", F.when(F.col("kind").isNull() & (F.col("owed") == 0), F.when(F.col("kinds") == 1, F.col("first")).otherwise("")).otherwise(F.col("kind")).alias("kind")))
        if new.where("kind is null").count() == state.where("kind is null").count():
            return new.select("name", F.coalesce("kind", F.lit("")).alias("kind"))
        state = new
