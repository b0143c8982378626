"""Draft-04 verdicts by joins against a plain recursive validator on Python values."""

import json
import random
import re

import pytest

from conftest import SF
from corvane.functions import draft04
from corvane.operators import definitions, nodes, validation
from corvane.plans import algebra
from test_schemas import tree_of

KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}


def esc(step):
    return str(step).replace("~", "~0").replace("/", "~1")


def show(v):
    return KINDS[type(v)] if isinstance(v, (dict, list)) else str(v) if isinstance(v, (int, float, bool)) or v is None else f"'{v}'"


def same(a, b):
    if isinstance(a, bool) or isinstance(b, bool) or not (isinstance(a, (int, float)) and isinstance(b, (int, float))):
        if type(a) is not type(b):
            return False
        if isinstance(a, dict):
            return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
        if isinstance(a, list):
            return len(a) == len(b) and all(map(same, a, b))
    return a == b


def check(v, schema, root, at=(), where="", seen=("",)):
    """Faults in order: (path, keyword, schema pointer, words, alternatives or None, keyword's value)."""
    if "$ref" in schema:
        target = schema["$ref"][1:]
        node = root
        for step in target.split("/")[1:]:
            node = node[step]
        if target not in seen:
            yield from check(v, node, root, at, target, (*seen, target))
        return
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    down = lambda x, sub, step, place: check(x, sub, root, (*at, step), place, (place,))
    stay = lambda sub, place: check(v, sub, root, at, place, (*seen, place))
    for key, arg in schema.items():
        say = None
        here = f"{where}/{key}"
        if key == "type":
            kinds = [arg] if isinstance(arg, str) else arg
            if KINDS[type(v)] not in kinds and not (KINDS[type(v)] == "integer" and "number" in kinds):
                say = f"{show(v)} is not of type " + ", ".join(f"'{k}'" for k in kinds)
        elif key == "enum" and not any(same(v, x) for x in arg):
            say = f"{show(v)} is not one of [{', '.join(map(show, arg))}]"
        elif key == "minimum" and number and (v < arg or (schema.get("exclusiveMinimum") and v == arg)):
            say = f"{show(v)} is less than {'or equal to ' if schema.get('exclusiveMinimum') else ''}the minimum of {arg}"
        elif key == "maximum" and number and (v > arg or (schema.get("exclusiveMaximum") and v == arg)):
            say = f"{show(v)} is greater than {'or equal to ' if schema.get('exclusiveMaximum') else ''}the maximum of {arg}"
        elif key == "multipleOf" and number and v % arg:
            say = f"{show(v)} is not a multiple of {arg}"
        elif (key == "minLength" and isinstance(v, str) and len(v) < arg) or (key == "minItems" and isinstance(v, list) and len(v) < arg):
            say = f"{show(v)} is too short"
        elif (key == "maxLength" and isinstance(v, str) and len(v) > arg) or (key == "maxItems" and isinstance(v, list) and len(v) > arg):
            say = f"{show(v)} is too long"
        elif key == "pattern" and isinstance(v, str) and not re.search(arg, v):
            say = f"{show(v)} does not match '{arg}'"
        elif key == "minProperties" and isinstance(v, dict) and len(v) < arg:
            say = "object does not have enough properties"
        elif key == "maxProperties" and isinstance(v, dict) and len(v) > arg:
            say = "object has too many properties"
        elif key == "uniqueItems" and arg and isinstance(v, list) and any(same(a, b) for i, a in enumerate(v) for b in v[:i]):
            say = "array has non-unique elements"
        elif key == "required" and isinstance(v, dict):
            for name in arg:
                if name not in v:
                    yield at, key, where, f"'{name}' is a required property", None, arg
        elif key == "properties" and isinstance(v, dict):
            for name, sub in arg.items():
                if name in v:
                    yield from down(v[name], sub, name, f"{here}/{esc(name)}")
        elif key == "patternProperties" and isinstance(v, dict):
            for pattern, sub in arg.items():
                for name in v:
                    if re.search(pattern, name):
                        yield from down(v[name], sub, name, f"{here}/{esc(pattern)}")
        elif key == "additionalProperties" and isinstance(v, dict):
            extra = [n for n in v if n not in schema.get("properties", {}) and not any(re.search(p, n) for p in schema.get("patternProperties", {}))]
            if arg is False and extra:
                say = f"Additional properties are not allowed ({', '.join(repr(n) for n in sorted(extra))} {'were' if len(extra) > 1 else 'was'} unexpected)"
            elif isinstance(arg, dict):
                for name in extra:
                    yield from down(v[name], arg, name, here)
        elif key == "items" and isinstance(v, list):
            for i, x in enumerate(v):
                if isinstance(arg, dict):
                    yield from down(x, arg, i, here)
                elif i < len(arg):
                    yield from down(x, arg[i], i, f"{here}/{i}")
        elif key == "additionalItems" and isinstance(v, list) and isinstance(schema.get("items"), list):
            extra = v[len(schema["items"]) :]
            if arg is False and extra:
                say = f"Additional items are not allowed ({', '.join(map(show, extra))} {'were' if len(extra) > 1 else 'was'} unexpected)"
            elif isinstance(arg, dict):
                for i, x in enumerate(extra, len(schema["items"])):
                    yield from down(x, arg, i, here)
        elif key == "dependencies" and isinstance(v, dict):
            for name, sub in arg.items():
                if name in v and isinstance(sub, list):
                    for need in sub:
                        if need not in v:
                            yield at, key, where, f"'{need}' is a dependency of '{name}'", None, arg
                elif name in v:
                    yield from stay(sub, f"{here}/{esc(name)}")
        elif key == "allOf":
            for i, sub in enumerate(arg):
                yield from stay(sub, f"{here}/{i}")
        elif key in ("anyOf", "oneOf"):
            found = [list(stay(sub, f"{here}/{i}")) for i, sub in enumerate(arg)]
            right = sum(not x for x in found)
            if arg and not right:
                yield at, key, where, None, found, arg
            elif key == "oneOf" and right > 1:
                say = f"{show(v)} is valid under each of several alternatives of oneOf"
        elif key == "not" and not list(stay(arg, here)):
            say = f"{show(v)} should not be valid under what 'not' says"
        if say:
            yield at, key, where, say, None, arg


def refusals(fault, depth, value):
    """The enum faults one step below ``depth`` that a refusal rests on; none if the fault refuses nothing."""
    at, key, _, _, found, arg = fault
    if found is None:
        return [(at[-1], arg)] if key == "enum" and len(at) == depth + 1 else []
    if len(at) != depth:
        return []
    each = [[x for f in alt for x in refusals(f, depth, value)] for alt in found]
    return [x for alt in each for x in alt] if all(each) else []


def legible(fault, value):
    while fault[4] is not None:
        at, _, where, _, found, arg = fault
        chosen = [alt for alt in found if not any(refusals(f, len(at), value) for f in alt)]
        if len(chosen) == 1:
            fault = max(chosen[0], key=lambda f: len(f[0]))
            continue
        rests = [x for alt in found for f in alt for x in refusals(f, len(at), value)]
        if not chosen and len({p for p, _ in rests}) == 1:
            name = rests[0][0]
            held = value
            for step in at:
                held = held[step]
            words = sorted({str(x) if not isinstance(x, (list, dict)) else KINDS[type(x)] for _, values in rests for x in values})
            return (*at, name), None, where, f"{show(held[name])} is not a {name} the union declares - declared: [{', '.join(f"'{w}'" for w in words)}]"
        names = [x["$ref"].rsplit("/", 1)[-1] if "$ref" in x else x["type"] if isinstance(x.get("type"), str) else "alternative" for x in arg]
        return at, None, where, "matches none of: " + ", ".join(names)
    return fault[:4]


def plain_verdict(value, schema):
    first = next(check(value, schema, schema), None)
    if first is None:
        return True, None, None, None, None
    at, key, where, said = legible(first, value)
    return False, "".join(f"/{esc(s)}" for s in at), key, where, said


def random_schema(r, deep, names):
    if r.random() < 0.15 and names:
        return {"$ref": f"#/definitions/{r.choice(names)}"}
    out = {}
    sub = lambda: random_schema(r, deep - 1, names)
    single = ["type", "enum", "minimum", "maxLength", "minItems", "required", "additionalProperties", "uniqueItems", "pattern", "multipleOf", "maxProperties", "minProperties", "maxItems", "minLength", "maximum"]
    nested = ["properties", "items", "anyOf", "oneOf", "allOf", "not", "dependencies", "patternProperties", "additionalItems"]
    for key in r.sample(single, r.choice([0, 1, 1, 2])) + (r.sample(nested, r.choice([0, 1, 2])) if deep else []):
        out[key] = {
            "type": lambda: r.choice(["object", "array", "string", "integer", "number", ["null", "boolean"], ["string", "object", "array"]]), "enum": lambda: r.choice([["a", "b"], [1, 2.0, True], [None, "x"], [[1], {"a": 1}], [0]]),
            "minimum": lambda: r.choice([0, 1, 1.5]), "maximum": lambda: r.choice([1, 2]), "maxLength": lambda: 1, "minLength": lambda: 1, "minItems": lambda: 1, "maxItems": lambda: 1, "required": lambda: r.choice([["a"], ["b", "a/b"]]),
            "additionalProperties": lambda: r.choice([False, True, sub() if deep else False]), "uniqueItems": lambda: True, "pattern": lambda: r.choice(["^a", "b"]), "multipleOf": lambda: 2, "maxProperties": lambda: 1, "minProperties": lambda: 1,
            "properties": lambda: {n: sub() for n in r.sample(["a", "b", "t", "a/b"], r.randrange(1, 4))}, "items": lambda: sub() if r.random() < 0.6 else [sub(), sub()], "anyOf": lambda: union(r, sub), "oneOf": lambda: union(r, sub),
            "allOf": lambda: [sub() for _ in range(r.randrange(1, 3))], "not": sub, "dependencies": lambda: {"a": r.choice([["b"], ["b", "t"], sub()]), "a/b": ["a"]}, "patternProperties": lambda: {"^a": sub()}, "additionalItems": lambda: r.choice([False, sub()]),
        }[key]()
    if "minimum" in out and r.random() < 0.4:
        out["exclusiveMinimum"] = True
    return out


def union(r, sub):
    if r.random() < 0.3:
        return [sub() for _ in range(r.randrange(1, 4))]
    return [{**sub(), "properties": {"t": {"enum": [name]}, **({"a": sub()} if r.random() < 0.6 else {})}} for name in r.sample(["x", "y", "z", 1], r.randrange(1, 4))]


def random_value(r, deep=3):
    if deep and r.random() < 0.6:
        if r.random() < 0.75:
            return {n: r.choice(["x", "y", "q", 1]) if n == "t" else random_value(r, deep - 1) for n in r.sample(["a", "b", "t", "a/b", "c"], r.randrange(0, 4))}
        return [random_value(r, deep - 1) for _ in range(r.randrange(0, 4))]
    return r.choice(["a", "b", "", "ab", 0, 1, 2, 1.0, 2.5, True, False, None, 3])


def test_verdicts_equal_a_plain_validator(spark):
    r = random.Random(21)
    schemas, values, owners = [], [], []
    for k in range(70):
        names = ["d0", "d1"]
        schema = random_schema(r, 3, names)
        schemas.append({**schema, "definitions": {n: random_schema(r, 2, names) for n in names}})
        for _ in range(6):
            owners.append((len(values), k))
            values.append(random_value(r))
    tree = tree_of(spark, values)
    got = validation.verdicts(tree.select("doc"), tree, tree_of(spark, schemas), spark.createDataFrame(owners, "doc long, schema long"))
    got = {(x.doc, x.schema): (x.valid, x.pointer, x.keyword, x.schema_pointer, x.said) for x in got.collect()}
    want = {(d, k): plain_verdict(values[d], schemas[k]) for d, k in owners}
    wrong = {k: (values[k[0]], schemas[k[1]], want[k], got.get(k)) for k in want if got.get(k) != want[k]}
    assert not wrong, json.dumps(list(wrong.values())[:3], indent=1)
    assert 50 < sum(not x[0] for x in want.values()) and any("union declares" in str(x[4]) for x in want.values()) and any("matches none" in str(x[4]) for x in want.values())


def test_no_json_no_schema_and_loops(spark):
    docs = spark.createDataFrame([(1, None), (2, "{}"), (3, "7"), (None, '{"a":1}')], "doc long, text string")
    tree = nodes.nodes(docs)
    schemas = tree_of(spark, [{"$ref": "#/definitions/a", "definitions": {"a": {"allOf": [{"$ref": "#/definitions/a"}, {"type": "object"}]}}}, {"properties": {"a": {"$ref": "#"}}, "type": "object"}])
    owners = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (3, 0), (None, 1), (2, 9)], "doc long, schema long")
    got = {(x.doc, x.schema): (x.valid, x.pointer, x.said) for x in validation.verdicts(docs, tree, schemas, owners).collect()}
    assert got == {(1, 0): (False, None, "no JSON"), (2, 0): (True, None, None), (3, 0): (False, "", "7 is not of type 'object'"), (None, 1): (False, "/a", "1 is not of type 'object'"), (2, 9): (True, None, None)}
    assert validation.verdicts(docs.where("false"), tree.where("false"), schemas, owners.where("false")).count() == 0


def written(spark, run):
    """Rows that a run writes to the shared folder on the way."""
    from pathlib import Path

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("settled-*"))
    run()
    return sum(spark.read.parquet(str(p)).count() for p in set(shared.glob("settled-*")) - before)


def test_failures_write_no_nodes_of_documents(spark):
    """Of 200 documents of some 12 nodes 100 fail: what is written beside nodes of the schema is one row a failure, and no document's nodes."""
    schema = {"properties": {"a": {"maximum": 99}}}
    docs = spark.createDataFrame([(i, json.dumps({"a": i, "b": list(range(10))})) for i in range(200)], "doc long, text string").selectExpr("doc", "0 as schema", "text")
    schemas, out = tree_of(spark, [schema]), []
    n = written(spark, lambda: out.extend(definitions.inspected_texts(validation.judged(docs, schemas), schemas).collect()))
    assert sorted((x.doc, x.held, x.fragment, x.others) for x in out) == [(i, str(i), '{"maximum":99}', []) for i in range(100, 200)]
    assert n < 100 + 50
    # from node tables: the same rows
    tree = nodes.nodes(docs)
    found = validation.verdicts(docs, tree, schemas, docs.select("doc", "schema"))
    assert sorted(map(tuple, definitions.inspected(found, tree, schemas).collect())) == sorted(map(tuple, out))


def test_held_and_places_of_texts_equal_those_of_nodes(spark):
    """What stands at a failure and where its definition stands besides, by walking values, against the node table's joins."""
    r = random.Random(3)
    values = [random_value(r, 4) for _ in range(60)] + [{"*": [1e20, 0.00001, 2.0, -0.0, 1234567.5, 12345678.5, "\x01é\"\\"], "a/b": {"t~": [[1], {"z": 1, "b": None}]}}]
    tree = tree_of(spark, values)
    held = {(x.doc, x.pointer): x.json for x in validation.subtrees(tree, tree.select("doc", "pointer")).collect()}
    at, spots = {}, {}
    for x in tree.collect():
        at[x.doc, x.pointer] = draft04.canonical(draft04.standing(values[x.doc], [draft04.unescaped(s) for s in x.pointer.split("/")[1:]])[0])
        spots.setdefault((x.doc, x.pattern, x.within), set()).add(x.pointer)
    assert at == held
    assert all(set(draft04.places(values[d], p, w)) == found for (d, p, w), found in spots.items())
    assert draft04.standing(values[-1], ["*", "07"]) == draft04.standing(values[-1], ["*", "7"]) == []
    assert draft04.places(values[-1], "/*/*", "aa") == []


@pytest.mark.parametrize("name", ["failures_inspected", "documents_validated"])
def test_registered_queries_write_no_nodes_of_documents(spark, name):
    """On the way to their rows they write one row a failure at most, and the nodes of the schema a few times."""
    events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert events >= 500
    assert written(spark, lambda: getattr(algebra, name)(spark, SF).write.format("noop").mode("overwrite").save()) < events


def test_texts_are_judged_alike_by_few_and_many_schemas(spark, monkeypatch):
    """Schemas sent to every task or sorted before shares of their documents: each row once, in either way as a plain validator tells it."""
    r = random.Random(8)
    schemas = [{**random_schema(r, 3, ["d0"]), "definitions": {"d0": random_schema(r, 2, [])}} for _ in range(20)]
    values = [random_value(r) for _ in range(400)]
    owner = [0 if i % 2 else r.randrange(20) for i in range(400)]
    rows = [(i, owner[i], json.dumps(v), i * 7) for i, v in enumerate(values)] + [(900, 3, "{", 1), (901, 3, None, 2), (902, 77, "{}", 3), (903, None, "{}", 4), (None, 77, "7", 5)] + [(5, owner[5], json.dumps(values[5]), 35)]
    asked = spark.createDataFrame(rows, "doc long, schema long, text string, more long").repartition(5)
    want = sorted([(i, owner[i], i * 7, *plain_verdict(v, schemas[owner[i]])) for i, v in [*enumerate(values), (5, values[5])]] + [(900, 3, 1, False, None, None, None, "no JSON"), (901, 3, 2, False, None, None, None, "no JSON")]
                  + [(902, 77, 3, True, None, None, None, None), (903, None, 4, True, None, None, None, None), (None, 77, 5, True, None, None, None, None)], key=repr)
    tree = tree_of(spark, schemas)
    for few in (validation.FEW, 0):
        monkeypatch.setattr(validation, "FEW", few)
        found = validation.judged(asked, tree)
        assert found.columns == ["doc", "schema", "text", "more", "valid", "pointer", "keyword", "schema_pointer", "said"]
        assert sorted([(x.doc, x.schema, x.more, *x[4:]) for x in found.collect()], key=repr) == want
    assert sum(not x[3] for x in want) > 60


def test_deep_documents_and_halves_of_pairs(spark):
    """A document nested 3000 deep, met by a schema that refers to itself, and texts that no column can hold as they are."""
    deep = '{"a":[' * 1500 + "7" + "]}" * 1500
    rows = [(0, deep), (1, deep.replace("7", "null")), (2, '{"s":"x\\ud800\\\\ud800\\ud83d\\ude00"}')]
    schema = {"properties": {"a": {"items": {"anyOf": [{"type": "integer"}, {"$ref": "#"}]}}, "s": {"enum": []}}, "type": "object"}
    asked = spark.createDataFrame(rows, "doc long, text string").selectExpr("doc", "0 as schema", "text")
    got = {x.doc: (x.valid, x.pointer, x.said) for x in validation.judged(asked, tree_of(spark, [schema])).collect()}
    assert got == {0: (True, None, None), 1: (False, "/a/0", "matches none of: integer, #"), 2: (False, "/s", "'x?\\ud800\U0001f600' is not one of []")}
