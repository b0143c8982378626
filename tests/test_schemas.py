"""The schema walk, restrictions, canonical text and equality of definitions against plain versions on Python values."""

import hashlib
import json
import random

import pytest

from corvane.operators import nodes, schemas


def tree_of(spark, values):
    texts = [(i, json.dumps(v)) for i, v in enumerate(values)]
    return nodes.nodes(spark.createDataFrame(texts, "doc long, text string").repartition(3))


@pytest.fixture(scope="module")
def moves(spark):
    return schemas.grammar(nodes.nodes(spark.createDataFrame([("meta", schemas.META_SCHEMA)], "doc string, text string"))).persist()


MAPS, LISTS, SINGLE = {"properties", "patternProperties", "definitions", "dependencies"}, {"allOf", "anyOf", "oneOf"}, {"not", "additionalProperties", "additionalItems"}


def plain_positions(schema, at=""):
    """Pointer -> position of all that is no plain value; keywords and their forms told by hand."""
    out = {at: "schema"}
    for key, value in schema.items():
        here = f"{at}/{key}"
        if key in MAPS and isinstance(value, dict):
            out[here] = "map"
            for name, inner in value.items():
                if isinstance(inner, dict):
                    out |= plain_positions(inner, f"{here}/{name}")
        elif (key in LISTS or key == "items") and isinstance(value, list):
            out[here] = "list"
            for i, inner in enumerate(value):
                if isinstance(inner, dict):
                    out |= plain_positions(inner, f"{here}/{i}")
        elif key in SINGLE | {"items"} and isinstance(value, dict):
            out |= plain_positions(value, here)
    return out


def plain_restrictions(schema, positions, at=""):
    if not isinstance(schema, (dict, list)):
        return schema
    if isinstance(schema, list):
        return [plain_restrictions(v, positions, f"{at}/{i}") for i, v in enumerate(schema)]
    said = positions.get(at) == "schema"
    return {k: plain_restrictions(v, positions, f"{at}/{k}") for k, v in schema.items() if not (said and k in schemas.ANNOTATIONS and f"{at}/{k}" not in positions)}


def random_schema(r, deep=4):
    keys = [*MAPS, *LISTS, *SINGLE, "items", "title", "id", "default", "enum", "type", "required", "unknown", "minimum", "$ref"]
    out = {}
    for key in r.sample(keys, r.randrange(0, 6)):
        inner = lambda: random_schema(r, deep - 1) if deep else {}
        names = r.sample(["id", "title", "properties", "enum", "default", "a", "not"], r.randrange(0, 3))
        if key in MAPS:
            out[key] = {n: inner() if key != "dependencies" or r.random() < 0.5 else ["a", "title"] for n in names}
        elif key in LISTS or (key == "items" and r.random() < 0.5):
            out[key] = [inner() for _ in range(r.randrange(0, 3))]
        elif key in SINGLE | {"items"}:
            out[key] = inner() if r.random() < 0.7 else True
        else:
            out[key] = r.choice(["x", {"properties": {"title": 1}}, [{"title": 2}], 5, {"items": {"id": "q"}}])
    return out


def test_positions_restrictions_and_digests_equal_a_plain_walk(spark, moves):
    r = random.Random(11)
    values = [random_schema(r) for _ in range(60)] + [{}, {"properties": {"properties": {"properties": {"enum": {"title": "x"}}}}, "enum": {"properties": {"a": {}}}}, [], 7, {"definitions": {"definitions": {"title": "t"}}}]
    placed = schemas.positions(tree_of(spark, values), moves).persist()
    got = {}
    for row in placed.where("position <> 'value'").collect():
        got.setdefault(row.doc, {})[row.pointer] = row.position
    want = {i: plain_positions(v) for i, v in enumerate(values) if isinstance(v, dict)}
    assert got == want
    assert placed.count() == tree_of(spark, values).count()
    text = lambda v: json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    digest = {r.doc: r.digest for r in schemas.digests(schemas.restrictions(placed)).collect()}
    assert digest == {i: hashlib.sha256(text(plain_restrictions(v, want.get(i, {}))).encode()).hexdigest() for i, v in enumerate(values)}
    assert schemas.positions(placed.where("false").drop("position"), moves).count() == 0


def test_canonical_is_the_inverse_of_nodes(spark):
    values = [
        {}, [], [""], None, True, 0, -1.5, 1e100, 10**25, {"b": [1, [2, {}], []], "a": {"~/": {"": None}}}, {"10": 1, "9": 2, "é": "日本 ", "z": "\x00\x1f\"\\/\b\f\n\r\t\x7f"},
        list(range(23)), {"*": [{"*": {"000000000001": [[[]]]}}]}, [[], {}, [{}]], {"k": {"k": {"k": []}}, "l": False},
    ]
    tree = tree_of(spark, values)
    want = {i: json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for i, v in enumerate(values)}
    assert {r.doc: r.json for r in schemas.canonical(tree).collect()} == want
    again = nodes.nodes(schemas.canonical(tree).withColumnRenamed("json", "text"))
    assert again.drop("place").exceptAll(tree.drop("place")).count() == 0 and tree.drop("place").exceptAll(again.drop("place")).count() == 0
