"""Node tables against a plain walk, rules on the union cases, walks over references against plain search."""

import json

import pytest
from pyspark.sql import functions as F

from corvane.operators import nodes, schemas
from corvane.session import weighed

RECORDS = [
    {"type": "c"}, {"type": "b", "y": 1}, {"type": "t", "content": [{"type": "x"}, {"type": "z"}]}, {"type": "t", "content": [], "a/b": {"k~": [[], [None, 1.5, True]]}}, {"type": "b", "y": 1, "z": -2}, 7, [],
]
TEXTS = [*[json.dumps(r) for r in RECORDS], None, "", "no json", '{"a":1,"a":2}', json.dumps({"text": "x" * 100_000})]
KIND = {dict: "object", list: "array", str: "string", int: "integer", float: "number", bool: "boolean", type(None): "null"}


def walk(value, pointer="", pattern=""):
    yield pointer, pattern, KIND[type(value)], None if isinstance(value, (dict, list)) else value
    for step, inner in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else []:
        word = str(step).replace("~", "~0").replace("/", "~1")
        yield from walk(inner, f"{pointer}/{word}", f"{pattern}/{'*' if isinstance(value, list) else word}")


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, "other", "other") for i, t in enumerate(TEXTS)], "doc long, text string, v string, value string")


@pytest.fixture
def tree(docs):
    return nodes.nodes(docs)


def test_nodes_equal_a_plain_walk(tree):
    want = [(i, p, q, k, None if v is None else str(v).lower() if isinstance(v, bool) else str(v)) for i, t in enumerate(TEXTS) if i not in (7, 8, 9) for p, q, k, v in walk(json.loads(t))]
    assert sorted(map(repr, want)) == sorted(repr((r.doc, r.pointer, r.pattern, r.kind, r.value)) for r in tree.collect())
    assert {(r.doc, r.value) for r in nodes.strings(tree).where("doc < 3").collect()} == {(0, "c"), (1, "b"), (2, "t"), (2, "x"), (2, "z")}


def test_long_integers_and_repeated_keys(spark):
    tree = nodes.nodes(spark.createDataFrame([(1, '{"n":' + "9" * 25 + ',"k":1,"k":[2]}'), (2, "1.0"), (3, '"\\ud800"')], "doc long, text string"))
    assert {(r.doc, r.pointer): (r.kind, r.value) for r in tree.where("pointer <> '' or doc > 1").collect()} == {
        (1, "/n"): ("integer", "9" * 25), (1, "/k"): ("array", None), (1, "/k/0"): ("integer", "2"), (2, ""): ("number", "1.0"), (3, ""): ("string", "?")}
    assert [r.pointer for r in tree.where("doc = 1").orderBy("place").collect()] == ["", "/n", "/k", "/k/0"]


def test_empty_and_repeated_documents(spark, docs):
    assert nodes.nodes(docs.where("false")).count() == 0
    assert nodes.nodes(docs.where("doc = 1").union(docs.where("doc = 1"))).count() == 6
    odd = nodes.nodes(spark.createDataFrame([(None, '{"a":1}')], "doc long, text string"))
    assert sorted((r.doc, r.pointer) for r in odd.collect()) == [(None, ""), (None, "/a")]


def test_pointers_and_claims(spark, tree):
    asked = spark.createDataFrame([(3, "/a~1b/k~0/1/1"), (3, "/a/b"), (5, ""), (99, "")], "doc long, pointer string")
    assert {(r.doc, r.pointer): r.kind for r in nodes.resolved(tree, asked).collect()} == {(3, "/a~1b/k~0/1/1"): "number", (3, "/a/b"): None, (5, ""): "integer", (99, ""): None}
    claims = spark.createDataFrame([("/y",), ("/content/*",), ("/none",)], "pattern string")
    assert [tuple(r) for r in nodes.falsified(tree, claims).collect()] == [("/y", 1, "1")]
    assert {(r.doc, r.pointer) for r in nodes.at_patterns(tree, claims).where("pattern = '/content/*'").collect()} == {(2, "/content/0"), (2, "/content/1")}


def test_verdicts_name_the_union(spark, docs, tree):
    rules = spark.createDataFrame(
        [("/type", "union", ["a", "b", "t"]), ("/content/*/type", "union", ["x", "y"]), ("", "type", ["object"]), ("/z", "minimum", ["0"]), ("", "closed", ["type", "y", "z", "content", "text"]), ("", "required", ["type"]), ("", "odd", ["q"])],
        "pattern string, rule string, arg array<string>",
    )
    said = {r.doc: (r.valid, r.pointer, r.said) for r in nodes.verdicts(docs, tree, nodes.faults(tree, rules)).collect()}
    assert said == {
        0: (False, "/type", "'c' is not a type the union declares: a, b, t"), 1: (True, None, None), 2: (False, "/content/1/type", "'z' is not a type the union declares: x, y"),
        3: (False, "", "'a~1b' was unexpected"), 4: (False, "/z", "-2 is less than the minimum of 0"), 5: (False, "", "7 is not of type object"), 6: (False, "", "array is not of type object"),
        7: (False, None, "no JSON"), 8: (False, None, "no JSON"), 9: (False, None, "no JSON"), 10: (False, "", "'a' was unexpected"), 11: (False, "", "'type' is a required property"),
    }
    assert nodes.faults(tree, rules.where("false")).count() == 0


def test_restrictions_leave_annotations_out(spark):
    texts = ['{"type":"object","title":"one","properties":{"a":{"enum":[1]}}}', '{"properties":{"a":{"enum":[1],"description":{"x":1}}},"type":"object"}', '{"type":"object","properties":{"a":{"enum":[2]}}}', '{"type":"object","properties":{"a":{"enum":[1],"minimum":1},"b":{"$ref":"#/definitions/X"}}}']
    tree = nodes.nodes(spark.createDataFrame(list(enumerate(texts)), "doc long, text string"))
    moves = schemas.grammar(nodes.nodes(spark.createDataFrame([("meta", schemas.META_SCHEMA)], "doc string, text string"))).persist()
    digest = {r.doc: r.digest for r in schemas.restriction_digests(tree, moves).collect()}
    assert digest[0] == digest[1] and len(set(digest.values())) == 3
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (3, 0)], "base long, refined long")
    assert {tuple(r) for r in schemas.unrefined(tree, pairs, moves).collect()} == {(0, 2, "/properties/a/enum/0"), (3, 0, "/properties/a/minimum"), (3, 0, "/properties/b"), (3, 0, "/properties/b/$ref")}
    assert [tuple(r) for r in nodes.references(tree).collect()] == [("#/definitions/X", "/properties/b", 1)]
    named = nodes.nodes(spark.createDataFrame([(k, '{"properties":{"id":{"type":"%s"}}}' % kind) for k, kind in enumerate(["string", "integer"])], "doc long, text string"))
    assert len({r.digest for r in schemas.restriction_digests(named, moves).collect()}) == 2
    assert [tuple(r) for r in schemas.unrefined(named, spark.createDataFrame([(0, 1)], "base long, refined long"), moves).collect()] == [(0, 1, "/properties/id/type")]


def test_walks_with_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (1, 3), (3, 4), (4, None), (None, 5), (6, 7), (1, 2)], "source long, target long")
    roots = spark.createDataFrame([(1,), (1,), (None,)], "node long")
    assert sorted(tuple(r) for r in nodes.reached(edges, roots).collect()) == [(1, 0), (2, 1), (3, 1), (4, 2)]
    assert nodes.reached(edges, roots.where("false")).count() == 0
    chain = [(i, i - 1 if i > 1 else None) for i in range(1, 40)] + [(50, 51), (51, 50), (60, 99)]
    parents = spark.createDataFrame(chain, "node long, up long")
    placed = spark.createDataFrame([(2, "two"), (20, "x"), (20, "twenty")], "node long, layer string")
    assert {r.node: r.layer for r in nodes.nearest(parents, placed).collect()} == {i: None if i in (1, 50, 51, 60) else "two" if i < 20 else "twenty" for i, _ in chain}


def test_texts_of_one_file_are_read_by_many_tasks(spark):
    docs = spark.createDataFrame([(i, '{"a":[1,{"b":"\\ud800"}]}') for i in range(64)], "doc long, text string").coalesce(1)
    tree = nodes.nodes(docs)
    assert tree.rdd.getNumPartitions() > 1
    assert {(r.pointer, r.value) for r in tree.collect()} == {("", None), ("/a", None), ("/a/0", "1"), ("/a/1", None), ("/a/1/b", "?")} and tree.count() == 320


def test_node_tables_are_never_broadcast_by_the_size_of_their_files(spark):
    """A few bytes of texts are many nodes: the plan joins them by sorting."""
    docs = spark.range(3000).selectExpr("id as doc", """'{"a":1,"b":[]}' as text""")
    tree = weighed(nodes.nodes(docs))
    plan = tree.join(tree.selectExpr("doc as d", "pointer as p"), F.expr("doc = d and pointer = p"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "BroadcastHashJoin" in tree.join(weighed(spark.range(3).toDF("d")), F.expr("doc = d"))._jdf.queryExecution().executedPlan().toString()
