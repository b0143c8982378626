"""Readers and the reconciling sink on small files."""

import json

import pytest

from corvane.sources import readers, sinks


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"uuid": "x", "name": "N"}, {"uuid": "y", "name": None}]))
    (tmp_path / "b.json").write_text(json.dumps({"uuid": "z", "name": "M"}))
    assert sorted(r.uuid for r in readers.json_records(spark, str(tmp_path), "uuid string, name string").collect()) == ["x", "y", "z"]


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"n": 1}\n\n{"n": 2}\n{"n": ')
    (tmp_path / "b.jsonl").write_text('{"n": 1}\n{"n"\n{"n": 3}\n')
    found = sorted((r.file[-7:], r.block, r.line_id, r.state) for r in readers.json_lines(spark, str(tmp_path)).collect())
    assert [(f, s) for f, _, _, s in found] == [("a.jsonl", "record"), ("a.jsonl", "record"), ("a.jsonl", "truncated"), ("b.jsonl", "record"), ("b.jsonl", "fault"), ("b.jsonl", "record")]


def test_csv_strict(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n1,x\n")
    (tmp_path / "bad.csv").write_text("a,b\n1,x,y\n")
    assert readers.csv_strict(spark, str(tmp_path / "good.csv"), "a int, b string").collect() == [(1, "x")]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.csv_strict(spark, str(tmp_path / "bad.csv"), "a int, b string").collect()


def test_alias_lists(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# note\nturn = step, move # two\n\nplain\n")
    assert [tuple(r) for r in readers.alias_lists(spark, str(tmp_path / "list.txt")).collect()] == [("turn", ["step", "move"]), ("plain", [])]


def test_paired(spark):
    files = spark.createDataFrame([("d/data-1.zip",), ("d/manifest-1.json",), ("d/data-2.zip",), ("d/manifest-3.json",), ("d/other",)], "path string")
    found = readers.paired(files, "data-*.zip", "manifest-*.json").orderBy("star").collect()
    assert [tuple(r) for r in found] == [("1", "d/data-1.zip", "d/manifest-1.json", None), ("2", "d/data-2.zip", None, "record"), ("3", None, "d/manifest-3.json", "datum")]


def test_actions(spark):
    row = "name string, identity string, digest string"
    held = spark.createDataFrame([("a", "1", "p"), ("b", "2", "q"), ("c", "3", "r"), ("e", "5", "t")], row)
    wanted = spark.createDataFrame([("a", "1", "p"), ("b2", "2", "q"), ("d", "4", "s"), ("e", "5", "u")], row)
    assert {(r.name, r.action) for r in sinks.actions(held, wanted).collect()} == {("a", "unchanged"), ("b2", "renamed"), ("c", "pruned"), ("d", "written"), ("e", "written")}


def test_markdown_corpus_is_scanned_in_order(spark, tmp_path):
    from corvane.sources import corpus

    uuid = "01234567-89ab-cdef-0123-456789abcdef"
    texts = {
        "zeta/chat/conversations/02-b.md": f"---\nuuid: {uuid}\n---\n# Second\n\n## Human (1)\n\nhi\n\n---\n\n## Claude (1)\n\nyes\n\n---\n", "zeta/chat/conversations/01-a b.md": "# First\n\n<https://x.org/app/abc?q>\n",
        "alpha/code/conversations/01-c.md": "# Code\n<https://x.org/app/c1>\n", "beta/chat/conversations/07-d+e.md": "# Last\n<https://x.org/d>\n", "zeta/chat/conversations/none.md": "# No number\n<https://x.org/n>\n",
        "zeta/chat/conversations/03-no-title.md": "<https://x.org/t>\n", "zeta/chat/conversations/04-late.md": "x" * 700 + "\n# Late\n<https://x.org/l>\n", "index.md": "# Index\n<https://x.org/i>\n", "zeta/chat/conversations/05-x.txt": "# Other\n",
    }
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    files = corpus.markdown_files(spark, str(tmp_path))
    found = corpus.index(files, "zeta")
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, "zeta/chat/01-a b", "First", "abc"), (2, "zeta/chat/02-b", "Second", uuid), (3, "alpha/code/01-c", "Code", "c1"), (4, "beta/chat/07-d+e", "Last", "d")]
    assert {r.ordinal: r.line for r in corpus.listing(found).collect()}[3] == "3: Code"
    turns = corpus.book(files).collect()
    assert {(r.source, r.stem) for r in turns} == {("zeta", "02-b")} and len(turns) == 2
