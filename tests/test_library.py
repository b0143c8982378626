"""Odd rows of the library and audit operators: nulls, ties, repeats, empty tables."""

from pyspark.sql import functions as F

from corvane.operators import audit, library

AUDIT = "chat int, chat_name string, source string, path string, in_dl string, dl_compare string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_audit_odd_rows(spark):
    df = spark.createDataFrame([(1, "a", "tooltip", None, None, None), (1, "a", "ef", None, "Y", None), (1, "a", "ef", "p", None, None), (1, "a", "tooltip", "p", None, None), (1, "a", "tooltip", "q", None, None), (1, "a", "tooltip", "q", None, None)], AUDIT)
    assert rows(audit.without_twin(audit.shown(df), audit.on_disk(df)).select("path")) == [("q",), ("q",), (None,)]
    assert rows(audit.without_twin(audit.on_disk(df), audit.shown(df)).select("path")) == [(None,)]
    assert rows(audit.tally(df, ["ef"], "in_dl", {"downloaded": "Y", "copied": "N"})) == [(1, "a", 2, 1, 0)]
    assert rows(audit.tally(df.limit(0), ["ef"], "in_dl", {"downloaded": "Y"})) == []


def test_folders(spark):
    chats = spark.createDataFrame([(2, "aaaaaaaa-1"), (1, "aaaaaaaa-2"), (3, "bbbbbbbb-1"), (4, None)], "chat int, uuid string")
    folders = spark.createDataFrame([("bbbbbbbb-x-aaaaaaaa",), ("bbbbbbbb-x",), ("",), (None,)], "folder string")
    assert rows(library.resolved_folders(folders, chats)) == sorted([("bbbbbbbb-x-aaaaaaaa", 1, "suffix"), ("bbbbbbbb-x", 3, "prefix"), ("", None, "unknown"), (None, None, "unknown")], key=repr)


def test_segments(spark):
    said = ["hi", "", "Sig a", "", "Sig b", "next", "more", None, "Sig c", "Sig d"]
    lines = spark.createDataFrame([(1, i, s) for i, s in enumerate(said)], "k int, i int, s string")
    assert rows(library.segments(lines, "k", "i", "s", F.col("s").startswith("Sig"))) == [(1, 0, 0, 4, 2), (1, 1, 5, 9, 2)]


def test_odd_and_empty(spark):
    exports = spark.createDataFrame([(1, None), (2, "no"), (3, "[]"), (4, '[{"uuid": "", "chat_messages": []}, {"uuid": "u", "chat_messages": []}]')], "k int, a string")
    assert rows(library.atomised(exports, "k", "a").select("k", "place", "valid")) == [(4, 0, False), (4, 1, True)]
    pairs = spark.createDataFrame([("d", "r", None, None), (None, None, None, None), ("d", "r", ["x"], None)], "datum string, record string, categories array<string>, members array<string>")
    assert rows(library.pair_census(pairs)) == [("complete", 1), ("incomplete", 1), ("no datum", 1)]
    names = spark.createDataFrame([("g", n) for n in ["e", "d", "c", "b", "a", "a", None]], "g string, n string")
    assert rows(library.first_shown(names, "g", "n")) == [("g", "a, b, c, d, …")]
    assert rows(library.first_shown(names.where("n > 'a'"), "g", "n")) == [("g", "b, c, d, e")]
    listing = spark.createDataFrame([(7, 1), (9, 5)], "id int, place long")
    found = library.listed_first(spark.createDataFrame([(7,), (3,), (4,)], "id int"), listing, "id", F.lit(0))
    assert rows(found) == [(3, 6), (4, 7), (7, 1)]
    assert rows(library.listed_first(listing.select("id").limit(0), listing, "id", F.lit(0))) == []
