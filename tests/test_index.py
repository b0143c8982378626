"""Headword locators against a plain search of every text for every headword."""

from corvane.operators import index

TEXTS = ["the cat sat", "concatenate two words", "hot dogs and a hotdog", "one two three four five six seven eight nine", "", None, "zebra"]
HEADS = ["cat", "hot dog", "two", "two words", "three four five", "one two three four five six seven", "no such", "missing", "o", " ", "wo three four fi", "", "ca", "hot dogs", "s and", "gs a", "  ", None]


def test_locators_of_heads_of_any_length(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (3, TEXTS[3])], "doc_id long, text string")
    heads = spark.createDataFrame(list(enumerate(HEADS)), "item_id long, text string")
    want = sorted((k, i) for k, h in enumerate(HEADS) for i, t in [*enumerate(TEXTS), (3, TEXTS[3])] if None not in (h, t) and h in t)
    found = index.locators(docs, heads)
    assert sorted((r.item_id, r.doc_id) for r in found.collect()) == want
    assert "CartesianProduct" not in (plan := found._jdf.queryExecution().toString()) and "NestedLoop" not in plan
    assert {r.item_id for r in index.orphans(heads, found).collect()} == set(range(len(HEADS))) - {k for k, _ in want}


def test_uncovered_words_of_all_languages(spark):
    docs = spark.createDataFrame([(1, "well-known harbour and swell", "en"), (2, "harbour maison maison Noise", "fr"), (3, "maison wellness", "de"), (4, None, "en")], "doc_id long, text string, lang string")
    heads = spark.createDataFrame([("Well",), ("two words",), (None,)], "text string")
    rejected = spark.createDataFrame([("noise",), (None,)], "text string")
    found = [tuple(r) for r in index.uncovered(docs, heads, rejected).collect()]
    assert found == [("maison", 2, 3), ("harbour", 2, 2), ("swell", 1, 1), ("wellness", 1, 1)]
    assert index.uncovered(docs, heads.where("false"), rejected.where("false")).count() == 6


def test_advisory_words_have_four_letters_and_no_marks_at_their_ends(spark):
    docs = spark.createDataFrame([(1, "zebra- Zebra 'zebra fox foxes well-known don\u2019t don't a--- x"), (2, "foxes \u2019zebra\u2019s unknown Known-well"), (3, None)], "doc_id long, text string")
    heads, rejected, stop = (spark.createDataFrame([(w,) for w in words], f"{name} string") for words, name in ((["Known"], "text"), (["FOXES"], "text"), (["don't"], "word")))
    found = {r.word: (r.docs, r["count"]) for r in index.advisory(docs, heads, rejected, stop).collect()}
    assert found == {"zebra": (1, 3), "zebra\u2019s": (1, 1), "unknown": (1, 1), "don\u2019t": (1, 1), "a": (1, 1)}
