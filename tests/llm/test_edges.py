"""Rows that are odd in the columns beside the text: missing and repeated ids, names that clash with results, foreign archives."""

import hashlib
import io
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest

from corvane.llm import decontaminate, html_text, pii, quality, rules, simhash, warc
from test_operators import LONG, SF


def test_warc_reads_archives_in_as_many_tasks(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").repartition(6)
    back = warc.round_trip(pages)
    assert back.rdd.getNumPartitions() == 6 and back.count() == pages.count()


def foreign(fields, block):
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(f"WARC/1.0\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n") + pack.flush()


def test_warc_of_other_writers(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nhello"
    good = hashlib.sha1(b"hello").hexdigest()
    records = [
        foreign({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:uuid:0>"}, b"software: x"),
        foreign({"warc-type": "response", "WARC-record-id": "<urn:uuid:1>", "WARC-Target-URI": "<http://a.b/\r\n c>", "content-type": "application/http;\r\n\tmsgtype=response", "WARC-Payload-Digest": f"SHA1:{good}"}, body),
        foreign({"WARC-Type": "resource", "WARC-Record-ID": "<urn:uuid:2>", "WARC-Payload-Digest": "blake9:zz"}, b"plain"),
        foreign({"WARC-Type": "revisit", "WARC-Record-ID": "<urn:uuid:3>", "WARC-Refers-To": "<urn:uuid:1>", "Content-Type": "application/http"}, b"HTTP/1.1 200 OK\r\n\r\n"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(records))
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.warc.gz", "empty.warc.gz")], "path string")
    got = {r.record_id: r for r in warc.read(paths, str(tmp_path)).collect()}
    assert set(got) == {"urn:uuid:1", "urn:uuid:2", "urn:uuid:3"} and all(r.page_id is None and r.refers_to is None for r in got.values())
    assert (bytes(got["urn:uuid:1"].payload), got["urn:uuid:1"].url, got["urn:uuid:1"].payload_bytes) == (b"hello", "http://a.b/ c", 5)
    assert bytes(got["urn:uuid:2"].payload) == b"plain" and got["urn:uuid:3"].payload is None
    fields, block = warc.parse(next(warc.members(io.BytesIO(records[1]))))
    with pytest.raises(ValueError):
        warc.page_of(fields, block.replace(b"hello", b"hullo"))


def test_keep_one_judges_rows_by_their_own_text(spark):
    other = "completely different words stand here and no other text holds any of these at all"
    rows = [
        (5, LONG, 1), (5, other, 2), (7, LONG + "x", 3), (None, LONG, 4), (None, LONG + "y", 5), (None, "only here without a name are these few words to be seen by us", 6),
        (None, "only here without a name are these few words to be seen by us", 7), (9, other, 8), (5, LONG, 1), (11, None, 9), (12, "", 10), (13, " ", 11),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(simhash.keep_one(docs).collect(), key=lambda r: r.fp)
    assert docs.columns == simhash.keep_one(docs).columns
    assert [(r.doc_id, r.text) for r in got if r.doc_id is not None] == [(5, LONG), (5, other), (11, None)]
    assert sorted(r.fp for r in got if r.doc_id is None) in ([6], [7])
    odd = docs.selectExpr("doc_id", "text", "map('a', fp) as root", "named_struct('x', fp) as row", "array(fp) as text_key", "cast(null as binary) as row_key")
    assert simhash.keep_one(odd).count() == len(got) and simhash.keep_one(odd).schema == odd.schema
    assert simhash.keep_one(docs.where("false")).count() == 0


def test_hot_buckets_are_divided(spark):
    base = 0x0123456789ABCDEF
    prints = sorted({base ^ (1 << a) ^ (1 << b) ^ (1 << c) for a in range(0, 64, 3) for b in range(a, 64, 5) for c in range(b, 64, 7)})
    prints = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(prints)), "id long, fp long")
    whole = {(r.node.fp, r.root.fp) for r in simhash.components(simhash.near_links(df, 4, 1 << 20)).collect()}
    for block in (8, 64):
        assert {(r.node.fp, r.root.fp) for r in simhash.components(simhash.near_links(df, 4, block)).collect()} == whole
    assert len(whole) == len(prints) - 1


def clashing(docs):
    """The rows with further columns that bear the names operators use for their own."""
    extra = "email phone card ip iban base spans score row rows text_ fp root held_out kept words_ key data".split()
    return docs.selectExpr("doc_id", "text", *[f"named_struct('{n}', 1) as {n}" for n in extra])


def test_stages_keep_rows_and_columns_as_they_are(spark):
    item = "the quick brown fox jumps over the lazy dog near a river bank at dawn"
    rows = [(None, None), (None, ""), (1, item), (None, f"so {item} it is"), (1, LONG), (1, LONG), (2, "a@b.co " * 3 + "x" * 200_000), (3, "\x00 😀".encode("utf-16", "surrogatepass").decode("utf-16"))]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    bench = spark.createDataFrame([(1, item), (None, LONG), (2, None)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, 0), (3, None)], "doc_id long, quality int")
    left = decontaminate.clean(docs, bench)
    assert left.schema == docs.schema and sorted(map(repr, (r.text for r in left.collect()))) == sorted(repr(t) for _, t in rows if item not in (t or ""))
    good = quality.keep_good(docs, labels)
    assert good.schema == docs.schema and good.count() == quality.score(docs, labels).where("predicted = 1").count()
    redacted = pii.redact(docs)
    assert redacted.schema == docs.schema and redacted.count() == len(rows)
    assert {r.base for r in redacted.collect()} == {r.base for r in docs.collect()}
    for stage in (lambda d: decontaminate.clean(d, bench), lambda d: quality.keep_good(d, labels), pii.redact, simhash.keep_one, rules.keep):
        assert stage(docs.where("false")).count() == 0
    assert decontaminate.clean(docs, bench.where("false")).count() == len(rows)


def test_alignment_of_very_long_items():
    rng = np.random.default_rng(1)
    item = rng.integers(0, 5000, 8000).astype(np.int32)
    text = np.concatenate([rng.integers(5000, 9000, 3000), np.delete(item, np.arange(5, 8000, 9)), rng.integers(5000, 9000, 3000)]).astype(np.int32)
    score, matched, start, end = decontaminate.align(item, text)
    assert (matched, start, end) == (8000 - len(range(5, 8000, 9)), 3000, len(text) - 3000)


def test_planted_edits_are_found(spark):
    """Copies with words replaced, left out and put in between at random: all whose best alignment keeps 0.8 of the item's words, and over 0.9 of all planted."""
    rng = random.Random(4)
    items = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(8, 60))] for _ in range(40)]
    texts, want = [], set()
    for d in range(400):
        k = rng.randrange(len(items))
        words = list(items[k])
        for at in rng.sample(range(len(words)), rng.randrange(0, len(words) // 5 + 1)):
            words[at] = rng.choice(["", f"x{rng.randrange(99)}"])
        words = [x for w in words for x in ([w, f"y{rng.randrange(99)}"] if rng.random() < 0.2 else [w]) if x]
        texts.append((d, " ".join([f"z{rng.randrange(99)}" for _ in range(20)] + words + ["end"])))
        want.add((d, k))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    codes = defaultdict(lambda: len(codes))
    coded = [np.array([codes[x] for x in w]) for w in items]
    plain = [np.array([codes[x] for x in t.split()]) for _, t in texts]
    assert found == {(d, k) for d, t in enumerate(plain) for k, w in enumerate(coded) if decontaminate.align(w, t)[1] >= 0.8 * len(w)}
    recall = len(want & found) / len(want)
    print("recall of planted edits", recall)
    assert recall > 0.9
    assert found == {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench, block_chars=500).collect()}


#: Planted data in phrases that the labelled table does not hold: (before, kind or None, value, after).
PLANTED = [
    ("You can telephone ", "local_phone", "(415) 555-2671", " on weekdays"), ("Mobile number ", "local_phone", "06 12 34 56 78", ""), ("Her telephone: ", "local_phone", "030 1234 5678", "!"), ("Telefonisch: ", "local_phone", "0171 2345678", " oder Mail"),
    ("por teléfono al ", "local_phone", "912 345 678", " hoy"), ("to cancel, call ", "local_phone", "212-555-0175", " now"), ("His social security no ", "national_id", "219-09-9999", " leaked"), ("su DNI es ", "national_id", "12345678-Z", ""),
    ("The IBAN of the shop is ", "iban", "DE89 3704 0044 0532 0130 00", "."), ("mi cuenta bancaria: ", "iban", "ES9121000418450200051332", ""), ("email ", "spelled_email", "jo (at) shop (dot) org", ""), ("contact us: ", "spelled_email", "press[at]team.example.net", " please"),
    ("She was born on ", "birth_date", "14.03.1985", " in Bonn"), ("geboren: ", "birth_date", "3.4.1977", ""), ("date of birth ", "birth_date", "1990-12-24", ","), ('export SECRET_KEY="', "secret", "9f8e7d6c5b4a39281706f5e4d3c2b1a0", '"'),
    ("the api token is ", "secret", "q7Xc9PzL2mN8vB4kT6wR1sYd", "."), ("password=", "secret", "hunter2hunter2x", " for all"), ("Bearer ", "secret", "eyJhbGciOi9x8y7z6w5v4u3t2s1r", ""),
    ("Order number ", None, "415 555 2671", " has shipped"), ("pages ", None, "100-200-3000", " of the book"), ("The sum of ", None, "12 345 678", " euros"), ("commit ", None, "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", " fixes it"),
    ("released on ", None, "14.03.2015", " worldwide"), ("version ", None, "10.12.20", " is out"), ("see http://example.org/", None, "a1b2c3d4e5f6a7b8c9d0e1f2", ""), ("model ", None, "AB12CDEFGHIJKLMNOPQR", " in blue"),
    ("isbn ", None, "978-3-1614-8410", ""), ("they met (at) noon. Then ", None, "", "left"), ("part ", None, "321-12-4567", " in stock"), ("between ", None, "1990-12-24", " and later"), ("file ", None, "report_2019_final_v2_draft7", ".pdf"), ("rows ", None, "200 300 4000", " were read"),
    ("Rechnung ", None, "0171 2345678", " vom Mai"), ("sha256 ", None, "9f8e7d6c5b4a39281706f5e4d3c2b1a0", ""), ("pedido ", None, "912 345 678", ""), ("in 2019 about ", None, "1 250 000", " people"),
]


def test_added_spans_on_planted_data(spark):
    docs = spark.createDataFrame([(i, b + v + a) for i, (b, _, v, a) in enumerate(PLANTED)], "doc_id long, text string")
    got = {r.doc_id: set(filter(None, r.spans.split(","))) for r in pii.digest(docs).collect()}
    want = {i: {f"{k}:{len(b)}:{len(b) + len(v)}"} if k else set() for i, (b, k, v, _) in enumerate(PLANTED)}
    hits, said, planted = (sum(len(x) for x in y) for y in ([got[i] & want[i] for i in got], got.values(), want.values()))
    print("added spans: precision", hits / said, "recall", hits / planted, "of", planted)
    assert hits / said >= 0.85 and hits / planted >= 0.85, [(PLANTED[i], got[i]) for i in got if got[i] != want[i]]


def test_very_many_spans(spark):
    text = " ".join(f"a{i}@b.co 10.0.0.{i % 256}" for i in range(6_000))
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    began = time.perf_counter()
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean == {1: " ".join(["[EMAIL] [IP]"] * 6_000), 2: None} and time.perf_counter() - began < 60
    assert [(r.n_email, r.n_ip) for r in pii.digest(docs).orderBy("doc_id").collect()] == [(6_000, 6_000), (0, 0)]


P = "The harbour was quiet that morning and only two boats went out before the bells of the old church rang nine times over the roofs."
Q = "Nobody in the town remembered such a winter, and those who did would not speak of it while the children could hear them talk."
#: Pages of different layouts with their main text, read by hand.
LAYOUTS = [
    (f"<body><header><a href=/>Site</a></header><nav><a href=a>One</a> <a href=b>Two</a></nav><main><h1>Winter</h1><p>{P}</p><p>{Q}</p></main><footer>All rights reserved</footer>", f"Winter {P} {Q}"),
    (f"<div id='nav-main'><a href=a>One</a></div><div class='entry'><h2>Winter</h2><div>{P}</div><div>{Q} <a href=x>More here</a></div></div><div class='sidebar'><h3>Also</h3><p>{P}</p></div>", f"Winter {P} {Q} More here"),
    (f"<article class='post'><h1>Winter</h1><p>{P}</p><p><a href=x>see the full report here</a></p><p>{Q}</p><section class='comments'><article class=comment><p>Lovely, thank you so much for it!</p></article></section></article>", f"Winter {P} see the full report here {Q}"),
    (f"<h1>Winter</h1>\n{P}<br>{Q}<p>End.</p><div class='ad-banner'>Buy boats now, cheap boats for all</div><script>var x = '<p>no</p>';</script>", f"Winter {P} {Q} End."),
    (f"<main><article><h1>Winter</h1><p>{P}</p><p>{Q}</p><p>{P}</p></article><article class='teaser'><h3><a href=x>Summer</a></h3><p>Short words.</p></article></main>", f"Winter {P} {Q} {P}"),
    (f"<div class='cookie-notice'>We use cookies on this page, do you agree?</div><div><p>{P}</p><ul><li>first thing of all<li>second thing after it</ul><p>{Q}</p></div><form>Your mail <input name=m></form>", f"{P} first thing of all second thing after it {Q}"),
    (f"<div class='share-content'><p>{P}</p></div><div class='related-work'><p>{Q}</p></div><p><a href=/it's>Not lost</a> &amp; don't say it {Q}</p>", f"{P} {Q} Not lost & don't say it {Q}"),
]


def test_html_layouts():
    tree = html_text.trained()
    assert [html_text.main_text(p, tree) for p, _ in LAYOUTS] == [t for _, t in LAYOUTS]


def test_html_tree_on_variants_it_has_not_seen():
    x, y = html_text.labelled(variants=6, seed=77)
    right = np.mean([html_text.trained().says(tuple(r)) == bool(v) for r, v in zip(x, y, strict=True)])
    print("blocks of unseen variants told right", right)
    assert right > 0.95


@pytest.mark.parametrize("piece", ["<a ", '<a href="', "<p>x<select>", "<div>", "</div>", "<li>", "<!--", "<p><a href=x>", "<x y='", "<ul><li>", "<", "&", "<svg>", "<style"])
def test_html_is_linear_in_hostile_pages(piece):
    began = time.perf_counter()
    html_text.main_text(piece * (600_000 // len(piece)), html_text.trained())
    assert time.perf_counter() - began < 15
