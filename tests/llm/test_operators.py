"""Each training-data operator against a plain version of its contract, on the smallest tables and on odd rows."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from corvane.llm import byte_bpe, chat, decontaminate, html_text, pii, quality, queries, rules, simhash, suffixes, warc
from corvane.llm.components import components

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
LONG = "the old man saw the grey sea and wrote 12 lines, " * 400
ODD = [None, "", " ", "a", "A a A a", LONG, LONG, "x" * 5000, "café \U0001f600 你好\n\n\n  tabs\there", "a@b.co +1 (212) 555-0134 1.2.3.4 4111 1111 1111 1111", "  \x1c\x1d\x00|", "line\nline\nline\n" * 30]


def rows(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def texts():
    return [(r["doc_id"], r["text"]) for r in rows("documents")] + [(10_000 + i, t) for i, t in enumerate(ODD)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    df = spark.createDataFrame([(i, t, "en", "web", -1, True) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long, key boolean")
    return df.repartition(5)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_suffix_dedup(docs, texts, none):
    n, seen = 200, Counter()
    data = {i: (t or "").encode() for i, t in texts}
    for x in data.values():
        seen.update(x[p : p + n] for p in range(len(x) - n + 1))
    want = {}
    for i, x in data.items():
        gone = np.zeros(len(x) + 1, bool)
        for p in range(len(x) - n + 1):
            if seen[x[p : p + n]] > 1:
                gone[p : p + n] = True
        spans = int(((gone[1:] != gone[:-1]).sum() + gone[0]) // 2)
        kept = bytes(b for b, g in zip(x, gone, strict=False) if not g)
        want[i] = (len(x), len(x) - len(kept), spans, sha(kept))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.digest(docs).collect()}
    assert got == want
    assert sum(w[1] > 0 for w in want.values()) > 5
    assert suffixes.digest(none).count() == 0


def plain_align(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best


def test_alignment_score():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 20))
        score, matched, start, end = decontaminate.align(a, b)
        assert score == plain_align(a.tolist(), b.tolist())
        assert 0 <= start <= end <= len(b) and matched <= min(len(a), end - start)


def test_decontamination(spark, docs, texts, none):
    items = [(r["item_id"], r["text"]) for r in rows("benchmark")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items] + [(900, None, "x"), (None, "a b c d e f", "x"), (901, "", "x")], "item_id long, text string, lang string")
    passage = items[0][1].split()
    edited = " ".join(w for k, w in enumerate(passage) if k % 12 != 5)
    more = spark.createDataFrame([(20_000, f"before it {edited} after it"), (20_001, items[1][1].upper()), (20_002, items[1][1].upper())], "doc_id long, text string")
    small = docs.select("doc_id", "text").union(more)
    found = {(r.doc_id, r.item_id) for r in decontaminate.digest(small, bench).collect()}
    whole = {(i, k) for i, t in texts for k, b in items if b and b in (t or "")}
    assert whole | {(20_000, items[0][0]), (20_001, items[1][0]), (20_002, items[1][0])} <= found
    want = set()  # every document against every item, without seeds
    for i, t in [*texts, *[(r.doc_id, r.text) for r in more.collect()]]:
        words = decontaminate.words_of(t)
        for k, b in items:
            item = decontaminate.words_of(b)
            if len(set(words) & set(item)) >= 0.6 * len(set(item)):
                codes = {w: j for j, w in enumerate(set(item))}
                score, matched, _, _ = decontaminate.align(np.array([codes[w] for w in item]), np.array([codes.get(w, -1) for w in words]))
                if matched >= 0.8 * len(item):
                    want.add((i, k))
    assert found == want
    assert decontaminate.digest(none, bench).count() == 0
    assert decontaminate.digest(docs, bench.where("false")).count() == 0
    bad = {d for d, _ in found}
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {i for i, _ in texts} - bad


def test_quality(spark, docs, none):
    labels = {r["doc_id"]: r["quality"] for r in rows("labels", LARGER) if r["quality"] is not None}
    got = queries.op3_quality(spark, LARGER).collect()
    assert {r.doc_id: r.held_out for r in got} == {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows("documents", LARGER)}
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    table = spark.createDataFrame([(i, q) for i, q in labels.items()], "doc_id long, quality int")
    assert quality.score(none, table).count() == 0
    odd = quality.score(docs, table.where("false"))
    assert {r.score for r in odd.collect()} == {0.5}
    assert quality.keep_good(docs, table).columns == docs.columns


def plain_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=4):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash(docs, texts, none):
    prints = {i: plain_print(t) for i, t in texts}
    want = {i: (f"{prints[i]:016x}", c) for i, c in classes(prints).items()}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.digest(docs).collect()} == want
    assert simhash.digest(none).count() == 0
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == {c for _, c in want.values()}


def test_covering_finds_every_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(1 << 63), 1 << 63, 40)
    prints = set(base.tolist())
    for x in base.tolist():
        for k in range(1, 7):
            flips = sum(1 << int(b) for b in rng.choice(64, k, replace=False))
            y = (x ^ (flips - (1 << 64) if flips >> 63 else flips)) & ((1 << 64) - 1)
            prints.add(y - (1 << 64) if y >> 63 else y)
    hot = [int(base[0]) ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    prints |= set(hot)
    ids = sorted(prints)
    want = classes({i: x & ((1 << 64) - 1) for i, x in enumerate(ids)})
    df = spark.createDataFrame([(x, x) for x in ids], "id long, fp long")
    for block in (1024, 16):
        root = {r.node.fp: r.root.fp for r in components(simhash.near_links(df, 4, block)).collect()}
        got = defaultdict(set)
        for i, x in enumerate(ids):
            got[root.get(x, x)].add(i)
        groups = defaultdict(set)
        for i, c in want.items():
            groups[c].add(i)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_byte_bpe(spark, docs, texts, none):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, t in texts:
        ids = enc.encode_ordinary(t or "")
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha((t or "").encode()))
    vocabulary = queries.vocabulary(spark)
    for sizes in ({}, {"chunk": 97, "overlap": 24}):
        assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.digest(docs, vocabulary, **sizes).collect()} == want
    assert byte_bpe.digest(none, vocabulary).count() == 0


def test_warc(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in rows("pages")] + [(70_000, None, None), (70_001, "u v\n", ""), (70_002, "é", "same"), (69_999, "b", "same")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, payload int").repartition(4)
    first = {}
    for i, _, h in pages:
        first[h or ""] = min(i, first.get(h or "", i))
    want = {}
    for i, _, h in pages:
        data, ref = (h or "").encode(), first[h or ""]
        want[i] = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if ref == i else "revisit", None if ref == i else ref)
    got = warc.round_trip(df).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want
    assert {r.page_id: (r.url, bytes(r.payload)) for r in got if r.record_type == "response"} == {i: (u, (h or "").encode()) for i, u, h in pages if want[i][2] == "response"}
    assert warc.round_trip(df.where("false")).count() == 0


def test_warc_damage():
    record = warc.record(1, "u", b"payload", None, "2024-01-01T00:00:00Z")
    import io

    assert len(list(warc.members(io.BytesIO(record * 3), 10))) == 3
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(record[:-9])))
    whole = zlib.decompress(record, 31)
    with pytest.raises(ValueError):
        warc.parse(whole.replace(b"payload", b"Payload"))
    with pytest.raises(ValueError):
        warc.parse(whole[:-1])


def luhn(d):
    return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def plain_pii(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    }
    found = [(m.start(), k, kind, m.end()) for k, (kind, (p, ok)) in enumerate(checks.items()) for m in re.finditer(p, text or "") if ok(m[0])]
    return sorted(found)


def test_pii(docs, texts, none):
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    assert set(got) == {i for i, _ in texts}
    for i, t in texts:
        want = plain_pii(t)
        n = Counter(k for _, _, k, _ in want)
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == (n["email"], n["ip"], n["card"], n["phone"]), t
        assert got[i].base_sha256 == sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in want))
        assert {f"{k}:{s}:{e}" for s, _, k, e in want} <= set(got[i].spans.split(",")) | {""}
    assert pii.digest(none).count() == 0
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert "a@b.co" not in clean[10_009] and "[EMAIL]" in clean[10_009]
    assert all((clean[i] == t) == (got[i].spans == "") for i, t in texts)


@pytest.mark.parametrize("text", ["a@b.c.@d.e", "x@y.z_w@v.u", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1.1", "1 2 3 4 5 6 7 8 9 0 1 2 8", "+1+1 212 555 0134", "é a@b.c \U0001f600 a@b.c", "00001.2.3.4", "4111-1111 1111  1111 4111111111111111"])
def test_pii_edges(spark, text):
    r = pii.digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in plain_pii(text)))


def test_chat(spark):
    said = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows("conversations")]
    said += [(900, 1, "user", None), (900, 2, "tool[AS]", "x[/ROLE][PART]\\"), (901, None, None, "[INST]\\[INST]\\\\<s>"), (901, 0, "assistant", "a\\"), (901, 0, "assistant", "a\\"), (None, 0, "user", "lost")]
    said += [(902, 0, "user", LONG * 5), (902, 1, "user", "<</SYS>></s>")]
    df = spark.createDataFrame([(*r, 0) for r in said], "conv_id long, turn long, role string, text string, turns int").repartition(4)
    by = defaultdict(list)
    for c, t, r, x in [*said, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    want = {}
    for c, turns in by.items():
        loss = "".join(x for *_, r, x in sorted(turns) if r == "assistant")
        want[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in sorted(turns))), len(loss), sha(loss))
    got = chat.digest(df).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    assert chat.formatted(df.where("false")).count() == 0
    for r in chat.formatted(df).collect():
        assert r.formatted == "".join(s.text for s in r.segments)


def test_quality_rules(docs, texts, none):
    got = {r.doc_id: r for r in rules.digest(docs).collect()}
    for i, t in texts:
        t = t or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        n = Counter(windows)
        repeat = len({k + d for k, w in enumerate(windows) if n[w] > 1 for d in range(3)})
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base = len(words) < 50 or 100 * repeat > 50 * len(words)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat, base)
        assert not (r.kept and base)
    assert rules.digest(none).count() == 0


def test_cascade_order_never_changes_verdicts(docs):
    found = rules.rules()
    figures = rules.ordered(docs, found, sample=50)
    assert {r.name for r, _, _ in figures} == {r.name for r in found}
    rates = [s / max(t, 1e-6) for _, t, s in figures]
    assert rates == sorted(rates, reverse=True)
    kept = {r.doc_id for r in rules.digest(docs).where("kept").collect()}
    assert kept == {r.doc_id for r in rules.apply(docs, 7).where("kept").collect()} == {r.doc_id for r in rules.keep(docs).collect()}
    assert rules.keep(docs).columns == docs.columns and rules.keep(docs.where("false")).count() == 0


def test_html(spark):
    pages = spark.createDataFrame([(r["page_id"], r["url"], r["html"], "x") for r in rows("pages")] + [(1, None, None, "x"), (2, "u", "<p>", "x")], "page_id long, url string, html string, text string")
    got = html_text.digest(pages).collect()
    assert len(got) == len(rows("pages")) + 2
    for r in got:
        assert r.n_chars == len(r.text) and not re.search(r"\s\s|<script|^\s|\s$", r.text)
    assert html_text.digest(pages.where("false")).count() == 0
    page = "<body><nav><a href=x>Home</a></nav><div class='cookie notice'>We use cookies</div><article><h1>A &amp; B</h1><p>One <b>two</b>\n three.<p>Four.</article><div class=comments><p>Nice!</p></div><footer>(c)</footer>"
    one = spark.createDataFrame([(3, "u", page)], "page_id long, url string, html string")
    assert html_text.digest(one).first().text == "A & B One two three. Four."


def test_pipeline(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    text = {r["doc_id"]: r["text"] for r in rows("documents")}
    good = {r.doc_id for r in quality.score(docs, labels).where("predicted = 1").collect()}
    one = set(classes({i: plain_print(text[i]) for i in good}).values())
    leak = {r.doc_id for r in decontaminate.leaks(docs, bench).collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == one - leak and len(got) == len(one - leak)
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert all(bytes(r.decoded).decode() == clean[r.doc_id] for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.where("false"), SF).columns == docs.columns


def test_html_side_content_by_name_and_open_tags():
    """Named paragraphs, list items and cells are left out alone; tags without an end close where HTML says so."""
    tree, long_ = html_text.trained(), " ".join(["word"] * 30)
    page = f'<body class="no-sidebar"><main><h1>T</h1><p>{long_}<p class="notice">N<p>a<ul><li>b<li class=ad>X<li>c</ul><section class="post_comments"><p>{long_}</section><figure><figcaption>d</figcaption></figure></main>'
    assert html_text.main_text(page, tree) == f"T {long_} a b c d"
    plain = f'<div class="top-nav"><a href=x>N</a></div><div><h1>My head</h1><p>{long_}</p><p>Yes.</p><p>{long_} <a href=y>z</a></p><p>The end.</p></div><footer>F</footer>'
    assert html_text.main_text(plain, tree) == f"My head {long_} Yes. {long_} z The end."


def test_decontamination_of_copies_without_long_runs(spark):
    """Copies with every fifth word replaced or a word put between any two, and of items that share a stock passage with 101 documents, are found."""
    item = [f"w{i}" for i in range(40)]
    stock, rest = [f"s{i}" for i in range(16)], [f"r{i}" for i in range(24)]
    items = [(1, item), (2, stock + rest), (3, ["five", "words", "in", "one", "item"]), (4, ["ha"] * 10)]
    copies = {
        10: (1, [f"x{i}" if i % 5 == 4 else w for i, w in enumerate(item)]),
        11: (1, [x for i, w in enumerate(item) for x in (w, f"y{i}")]),
        12: (2, [f"z{i}" if i in (16, 21, 26, 31, 36) else w for i, w in enumerate(stock + rest)]),
        13: (3, ["five", "words", "by", "one", "item"]),
        14: (4, ["ha"] * 8),
    }
    texts = [(d, ["before", "it", *w, "after"]) for d, (_, w) in copies.items()] + [(15, [f"x{i}" if i % 5 == 4 or i == 0 else w for i, w in enumerate(item)]), (16, ["ha"] * 7)]
    texts += [(100 + i, [*stock, f"t{i}"]) for i in range(101)]
    docs, bench = (spark.createDataFrame([(i, " ".join(w)) for i, w in x], f"{k} long, text string") for k, x in (("doc_id", texts), ("item_id", items)))
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == {(d, k) for d, (k, _) in copies.items()}
    assert decontaminate.clean(docs, bench).count() == 103
    one_each = decontaminate.leaks(docs, bench, block_chars=1)
    assert {(r.doc_id, r.item_id) for r in one_each.collect()} == {(d, k) for d, (k, _) in copies.items()}


def test_html_comments_and_cards_as_articles():
    """Articles inside side containers do not make the text beside them foreign; an article of the page itself still does."""
    tree, long_ = html_text.trained(), " ".join(["word"] * 40)
    body = f"<div><h1>My own head</h1><p>{long_}</p><p>{long_}</p></div>"
    side = "<div class=comments><article><p>Nice one!</p></article><article><p>I do not think so at all, sorry.</p></article></div><div class='related'><article><a href=x>Next</a></article></div>"
    assert html_text.main_text(body + side, tree) == f"My own head {long_} {long_}"
    assert html_text.main_text(f"<article>{body}</article><div><p>{long_} outside</p></div>{side}", tree) == f"My own head {long_} {long_}"


def test_html_keeps_pages_in_forms_open_heads_and_layout_names():
    long_, more = " ".join(["word"] * 60), " ".join(["text"] * 45)
    tree, body = html_text.trained(), f"<h1>My head</h1><p>{long_}</p><p>{more}</p>"
    want = f"My head {long_} {more}"
    for page in (
        f"<html><body><form id=aspnetForm>{body}</form></body></html>", f"<html><body><form id=aspnetForm><article>{body}</article></form></body></html>",
        f"<html><head><title>T</title><meta charset=utf-8><body><article>{body}</article></body></html>", f"<html><head><title>T</title><article>{body}</article>", f"<html><head><title>T</title><meta charset=utf-8><div>{body}</div>",
        f'<div id="wrapper" class="sidebar-right"><article>{body}</article></div>', f'<header><h1>Site</h1></header><div class="page sidebar-left"><article>{body}</article><div class=sidebar><p>{more}</p></div></div>',
        f'<article>{body}</article><section class="discussion"><p>{long_}</p><p>{more}</p></section>', f'<article>{body}</article><div id="disqus_thread"><p>{long_} {more} {long_}</p></div>',
        f"<article>{body}</article><form><p>Your name and address please {more} {long_} {long_}</p></form>", f"<article>{body}</article><div class=comments><article><h1>x</h1><p>{long_} {long_} {long_}</p></article></div>",
    ):
        assert html_text.main_text(page, tree) == want, page[:90]


def every_copy(item: list[str], text: list[str], least: int) -> list[tuple[int, int, int, int]]:
    """(score, matched, start, end) of the copies, by the plain matrix of the whole text; the best first, then to both its sides."""
    left, found = [(0, len(text))], []
    while left:
        lo, hi = left.pop()
        best, above = (0, 0, 0, 0), [(0, 0, j) for j in range(hi - lo + 1)]
        for word in item:
            row = [(0, 0, 0)]
            for j in range(1, hi - lo + 1):
                same = text[lo + j - 1] == word
                diagonal, up, before = above[j - 1][0] + (2 if same else -1), above[j][0] - 1, row[-1][0] - 1
                path = (diagonal, above[j - 1][1] + same, above[j - 1][2]) if diagonal >= up else (up, *above[j][1:])
                path = path if path[0] >= before else (before, *row[-1][1:])
                row.append(path if path[0] > 0 else (0, 0, j))
            above = row
            enough = max((s if h >= least else 0, -j) for j, (s, h, _) in enumerate(row))
            if enough[0] > best[0]:
                s, h, f = row[-enough[1]]
                best = (s, h, f, -enough[1])
        if best[0]:
            score, matched, a, e = best
            found.append((score, matched, lo + a, lo + e))
            left += [(lo, lo + a), (lo + e, hi)]
    return sorted(found)


def test_decontamination_tells_every_copy_once():
    r = random.Random(8)
    for n in range(60):
        size = r.choice([5, 8, 15, 30])
        item = [f"i{r.randrange(size)}" for _ in range(size)]
        text = []
        for _ in range(r.randrange(1, 4)):
            text += [f"o{r.randrange(50)}" for _ in range(r.choice([0, 3, 4, 17, 2 * size, 3 * size + n % 7]))]
            copy = [w if r.random() > 0.08 else "x" for w in item if r.random() > 0.05]
            for _ in range(r.randrange(3)):
                copy.insert(r.randrange(len(copy)), "y")
            text += copy
        block = decontaminate.Block([(1, item), (2, ["z"])], 0.8)
        got = sorted((score, round(similarity * len(item)), a, e) for _, score, similarity, a, e in block.search(" ".join(text), 0.8))
        assert got == every_copy(item, text, math.ceil(0.8 * len(item) - 1e-9)), (item, text)
    words = [f"w{i}" for i in range(100)]
    block = decontaminate.Block([(1, words)], 0.8)
    for gap in (0, 1, 4, 295, 299, 300, 301):
        filler = [f"f{i}" for i in range(gap)]
        assert [x[3:] for x in block.search(" ".join(filler + words), 0.8)] == [(gap, gap + 100)]
        assert sorted(x[3:] for x in block.search(" ".join(words + filler + words), 0.8)) == [(0, 100), (100 + gap, 200 + gap)]


def test_prior_is_found_and_the_risk_is_minimised():
    rng = np.random.default_rng(3)
    for share in (0.02, 0.3, 0.85):
        good, bad = rng.normal(2, 1, (3000, 3)), rng.normal(-2, 1, (3000, 3))
        n = int(3000 * share)
        unlabelled = np.concatenate([good[:n], bad[: 3000 - n]])[rng.permutation(3000)]
        found = quality.class_prior(good[1500:], unlabelled)
        assert abs(found - share) < 0.04, (share, found)
        model = quality.fit(good[1500:], unlabelled, found)
        told = model.score(np.concatenate([rng.normal(2, 1, (500, 3)), rng.normal(-2, 1, (500, 3))])) >= 0.5
        assert (told[:500].mean() > 0.9 or share < 0.1) and told[500:].mean() < 0.1

        # the corrected risk of the fit is not above that of the weights around it
        expand = lambda x: quality.expand((x - model.mean) / model.scale)

        def risk(w, p=expand(good[1500:]), u=expand(unlabelled), prior=found):
            loss = lambda z: 1 / (1 + np.exp(z))
            return prior * loss(p @ w).mean() + max(0.0, loss(-(u @ w)).mean() - prior * loss(-(p @ w)).mean()) + 0.5e-3 * w @ w

        least = risk(model.weights)
        assert all(least <= risk(model.weights + rng.normal(0, 0.3, len(model.weights))) + 2e-3 for _ in range(20))


def test_pii_finds_tokens_and_spelled_addresses_of_any_length(spark):
    long_, token = "a1B2c3D4e5" * 30, "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"
    texts = [f'token = "{long_}" end', f"Authorization: Bearer {token} ok", f"write to {'x' * 70} [at] mail [dot] one [dot] two [dot] three [dot] example [dot] org now"]
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == "secret:9:309" and got[1] == f"secret:22:{22 + len(token)}" and got[2].startswith(f"spelled_email:9:{len(texts[2]) - 4}")
