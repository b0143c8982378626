"""Periodic runs, repair of conversations and files of token ids against plain versions."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from conftest import SF

from corvane.llm import common, repair, runs, token_files

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def rows_of(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


# --- periodic runs


def plain_runs(w, min_words=6, min_copies=4):
    found = {}
    for q in range(1, len(w) // min_copies + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(min_words, min_copies * q):
                found.setdefault((i, n), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("min_words,min_copies", [(6, 4), (1, 2), (3, 3), (9, 2), (5, 6)])
def test_runs_equal_all_stretches(min_words, min_copies):
    r = random.Random(min_words)
    for _ in range(150):
        texts = []
        for _ in range(r.randrange(1, 9)):
            t = [b"%d" % r.randrange(r.choice([1, 2, 3, 9])) for _ in range(r.choice([0, 1, 6, 30, 90]))]
            for _ in range(r.randrange(3)):
                if t:
                    s, p = r.randrange(len(t)), r.randrange(1, 8)
                    t = t[:s] + (t[s : s + p] * 50)[: r.randrange(1, 60)] + t[s:]
            texts.append(t)
        assert list(runs.texts_runs(texts, min_words, min_copies)) == [plain_runs(t, min_words, min_copies) for t in texts]


def test_runs_of_very_long_texts_stay_cheap():
    for text, want in (([b"a"] * 300_000, (0, 300_000, 1)), ([b"%d" % (i % 999) for i in range(300_000)], (0, 300_000, 999))):
        assert list(runs.texts_runs([text, [b"x"]], 6, 4)) == [[want], []]
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 100_000:
        a, b = b, b + a
    assert list(runs.texts_runs([b], 6, 4)) == [[]]  # a Fibonacci word has no fourth power


def plain_op11(doc_id, text):
    words = SPACE.findall((text or "").encode())
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2])) if found else (None,) * 3
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_op11_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    held = [tuple(r) for r in docs.collect()]
    odd = [(None, "a " * 9), (10**9, None), (10**9, ""), (10**9, " \t\n\x0b\f\r "), (77, "a a a a"), (77, "x y " * 400 + "z"), (78, "x y\n" * 400), (78, "x y\n" * 400)]
    odd += [(i, "one two three four five six seven eight nine ten") for i in range(2000, 2040)]
    got = runs.digest(docs.union(spark.createDataFrame(odd, "doc_id long, text string")))
    key = lambda x: tuple(str(v) for v in x)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((plain_op11(*x) for x in held + odd), key=key)


def test_find_collapses_and_stands_clashes(spark):
    docs = spark.createDataFrame([(1, "go a b a b a b a b end", 5)], "doc_id long, text string, runs int")
    assert rows_of(runs.find(docs)) == [{"doc_id": 1, "n_words": 10, "runs": [{"start": 1, "length": 8, "period": 2}], "text": "go a b end"}]
    assert runs.find(docs.where("false")).count() == 0
    assert runs.digest(docs.where("false")).count() == 0


# --- repair


def plain_edits(rows):
    """rows of (initial, must go, truncated) -> (cost, least string) by a search over strings."""
    queue, seen = [(0, "", 0, 0)], set()
    while True:
        cost, said, i, state = heapq.heappop(queue)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, said
        if i < len(rows):
            initial, must, cut_off = rows[i]
            heapq.heappush(queue, (cost + 4, said + "D", i + 1, state))
            if not must:
                for (s, c), to in {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.items():
                    if s == state and c == initial:
                        heapq.heappush(queue, (cost + 3 * cut_off, said + "K", i + 1, to))
                heapq.heappush(queue, (cost + 3 + 3 * cut_off, said + "R", i + 1, 3 if state == 2 else 2))
        heapq.heappush(queue, (cost + 3, said + "I", i, 3 if state == 2 else 2))


def plain_op12(rows):
    out, order = {}, lambda x: (x[1] is not None, x[1] or 0, x[2], x[3])
    for conv in {r[0] for r in rows}:
        held = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            said = [" " if x is None else str(x) for x in (c, turn, role, text)]
            h = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20
            role, text = said[2:]
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            held += [(c, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
        held.sort(key=order)
        turns = [r[1] for r in held if r[1] is not None]
        n, seen, faults = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, _, role, text in held:
            bare = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            faults.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = plain_edits(faults) if held else (0, "")
        state, at, made = "", 0, []
        for edit in audit:
            due = "assistant" if state.endswith("u") else "user"
            if edit == "I":
                made.append(f"{due}:")
            elif edit != "D":
                made.append((due if edit == "R" else held[at][2]) + ":" + held[at][3])
            if edit != "D":
                state += made[-1][0]
            at += edit != "I"
        assert re.fullmatch("(s?(ua)+)?", state)
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(held, held[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = {"conv_id": conv, "gaps": gaps, **n, "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": sha("\n".join(made))}
    return out


@pytest.mark.parametrize("bits", [0, 2, repair.SEGMENT_BITS])
def test_op12_equals_the_plain_version(spark, bits):
    schema = "conv_id long, turn long, role string, text string"
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    r = random.Random(7)
    for conv in [*range(900, 960), None]:
        for turn in range(r.choice([1, 2, 5, 12, 40])):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = r.choice(["Yes.", "No", "", None, "What? \n", "Ends ", f"Turn {turn}!", f"turn {turn}"])
            rows.append((conv, r.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += [(999, i, ("user", "assistant")[i % 2], f"Long talk {i}.") for i in range(700)] + [(998, 1, "user", "Same.")] * 300
    got = {x["conv_id"]: x for x in rows_of(repair.digest(spark.createDataFrame(rows, schema).repartition(5), bits))}
    want = plain_op12(rows)
    assert got.keys() == want.keys()
    for conv, x in want.items():
        assert got[conv] == x, conv


def test_repair_gives_rows_in_order(spark):
    rows = [(1, 0, "system", "Hi.", 9), (1, 1, "assistant", "A.", 9), (1, 1, "assistant", "A.", 9), (1, None, "user", "No", 9), (2, 5, "tool", " ", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, at int")
    for bits in (0, repair.SEGMENT_BITS):
        got = [(r.conv_id, r.role, r.text) for r in repair.repair(df, bits).orderBy("conv_id", "at", "k").collect()]
        # conversation 1 stands as user, system, assistant, assistant (again)
        assert got in ([(1, "user", "No"), (1, "assistant", "Hi.")], [(1, "system", "Hi."), (1, "user", ""), (1, "assistant", "A.")])
    assert repair.repair(df.where("false")).count() == 0
    assert repair.digest(df.drop("at").where("false")).count() == 0


# --- files of token ids


def plain_op13(rows, end_id=2):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def library(spark):
    return token_files.Library(spark, public_tokenizers.path("byte_bpe_50k.json"))


def test_units_are_encoded_as_the_library_does():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        found = token_files.Units(f.read())
    r = random.Random(3)
    alphabet = ["a", "the", "  ", " ", " ", " ", "\n", "\t", "\x85", "é", "日本", "123", "...", "'s", "'", "!?", "#", "<|endoftext|>", "᠎", "\x1c", "😀", " ", "​"]
    for _ in range(400):
        texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(25))) for _ in range(8)]
        got = [np.frombuffer(x, found.width).tolist() for x in found.encode(texts)]
        assert got == [found.library.encode(x, add_special_tokens=False).ids for x in texts]


def test_op13_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = sorted((tuple(r) for r in docs.collect()), key=lambda x: x[0])
    assert [tuple(r) for r in token_files.digest(docs.repartition(7), library, 2).orderBy("start").collect()] == plain_op13(rows)
    # tiny blocks and sections, a very long text, nulls and repeated ids
    odd = [(None, "no id"), (5, None), (6, ""), (7, "word " * 60_000), (8, " " * 5000 + "<|endoftext|>\n\n x"), (9, "same"), (9, "same"), (10, "last")]
    small = spark.createDataFrame(odd, "doc_id long, text string").repartition(3)
    for sizes in ({}, {"block": 3, "ids_a_section": 10}, {"max_bits": 5}):
        assert [tuple(r) for r in token_files.digest(small, library, 2, **sizes).orderBy("start").collect()] == plain_op13(odd)
    assert token_files.digest(small.where("false"), library, 2).count() == 0
    back = {r.doc_id: r.ids for r in token_files.round_trip(small.where("doc_id in (6, 10)").withColumn("start", small.doc_id), library, 2).collect()}
    assert back == {6: [2], 10: [*library.units().library.encode("last").ids, 2]}


def least_total(counts, limit):
    """The least total of lengths over all lists of them that a prefix code can have."""
    w = sorted((c for c in counts if c), reverse=True)

    def best(placed, nodes, level):
        """From a level with ``nodes`` places, of which each takes a symbol or is opened into two."""
        if placed == len(w):
            return 0
        if level > limit or not nodes:
            return 10**30
        return min(level * sum(w[placed : placed + k]) + best(placed + k, min(2 * (nodes - k), len(w)), level + 1) for k in range(min(nodes, len(w) - placed) + 1))

    return best(0, 2, 1)


def test_code_lengths_are_least_under_the_limit():
    r = random.Random(4)
    for _ in range(60):
        counts = np.array([r.choice([0, 1, 1, 2, 3, 50, 10 ** r.randrange(7)]) for _ in range(r.randrange(2, 9))])
        if (counts > 0).sum() < 2:
            continue
        for limit in range(int((counts > 0).sum() - 1).bit_length(), 7):
            lengths = token_files.code_lengths(counts, limit)
            assert lengths.max() <= limit and (lengths * counts).sum() == least_total(counts.tolist(), limit)
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(5), 2)


def test_damaged_files_are_refused(spark, library, tmp_path):
    files = token_files.write(token_files.encoded(spark.createDataFrame([(1, "some words here")], "doc_id long, text string"), library, 2))
    path = files.first().path
    with open(path, "rb") as f:
        data = bytearray(f.read())
    data[-1] ^= 1
    bad = tmp_path / "bad.tokens"
    bad.write_bytes(data)
    with open(path, "rb") as f:
        assert len(list(token_files.documents(f))) == 1
    with open(bad, "rb") as f, pytest.raises(ValueError, match="damaged"):
        list(token_files.documents(f))
    assert common.shared_dir(spark).split("://")[-1].rstrip("/") in path
