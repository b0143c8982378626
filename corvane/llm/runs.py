"""Periodic runs of words, by the suffix tree method of Stoye and Gusfield.

The tree of a text's words is that of its sorted suffixes and their common prefixes. A square of period q that the next
word does not continue ("branching") is a pair of leaves q words apart below the node of depth q; each node looks up only
the leaves outside its largest child, so n words give n log n look-ups. Branching squares are rotated to the left as long
as the word before agrees, and those that end together and are powers of one another merge into one maximal run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import batch, bounded_batches, text_of

#: Words of whole texts that are sorted together; a longer text is sorted alone.
TOGETHER = 1 << 19


def suffixes(words: np.ndarray, doc: np.ndarray, shared: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(sorted suffixes, words each shares with the one before) by prefix doubling; suffixes end with their text.

    ``doc`` ascends. Texts in which no string of ``shared`` words, or of the next power of two below, stands twice are left out.
    """
    n = len(words)
    stops = np.append(np.flatnonzero(np.diff(doc)) + 1, n)
    end = np.repeat(stops, np.diff(np.append(0, stops)))
    kept = np.ones(n, bool)

    def ranked(key: np.ndarray, at: np.ndarray, base: np.ndarray) -> np.ndarray:
        """New ranks of the suffixes ``at``: the place of the first with an equal key, counted from that of their group."""
        order = np.argsort(key, kind="stable")
        key, base = key[order], base[order]
        new = np.append(True, key[1:] != key[:-1])
        group = np.append(True, base[1:] != base[:-1])
        places = np.arange(len(key))
        rank[at[order]] = base + np.maximum.accumulate(np.where(new, places, 0)) - np.maximum.accumulate(np.where(group, places, 0))
        alone = new & np.append(new[1:], True)
        return np.sort(at[order[~alone]])

    rank = np.zeros(n, np.int64)
    left = ranked(doc.astype(np.int64) * (int(words.max(initial=0)) + 1) + words, np.arange(n), np.zeros(n, np.int64))
    levels, k = [rank.astype(np.int32)], 1
    while len(left):
        after = left + k
        inside = after < end[left]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        left = ranked(rank[left] * (n + 1) + second, left, rank[left].copy())
        k *= 2
        if k <= shared < 2 * k:
            there = np.zeros(int(doc[-1]) + 1, bool)
            there[doc[left]] = True
            kept = there[doc]
        levels.append(rank.astype(np.int32))
    at = np.flatnonzero(kept)
    at = at[np.argsort(rank[at])]
    common = np.zeros(len(at), np.int64)
    a, b = at[1:], at[:-1]
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + common[1:], b + common[1:]
        inside = (x < end[a]) & (y < end[b])
        same = inside & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        common[1:] += np.where(same, 1 << level, 0)
    return at, common


def tree(common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inner nodes below the root: depth, first and last leaf, parent (-1: the root); and the node above each leaf."""
    depth, first, last, parent, above = [], [], [], [], []
    open_: list[int] = []
    top = 0
    for r, d in enumerate([*common[1:].tolist(), 0], 1):
        if d <= top:
            above.append(open_[-1] if open_ else -1)
        else:
            above.append(len(depth))
        if d == top:
            continue
        begin, child = r - 1, -1
        while top > d:
            child = open_.pop()
            begin, last[child] = first[child], r - 1
            top = depth[open_[-1]] if open_ else 0
            if top >= d and open_:
                parent[child] = open_[-1]
        if d > top:
            node = len(depth)
            depth.append(d)
            first.append(begin)
            last.append(-1)
            parent.append(-1)
            if child >= 0:
                parent[child] = node
            open_.append(node)
            top = d
    return tuple(np.array(x, np.int64) for x in (depth, first, last, parent, above[: len(common)]))


def squares(words: np.ndarray, doc: np.ndarray, at: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every branching square, each once."""
    depth, first, last, parent, above = tree(common)
    if not len(depth):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n, size = len(words), last - first + 1
    nodes = np.arange(len(depth))
    inner = np.flatnonzero(parent >= 0)
    inner = inner[np.lexsort((inner, size[inner], parent[inner]))]
    largest = np.full(len(depth), -1)
    largest[parent[inner]] = inner  # the last one written is the largest
    up = np.where((parent >= 0) & (largest[parent] == nodes), parent, nodes)
    while (up[up] != up).any():
        up = up[up]
    place = np.full(n, -1)
    place[at] = np.arange(len(at))
    leaf = np.flatnonzero(above >= 0)
    node = above[leaf]
    heavy = (largest[node] < 0) & (first[node] == leaf)
    node = np.where(heavy, parent[up[node]], node)
    starts, periods = [], []
    while True:
        leaf, node = leaf[node >= 0], node[node >= 0]
        if not len(leaf):
            break
        for sign in (1, -1):
            i = at[leaf]
            q = depth[node]
            other = i + sign * q
            there = (other >= 0) & (other < n)
            p = np.where(there, place[np.clip(other, 0, n - 1)], -1)
            found = (p >= first[node]) & (p <= last[node])
            i, q = np.minimum(i, other)[found], q[found]
            after = np.minimum(i + 2 * q, n - 1)
            ends = (i + 2 * q >= n) | (doc[after] != doc[i]) | (words[after] != words[i])
            starts.append(i[ends])
            periods.append(q[ends])
        node = parent[up[node]]
    pairs = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def rotated(words: np.ndarray, begin: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far each square can be moved to the left: to the first word that differs from the one a period later."""
    start, moved = start.copy(), np.arange(len(start))
    width = 8
    while len(moved):
        s, q, b = start[moved], period[moved], begin[moved]
        back = s[:, None] - 1 - np.arange(width)
        inside = back >= b[:, None]
        back = np.maximum(back, 0)
        agree = inside & (words[back] == words[back + q[:, None]])
        steps = np.where(agree.all(axis=1), width, np.argmin(agree, axis=1))
        start[moved] -= steps
        moved = moved[steps == width]
        width = min(2 * width, max(8, (1 << 20) // max(1, len(moved))))
    return start


def runs(words: np.ndarray, doc: np.ndarray, min_words: int = 6, min_copies: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every maximal run of its least period with ``min_copies`` (2 or more) periods and ``min_words`` words, by start and period.

    A run is never longer than its text; ``doc`` ascends.
    """
    none = np.zeros(0, np.int64)
    if not len(words):
        return none, none, none
    # a run shares all but a period of its words with itself a period later
    at, common = suffixes(words, doc, min(max(1, min_words - 1), min(max(q * (min_copies - 1), min_words - q) for q in range(1, min_words + 1))))
    start, period = squares(words, doc, at, common)
    begin = np.searchsorted(doc, doc[start], side="left")
    end = start + 2 * period
    order = np.lexsort((period, end))
    start, period, begin, end = start[order], period[order], begin[order], end[order]
    found = []
    while len(start):  # as often as squares of unlike periods end at one word, which is the logarithm of a text at most
        least = np.append(True, end[1:] != end[:-1])
        group = np.cumsum(least) - 1
        s = rotated(words, begin[least], start[least], period[least])
        found.append(np.stack([s, end[least] - s, period[least]]))
        left = ~least & ~((period % period[least][group] == 0) & (start >= s[group]))
        start, period, begin, end = start[left], period[left], begin[left], end[left]
    s, length, q = np.concatenate(found, axis=1) if found else (none, none, none)
    long_ = (length >= min_copies * q) & (length >= min_words)
    s, length, q = s[long_], length[long_], q[long_]
    order = np.lexsort((q, s))
    return s[order], length[order], q[order]


Found = list[tuple[list[bytes], list[tuple[int, int, int]]]]


def texts_runs(texts: list[list[bytes]], min_words: int, min_copies: int) -> Iterator[list[tuple[int, int, int]]]:
    """The runs of each text, many short texts at a time."""
    held, n = [], 0

    def solve():
        codes: dict[bytes, int] = {}
        words = np.array([codes.setdefault(w, len(codes)) for t in held for w in t], np.int64)
        sizes = np.array([len(t) for t in held], np.int64)
        doc = np.repeat(np.arange(len(held)), sizes)
        s, length, q = runs(words, doc, min_words, min_copies)
        offsets = np.append(0, np.cumsum(sizes))
        out: list[list[tuple[int, int, int]]] = [[] for _ in held]
        for d, a, b, c in zip(doc[s].tolist(), s.tolist(), length.tolist(), q.tolist(), strict=True):
            out[d].append((a - int(offsets[d]), b, c))
        return out

    for t in texts:
        held.append(t)
        n += len(t)
        if n >= TOGETHER:
            yield from solve()
            held, n = [], 0
    yield from solve()


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not found:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for s, length, q in found:
        edges[s + q] += 1
        edges[s + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def _over(docs: DataFrame, schema: pa.Schema, ddl: str, row: Callable, prepare: Callable, min_words: int, min_copies: int) -> DataFrame:
    if min_copies < 2 or min_words < 1:
        raise ValueError("a run has two periods at least, and a word")
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            # bytes.split parts at the bytes 0x20 and 0x09 to 0x0D alone
            texts = [prepare(i, t.encode().split()) for i, t in zip(ids, b.column(1).to_pylist(), strict=True)]
            rows = [row(i, t, f) for i, t, f in zip(ids, texts, texts_runs(texts, min_words, min_copies), strict=True)]
            yield batch(schema, [list(x) for x in zip(*rows, strict=True)] if rows else [[]] * len(schema))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(run, ddl)


def find(docs: DataFrame, min_words: int = 6, min_copies: int = 4) -> DataFrame:
    """doc_id, n_words, runs array<struct<start, length, period>>, text: every run, and the text with one period of each.

    Words are what white space of ASCII parts. A null text has no words; repeated rows and rows without doc_id stay, one
    result each; other columns are ignored; an empty table gives no rows. Texts are taken whole: a task holds some hundred
    bytes for each word of the longest one. No row leaves its partition.
    """
    triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(triple)), ("text", pa.string())])

    def row(doc_id, words, found):
        kept = b" ".join(collapsed(words, found)).decode()
        return doc_id, len(words), [{"start": s, "length": n, "period": q} for s, n, q in found], kept

    ddl = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"
    return _over(docs, schema, ddl, row, lambda _, words: words, min_words, min_copies)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """What query op11 makes of a text: in a tenth of the documents, told by their ids, the end repeats with some period."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def longest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods; of equal ones the first by start and period, as they are given."""
    best = None
    for s, n, q in found:
        if best is None or n * best[2] > best[1] * q:
            best = s, n, q
    return best


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op11. Documents without an id are left as they are."""
    long_, text = pa.int64(), pa.string()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    schema = pa.schema([*[(x, long_) for x in names], ("runs_sha256", text), ("collapsed_sha256", text)])

    def row(doc_id, words, found):
        best = longest(found)
        said = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        return doc_id, len(found), *figures, hashlib.sha256(said).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest()

    ddl = ", ".join(f"{x} long" for x in names) + ", runs_sha256 string, collapsed_sha256 string"
    return _over(docs, schema, ddl, row, planted, 6, 4)
