"""Benchmark decontamination: rare seeds lead passages to test items, Smith-Waterman scores the copies.

The benchmark is the stated query set: Spark deals its items into blocks of bounded size in the shared folder,
and each block meets every document once; the items never pass through the driver. Seeds are single words:
words put in between, left out or replaced at any distance leave no run of two words to rely on, while the
similarity bounds how many words of an item a copy can lack. The rarest words of an item lead to it, its other
words are then counted, and the stretches of text that hold enough of them are aligned with it.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import batch, bounded_batches, shared_dir, text_of

WORD = re.compile(r"\w+")
#: Share of the item's words that an alignment must match to count as a copy.
SIMILAR = 0.8
#: Score of a match, and costs of a mismatch and of a gap.
MATCH, MISMATCH, GAP = 2, 1, 1
#: Words of text for each word of the item that an alignment can span: matches and what their score can pay for.
REACH = 1 + MATCH
#: Characters of benchmark text in a block.
BLOCK_CHARS = 4 << 20


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Block:
    """A block of items: which of them a text may copy, and where.

    A copy matches ``least`` words of its item, so of the item's distinct words it lacks at most as many as
    the item has words to spare, and it holds at least one of that many and one more: these, the rarest in the
    block, are the item's seeds. Rarity orders the seeds and never drops an item.
    """

    def __init__(self, items: list[tuple[int, list[str]]], similar: float):
        self.ids = [i for i, _ in items]
        self.codes: dict[str, int] = {}
        self.coded = [np.array([self.codes.setdefault(w, len(self.codes)) for w in words], np.int32) for _, words in items]
        self.distinct = [frozenset(x.tolist()) for x in self.coded]
        self.least = [max(1, math.ceil(similar * len(x) - 1e-9)) for x in self.coded]
        self.need = [max(1, len(d) - len(x) + k) for d, x, k in zip(self.distinct, self.coded, self.least, strict=True)]
        held = Counter(c for d in self.distinct for c in d)
        self.seeds: dict[int, list[int]] = defaultdict(list)
        for k, d in enumerate(self.distinct):
            for c in sorted(d, key=lambda c: (held[c], c))[: len(d) - self.need[k] + 1]:
                self.seeds[c].append(k)

    def candidates(self, present: set[int]) -> list[int]:
        """Items of which the words present leave out no more than a copy may."""
        met = {k for c in present if c in self.seeds for k in self.seeds[c]}
        return sorted(k for k in met if len(self.distinct[k] & present) >= self.need[k])

    def search(self, text: str | None, similar: float) -> Iterator[tuple[int, int, float, int, int]]:
        """(item_id, score, similarity, start, end) of each stretch of the text that copies an item."""
        found = [self.codes.get(w, -1) for w in words_of(text)]
        near = self.candidates(set(found))
        codes = np.array(found, np.int32) if near else None
        for k in near:
            left = list(self.stretches(k, codes, 0, len(codes)))
            while left:
                lo, hi = left.pop()
                score, matched, a, e = align(self.coded[k], codes[lo:hi], self.least[k])
                if matched:
                    yield self.ids[k], score, matched / len(self.coded[k]), lo + a, lo + e
                    # what is found is taken out, and both sides are searched on
                    left += [*self.stretches(k, codes, lo, lo + a), *self.stretches(k, codes, lo + e, hi)]

    def stretches(self, k: int, text: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """Stretches of the text from ``lo`` to ``hi`` that together hold every copy, each of them whole.

        An alignment has a score above 0, so it spans less than REACH words of text for each word of the item; stretches
        part only where no such span with enough of the item's words lies across.
        """
        span = REACH * len(self.coded[k])
        text = text[lo:hi]
        total = np.concatenate([[0], np.cumsum(np.isin(text, self.coded[k]))])
        starts = np.arange(len(text))
        starts = starts[total[np.minimum(starts + span, len(text))] - total[starts] >= self.least[k]]
        for part in np.split(starts, np.flatnonzero(np.diff(starts) >= span) + 1) if len(starts) else ():
            yield lo + int(part[0]), lo + min(len(text), int(part[-1]) + span)


def align(item: np.ndarray, text: np.ndarray, least: int = 1) -> tuple[int, int, int, int]:
    """Best local alignment of ``least`` matched words or more: (score, matched words, start, end in the text), linear gap cost; zeros if there is none.

    Each place in the matrix stands for its best path; of equal scores the first row counts, then the first place.

    One row of the matrix per item word; gaps along the text are a running maximum. Each cell carries the
    matches and the start of its best path, so memory is linear in the text however long the item is. Of equal
    predecessors the diagonal one counts, then the one above.
    """
    m = len(text)
    places = np.arange(m + 1)
    slope = (GAP * places).astype(np.int32)
    score, hits, first = np.zeros(m + 1, np.int32), np.zeros(m + 1, np.int32), places
    best = (0, 0, 0, 0)
    for word in item:
        same = text == word
        diagonal, above = score[:-1] + np.where(same, MATCH, -MISMATCH), score[1:] - GAP
        across = diagonal >= above
        s = np.where(across, diagonal, above)
        alive = s > 0
        row = np.concatenate([[0], np.where(alive, s, 0)]).astype(np.int32) + slope
        h = np.concatenate([[0], np.where(alive, np.where(across, hits[:-1] + same, hits[1:]), 0)]).astype(np.int32)
        f = np.concatenate([[0], np.where(alive, np.where(across, first[:-1], first[1:]), places[1:])])
        top = np.maximum.accumulate(row)
        source = np.maximum.accumulate(np.where(row == top, places, 0))
        score, hits, first = top - slope, h[source], f[source]
        enough = np.where(hits >= least, score, 0)
        j = int(np.argmax(enough))
        if enough[j] > best[0]:
            best = int(score[j]), int(hits[j]), int(first[j]), j
    return best


def _blocks(benchmark: DataFrame, chars: int) -> list[str]:
    """Folders of the blocks of items, dealt by a hash of the item's id; written by the executors."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of("text").alias("text")).where("item_id is not null and text <> ''")
    n = math.ceil((items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0) / chars)
    path = f"{shared_dir(benchmark.sparkSession)}/items-{uuid.uuid4().hex}"
    if n:
        items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n))).repartition("block").write.partitionBy("block").parquet(path)
    return [f"{path}/block={k}" for k in range(n)]


_LOADED: dict[tuple[str, float], Block] = {}


def _loaded(path: str, similar: float) -> Block:
    """The block of that folder; a worker keeps the one it read last."""
    if (path, similar) not in _LOADED:
        _LOADED.clear()
        store, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        if store.get_file_info(root).type == fs.FileType.NotFound:  # no item fell into this block
            rows = []
        else:
            rows = sorted((r["item_id"], r["text"]) for r in pq.read_table(root, filesystem=store, columns=["item_id", "text"], partitioning=None).to_pylist())
        _LOADED[path, similar] = Block([(i, words) for i, t in rows if (words := words_of(t))], similar)
    return _LOADED[path, similar]


def leaks(docs: DataFrame, benchmark: DataFrame, similar: float = SIMILAR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, score, similarity, start, end): every copy of an item in a document, each once.

    The best alignment that matches enough of the item comes first, is taken out of the text, and so on to both sides of it.

    similarity is the share of the item's words that the alignment matches; start and end are word places.
    Null or empty texts, items without words and items without id match nothing; a null doc_id stays null;
    repeated rows give repeated results; empty tables give no rows; other columns are ignored. Texts and items
    may be very long: an alignment holds a few numbers for each word of its stretch.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    ddl = "doc_id long, item_id long, score int, similarity double, start int, end int"
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.int32()), ("similarity", pa.float64()), ("start", pa.int32()), ("end", pa.int32())])

    def search(path: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                block = _loaded(path, similar)
                rows = [(i, *found) for i, t in zip(*(c.to_pylist() for c in b.columns), strict=True) for found in block.search(t, similar)]
                if rows:
                    yield batch(schema, [list(x) for x in zip(*rows, strict=True)])

        return run

    found = spark.createDataFrame([], ddl)
    for n, path in enumerate(_blocks(benchmark, block_chars)):
        part = plain.mapInArrow(search(path), ddl)
        found = found.union(part) if n else part
    return found


def clean(docs: DataFrame, benchmark: DataFrame, similar: float = SIMILAR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows whose text copies no item, with all their columns, whatever their names; each row is judged by its own text alone.

    Null ids and repeated rows need no care: rows are let through or not where they stand, without a shuffle.
    Null and empty texts copy nothing.
    """
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def kept(path: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                block = _loaded(path, similar)
                yield b.filter(pa.array([next(block.search(t, similar), None) is None for t in b.column(at).to_pylist()], pa.bool_()))

        return run

    for path in _blocks(benchmark, block_chars):
        docs = docs.mapInArrow(kept(path), docs.schema)
    return docs


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of query op2."""
    return leaks(docs, benchmark)
