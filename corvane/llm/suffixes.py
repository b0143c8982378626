"""Repeated byte strings by bucket-pointer refinement of suffixes, dealt out over Spark.

A suffix's bucket at depth d is named by a number; refining to a greater depth combines the bucket at its
start with the bucket of a later offset, and the refined names are used for the next refinement: depths 1,
2, 4 .. 128 and at last ``length``. The names are computed from content, so equal strings have equal names
in every document and no global ranking is needed; suffixes share a bucket at the last depth when they start
with the same ``length`` bytes.

Only buckets of two or more need refining. To find them without shuffling every suffix, each window of
``length`` bytes elects the least bucket name of its q-grams (depth 64) as its anchor; equal windows elect
equal anchors at equal places. One row per anchor is shuffled. Where all windows around the anchors of a
bucket agree (a name from other numbers covers them all), they are repeats at once. In other buckets one suffix for each
different surrounding is looked at again: windows whose places around the anchor are near each other share a
core of ``length - CHUNK + 1`` bytes, and only windows whose core is met twice are refined to the last depth and
compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.llm.common import batch, bounded_batches, cut, text_of

LENGTH = 200
Q = 64
#: Neighbouring windows that are judged by the core they share, before they are compared singly.
CHUNK = 16
#: Windows handled at once; their places fit in 20 bits.
STEP = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)


def _names_of_bytes(lane: int) -> np.ndarray:
    """256 fixed pseudo-random names for the buckets of depth one."""
    return np.frombuffer(b"".join(hashlib.blake2b(bytes([lane, i]), digest_size=8).digest() for i in range(256)), np.uint64)


_FIRST = [_names_of_bytes(0), _names_of_bytes(1)]
_MUL = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def _refine(names: np.ndarray, offset: int, lane: int) -> np.ndarray:
    """Names at a greater depth, from those at each start and at ``offset`` after it."""
    out = names[: len(names) - offset] * _MUL[lane]
    out ^= out >> np.uint64(31)
    out += names[offset:]
    out *= _MUL[1 - lane]
    out ^= out >> np.uint64(29)
    return out


def bucket_names(data: np.ndarray, lane: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket names of all suffixes at depth Q and at depth ``length`` (Q <= length)."""
    names, depth, grams = _FIRST[lane][data], 1, None
    while depth < length:
        offset = min(depth, length - depth)
        names, depth = _refine(names, offset, lane), depth + offset
        if depth == Q:
            grams = names
    return grams, names


def anchors(data: np.ndarray, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor's bucket, the name of all its windows by other numbers than the bucket's, first window, windows * 1024 + the anchor's place from the first) of a text, in parts."""
    span = length - Q + 1
    for at in range(0, len(data) - length + 1, STEP):
        part = data[at : at + STEP + length - 1]
        grams = bucket_names(part, 0, Q)[0]
        full = bucket_names(part, 1, length)[1]
        least, width = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), 1
        while width < span:
            step = min(width, span - width)
            least, width = np.minimum(least[:-step], least[step:]), width + step
        place = (least & _PLACE).astype(np.int64)
        lo = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        n = np.diff(np.concatenate([lo, [len(place)]]))
        shape = (n * 1024 + place[lo] - lo).astype(np.uint64)
        whole = (full[lo] * _MUL[1] + full[lo + n - 1]) * _MUL[0] ^ shape * _MUL[1]
        yield grams[place[lo]], whole, lo + at, shape.astype(np.int64)


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    schema = pa.schema([("h", pa.int64()), ("k", pa.int64()), ("key", pa.int64()), ("lo", pa.int64()), ("shape", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [[], [], [], [], []]
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for h, k, lo, shape in anchors(np.frombuffer(text, np.uint8), length):
                    for column, x in zip(rows, (h.view(np.int64), k.view(np.int64), np.full(len(lo), key), lo, shape.astype(np.int32)), strict=True):
                        column.append(x)
            if rows[0]:
                yield batch(schema, [np.concatenate(x) for x in rows])

    return docs.select("key", "data").mapInArrow(run, "h long, k long, key long, lo long, shape int")


def _pieces(docs: DataFrame, ranges: DataFrame, length: int) -> DataFrame:
    """h, key, lo, shape, solo and the bytes of all windows of each range; docs are read again only here."""
    schema = pa.schema([("h", pa.int64()), ("key", pa.int64()), ("lo", pa.int64()), ("shape", pa.int32()), ("solo", pa.bool_()), ("piece", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, data, ranges in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for at in range(0, len(ranges), 4096):
                    part = ranges[at : at + 4096]
                    yield batch(schema, [[r["h"] for r in part], [key] * len(part), [r["lo"] for r in part], [r["shape"] for r in part], [r["solo"] for r in part],
                                         [data[r["lo"] : r["lo"] + r["shape"] // 1024 + length - 1] for r in part]])

    return docs.join(ranges, "key").select("key", "data", "ranges").mapInArrow(run, "h long, key long, lo long, shape int, solo boolean, piece binary")


def _core_rows(pieces: DataFrame, length: int) -> DataFrame:
    """name, key, at: a row for each chunk of windows of a piece, named by anchor, chunk and the core they share.

    ``at`` is the piece's first window times 64 plus the chunk. Names that meet by chance only add a comparison.
    """
    schema = pa.schema([("name", pa.int64()), ("key", pa.int64()), ("at", pa.int64())])
    depth = length - CHUNK + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for h, key, lo, shape, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n, anchor = divmod(shape, 1024)
                names = bucket_names(np.frombuffer(piece, np.uint8), 0, depth)[1]
                # a window at w has its anchor at offset anchor - w; chunks are counted by that offset
                c = np.arange(max(0, anchor - n + 1) // CHUNK, anchor // CHUNK + 1)
                name = (names[anchor - CHUNK * c] ^ np.array([h], np.int64).view(np.uint64)) * _MUL[0] + c.astype(np.uint64)
                got.append((name.view(np.int64), np.full(len(c), key), lo * 64 + c))
            if got:
                yield batch(schema, [np.concatenate(x) for x in zip(*got, strict=True)])

    return pieces.select("h", "key", "lo", "shape", "piece").mapInArrow(run, "name long, key long, at long")


def _window_rows(pieces: DataFrame, length: int) -> DataFrame:
    """(key, lo, shape, solo, piece, chunks) -> a row (two names, key, window, solo) for each window of the chunks."""
    schema = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("key", pa.int64()), ("p", pa.int64()), ("solo", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for key, lo, shape, solo, piece, chunks in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n, anchor = divmod(shape, 1024)
                text = np.frombuffer(piece, np.uint8)
                at = np.arange(n)
                at = at[np.isin((anchor - at) // CHUNK, chunks)]
                got.append((bucket_names(text, 0, length)[1][at], bucket_names(text, 1, length)[1][at], np.full(len(at), key), lo + at, np.full(len(at), solo)))
            if got:
                w1, w2, key, p, solo = (np.concatenate(x) for x in zip(*got, strict=True))
                yield batch(schema, [w1.view(np.int64), w2.view(np.int64), key, p, solo])

    return pieces.select("key", "lo", "shape", "solo", "piece", "chunks").mapInArrow(run, "w1 long, w2 long, key long, p long, solo boolean")


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs(key, data) -> (key, lo, hi): windows lo..hi of ``length`` bytes that also start elsewhere."""
    if not 2 * Q <= length < 1024:
        raise ValueError(f"length must be at least {2 * Q} and below 1024")
    rows = _anchor_rows(docs, length)
    shared = rows.groupBy("h").agg(F.count("*").alias("c"), F.min("k").alias("a"), F.max("k").alias("b"))
    shared = shared.where("c > 1").select("h", (F.col("a") == F.col("b")).alias("same"))
    # written first, so that a bucket with very many anchors is split in the join
    found = cut(rows.join(cut(shared), "h"))
    reps = found.where("not same").groupBy("h", "k").agg(F.count("*").alias("c"), F.min(F.struct("key", "lo", "shape")).alias("r"))
    reps = cut(reps)
    upto = (F.col("lo") + F.floor(F.col("shape") / 1024) - 1).alias("hi")
    sure = found.where("same").select("key", "lo", upto)
    alike = found.where("not same").join(reps.where("c > 1").select("h", "k"), ["h", "k"], "left_semi").select("key", "lo", upto)
    ranges = reps.groupBy("r.key").agg(F.collect_list(F.struct("h", "r.lo", "r.shape", (F.col("c") == 1).alias("solo"))).alias("ranges"))
    pieces = cut(_pieces(docs, ranges, length))
    met = _core_rows(pieces, length).withColumn("c", F.count("*").over(Window.partitionBy("name"))).where("c > 1")
    chunks = met.groupBy("key", F.shiftright("at", 6).alias("lo")).agg(F.collect_list(F.col("at").bitwiseAND(63)).alias("chunks"))
    windows = _window_rows(pieces.join(chunks, ["key", "lo"]), length)
    # equal windows side by side; the window spills, no group is collected
    counted = windows.withColumn("c", F.count("*").over(Window.partitionBy("w1", "w2"))).where("c > 1 and solo")
    single = counted.select("key", F.col("p").alias("lo"), F.col("p").alias("hi"))
    return sure.union(alike).union(single)


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, kept (binary), spans array<struct<start, end>>: bytes within strings of ``length`` bytes
    that also start elsewhere in the corpus, the same document included, are removed; judged on the input.

    A null text is empty; texts shorter than ``length`` keep all. Repeated rows are repeats of each other, a
    null doc_id stays null; other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    keyed = cut(docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.encode(text_of("text"), "UTF-8").alias("data")))
    spans = repeated(keyed.select("key", "data"), length).groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sizes, kept, spans = [], [], [], []
            found = b.column(2)
            for i in range(b.num_rows):
                data, merged = b.column(1)[i].as_py(), []
                if found[i].is_valid:
                    flat = found[i].values
                    lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy() + length
                    order = np.argsort(lo, kind="stable")
                    lo, hi = lo[order], np.maximum.accumulate(hi[order])
                    starts = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
                    merged = list(zip(lo[starts].tolist(), hi[np.concatenate([starts[1:], [len(lo)]]) - 1].tolist(), strict=True))
                parts, at = [], 0
                for s, e in merged:
                    parts.append(data[at:s])
                    at = e
                parts.append(data[at:])
                ids.append(b.column(0)[i].as_py())
                sizes.append(len(data))
                kept.append(b"".join(parts))
                spans.append([{"start": s, "end": e} for s, e in merged])
            yield batch(schema, [ids, sizes, kept, spans])

    joined = keyed.join(spans, "key", "left").select("doc_id", "data", "found")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op1."""
    found = removals(docs)
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
