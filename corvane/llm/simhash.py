"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint carries a nonzero vector m(i) of GF(2)^(radius+1). Table v (a nonzero vector too)
keeps the bits with <m(i), v> = 1. The vectors of any ``radius`` differing bits span less than the whole
space, so some v is orthogonal to all of them, and in its table the two fingerprints agree: every pair
within the radius meets, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corvane.llm.common import batch, bounded_batches, cut, row_hash, text_of, unnested
from corvane.llm.components import components

BITS = 64
#: Fingerprints of a bucket that one task compares at once; a larger bucket is divided first.
BLOCK = 1024
#: Stands for a missing doc_id in the names of fingerprints: the greatest, so that it never names a class of others.
NO_ID = (1 << 63) - 1


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1) - 1 bit masks, as signed 64-bit integers."""
    n = 2 ** (radius + 1) - 1
    masks = [sum(1 << i for i in range(BITS) if bin((1 + i % n) & v).count("1") % 2) for v in range(1, n + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of a text, signed: bit set where over half of the shingle hashes have it."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) <= words:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = np.array(hashes[at : at + (1 << 15)], np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep``, fp (signed 64-bit). A null or blank text has fingerprint zero."""
    bounded_batches(docs.sparkSession)
    frame = docs.select(F.col("doc_id").cast("long"), *keep, F.col("text").cast("string"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.drop("text").schema) + ", fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = pa.array([fingerprint(x, words) for x in b.column(b.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], prints], names=[*b.schema.names[:-1], "fp"])

    return frame.mapInArrow(run, ddl)


def _spanning(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (places in left and then right) that connect all that is linked within a block, or between two: a forest, not all pairs."""
    near = lambda a, b: np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    if right is None:
        adj = near(left, left)
        np.fill_diagonal(adj, False)
    else:
        adj = np.zeros((len(left) + len(right),) * 2, bool)
        adj[: len(left), len(left) :] = near(left, right)
        adj |= adj.T
    open_, us, vs = adj.any(axis=1), [], []
    while open_.any():
        frontier = np.array([int(np.argmax(open_))])
        open_[frontier] = False
        while len(frontier):
            reach = adj[frontier] & open_[None, :]
            new = np.flatnonzero(reach.any(axis=0))
            us.append(frontier[np.argmax(reach[:, new], axis=0)])
            vs.append(new)
            open_[new] = False
            frontier = new
    none = np.empty(0, np.int64)
    return (np.concatenate(us) if us else none), (np.concatenate(vs) if vs else none)


def _links_of_sorted(radius: int):
    """Rows (group columns..., part, id, fp), those of a group side by side -> links; one group is held at a time."""
    schema = pa.schema([(c, pa.int64()) for c in ("u_id", "u_fp", "v_id", "v_fp")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for b in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
            rows = rows if held is None else np.concatenate([held, rows])
            last = np.flatnonzero((rows[:, :-3] != rows[-1, :-3]).any(axis=1))
            done = int(last[-1]) + 1 if len(last) else 0
            held = rows[done:]
            yield from links(rows[:done])
        if held is not None:
            yield from links(held)

    def links(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        fps, part = np.ascontiguousarray(rows[:, -1]).view(np.uint64), rows[:, -3]
        starts = np.flatnonzero(np.concatenate([[True], (rows[1:, :-3] != rows[:-1, :-3]).any(axis=1)]))
        ends = np.concatenate([starts[1:], [len(rows)]])
        # two rows of one group are compared at once for all groups; two rows on one side of a pair of blocks are no pair
        pairs = starts[ends - starts == 2]
        near = pairs[(np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= radius)]
        us, vs = [near], [near + 1]
        for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
            order = s + np.argsort(part[s:e], kind="stable")
            split = int((part[s:e] == 0).sum())
            u, v = _spanning(fps[order[:split]], fps[order[split:]] if split < e - s else None, radius)
            us.append(order[u])
            vs.append(order[v])
        u, v = np.concatenate(us), np.concatenate(vs)
        if len(u):
            yield batch(schema, [rows[u, -2], rows[u, -1], rows[v, -2], rows[v, -1]])

    return run


def _parts(radius: int) -> list[list[int]]:
    """For each table, ``radius`` + 1 masks that share out the bits it leaves open: a near pair of its bucket agrees under one of them."""
    shared = []
    for m in covering_masks(radius):
        open_ = [i for i in range(BITS) if not m >> i & 1]
        masks = [sum(1 << i for i in open_[j :: radius + 1]) for j in range(radius + 1)]
        shared.append([x - (1 << BITS) if x >> (BITS - 1) else x for x in masks])
    return shared


def near_links(distinct: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (id, fp) -> links (u, v) of such pairs that connect all fingerprints within ``radius`` of each other.

    Each (table, masked value) is a bucket. A bucket beyond ``block`` is divided by the bits that its table
    leaves open, in ``radius`` + 1 ways; what is still beyond it is dealt out as pairs of blocks over many
    tasks. None is dropped or capped.
    """
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(covering_masks(radius))]))
    rows = distinct.select("id", "fp", keys.alias("b")).select("b.t", "b.k", "id", "fp")
    counted = rows.withColumn("n", F.count("*").over(Window.partitionBy("t", "k"))).where("n > 1")
    # the rows of a bucket are already side by side
    plain = counted.where(F.col("n") <= block).sortWithinPartitions("t", "k").select("t", "k", F.lit(0).alias("part"), "id", "fp")
    masks = F.array(*[F.array(*map(F.lit, ms)) for ms in _parts(radius)])
    hot = counted.where(F.col("n") > block).select("t", "k", "id", "fp", F.posexplode(F.get(masks, F.col("t"))).alias("sub", "mask"))
    hot = hot.select("t", "k", "sub", F.col("fp").bitwiseAND(F.col("mask")).alias("k2"), "id", "fp")
    hot = hot.withColumn("n", F.count("*").over(Window.partitionBy("t", "k", "sub", "k2"))).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = hot.select("t", "k", "sub", "k2", "id", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    group = ["t", "k", "sub", "k2", "lo", "hi"]
    side = F.when(F.col("own") > F.col("other"), 1).otherwise(0)
    dealt = dealt.select("t", "k", "sub", "k2", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), side.alias("part"), "id", "fp")
    dealt = dealt.repartition(*group).sortWithinPartitions(*group)
    ddl = "u_id long, u_fp long, v_id long, v_fp long"
    found = plain.mapInArrow(_links_of_sorted(radius), ddl).union(dealt.mapInArrow(_links_of_sorted(radius), ddl))
    node = lambda x: F.struct(F.col(f"{x}_id").alias("id"), F.col(f"{x}_fp").alias("fp")).alias(x)
    return found.select(node("u"), node("v")).distinct()


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """fp, root (id, fp): fingerprints are named by their least doc_id first, so the least name of a class is the least of its doc_ids."""
    least = prints.groupBy("fp").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("id"))
    roots = components(near_links(least, radius)).select(F.col("node.fp").alias("fp"), "root")
    return least.join(roots, "fp", "left").select("fp", F.coalesce("root", F.struct("id", "fp")).alias("root"))


def near_duplicates(docs: DataFrame, radius: int = 4, words: int = 4) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that links of at most ``radius`` bits reach.

    Null or blank texts have fingerprint zero and are linked like any other. Repeated rows stay, each with
    the class of its text. Rows without doc_id (or with 2^63 - 1) stay and never give their class its name; a
    class of only such rows has component_id null. An empty table gives no rows. Other columns are ignored.
    """
    prints = cut(fingerprints(docs, words))
    classes = _classes(prints, radius).select("fp", F.nullif(F.col("root.id"), F.lit(NO_ID)).alias("component_id"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = 4) -> DataFrame:
    """One row of each class, with all its columns: the one with the smallest doc_id, rows without one last.

    Rows are judged by the class of their own text: two texts under one doc_id may both stay, and unnamed rows
    go where their class has a named one. Of equal rows one stays; other ties fall by a hash of the row.
    """
    columns = docs.columns
    keyed = docs.select(F.struct("*").alias("row"), F.sha2(text_of("text"), 256).alias("text_key"), row_hash(docs).alias("row_key"))
    prints = cut(fingerprints(keyed.select(F.col("row.doc_id").alias("doc_id"), "text_key", "row_key", F.col("row.text").alias("text")), keep=("text_key", "row_key")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "row_key")).alias("first")
    # every fingerprint sends its best row only, so a class of very many copies is no large group
    best = prints.groupBy("fp").agg(first).join(_classes(prints, radius), "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = keyed.join(best.select("first.text_key", "first.row_key"), ["text_key", "row_key"], "left_semi").dropDuplicates(["text_key", "row_key"])
    return unnested(kept, columns)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op4: fingerprint as 16 hex digits, and the class."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component_id").cast(T.LongType()))
