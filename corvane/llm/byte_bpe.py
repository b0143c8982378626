"""Byte-level BPE by overlapping chunks: split long texts, stitch where token boundaries agree, encode the pieces.

A chunk sees ``overlap`` characters beyond both its ends. A boundary between a non-space and a following
space holds in every reading of the text (no pre-token has a space after another character), so the first
such boundary in the overlap that both neighbours find is where the left one ends and the right one begins.
Chunks without one are joined to their left neighbour before they are encoded.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.llm.common import batch, bounded_batches, text_of

_LOADED: dict[int, tiktoken.Encoding] = {}


class Vocabulary:
    """A rank file and its splitting pattern; the file is read once by the driver and broadcast (its size is checked)."""

    def __init__(self, spark: SparkSession, path: str, pattern: str, max_bytes: int = 32 << 20):
        with open(path, "rb") as f:
            data = f.read(max_bytes + 1)
        if len(data) > max_bytes:
            raise ValueError(f"{path} is larger than {max_bytes} bytes")
        self.pattern, self.shared = pattern, spark.sparkContext.broadcast(data)

    def encoding(self) -> tiktoken.Encoding:
        key = hash((self.pattern, len(self.shared.value), self.shared.value[:4096]))
        if key not in _LOADED:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.shared.value.splitlines()) if a}
            _LOADED[key] = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return _LOADED[key]


def boundaries(text: str, pattern: str, start: int, low: int, high: int) -> list[int]:
    """Token starts in [low, high) that lie between a non-space and a space, pre-tokenising from ``start``."""
    found = []
    for m in regex.compile(pattern).finditer(text, start):
        at = m.start()
        if at >= high:
            break
        if at >= low and at > 0 and text[at].isspace() and not text[at - 1].isspace():
            found.append(at)
    return found


def pieces(docs: DataFrame, pattern: str, chunk: int = 1 << 16, overlap: int = 1 << 10) -> DataFrame:
    """(doc_key, doc_id, piece_no, piece): texts longer than ``chunk``, cut where any reading has a token boundary.

    doc_key tells repeated rows apart.
    """
    keyed = docs.select(F.monotonically_increasing_id().alias("doc_key"), F.col("doc_id").cast("long"), text_of("text").alias("text"))
    long_ = keyed.where(F.length("text") > chunk)
    cuts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk).cast("int"))
    rows = long_.select("doc_key", "doc_id", "text", F.explode(cuts).alias("no")).select(
        "doc_key", "doc_id", "no", F.substring("text", F.greatest(F.lit(0), F.col("no") * chunk - overlap) + 1, F.lit(chunk + 2 * overlap)).alias("seen")
    )
    schema = pa.schema([("doc_key", pa.int64()), ("doc_id", pa.int64()), ("no", pa.int32()), ("seen", pa.string()), ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64()))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = [], []
            for no, seen in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                base = max(0, no * chunk - overlap)
                left.append([base + x for x in boundaries(seen, pattern, 0, 0, 2 * overlap)] if no else [])
                edge = (no + 1) * chunk - overlap - base
                right.append([base + x for x in boundaries(seen, pattern, 0, edge, edge + 2 * overlap)])
            yield batch(schema, [*b.columns, left, right])

    spread = rows.repartition("doc_key", "no").mapInArrow(split, "doc_key long, doc_id long, no int, seen string, left array<long>, right array<long>")
    order = Window.partitionBy("doc_key").orderBy("no")
    stitched = spread.withColumn("agreed", F.array_min(F.array_intersect("left", F.lag("right").over(order))))
    stitched = stitched.withColumn("run", F.sum(F.when(F.col("agreed").isNotNull() | (F.col("no") == 0), 1).otherwise(0)).over(order))
    stitched = stitched.withColumn("end", F.lead("agreed").over(order))
    base = F.greatest(F.lit(0), F.col("no") * chunk - overlap)
    begin = F.coalesce("agreed", F.col("no") * chunk)
    # a chunk that found no agreed boundary starts at its nominal place and is glued to its left neighbour
    upto = F.coalesce("end", (F.col("no") + 1) * chunk)
    text = F.substring("seen", (begin - base + 1).cast("int"), (upto - begin).cast("int"))
    parts = stitched.select("doc_key", "doc_id", "run", F.struct("no", text.alias("x")).alias("part"))
    joined = parts.groupBy("doc_key", "doc_id", "run").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return joined.select("doc_key", "doc_id", F.col("run").cast("int").alias("piece_no"), F.array_join(F.col("parts.x"), "").alias("piece"))


def encode(docs: DataFrame, vocabulary: Vocabulary, chunk: int = 1 << 16, overlap: int = 1 << 10) -> DataFrame:
    """doc_id, ids array<int>, decoded binary: the tokens of each whole text, and the bytes they stand for.

    A null text is the empty one (no tokens). Repeated rows and rows without doc_id stay, one result each.
    Other columns are ignored. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_key", pa.int64()), ("doc_id", pa.int64()), ("piece_no", pa.int32()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocabulary.encoding()
        for b in batches:
            ids = [enc.encode_ordinary(x) for x in b.column(3).to_pylist()]
            yield batch(schema, [*b.columns[:3], ids, [enc.decode_bytes(x) for x in ids]])

    ddl = "doc_key long, doc_id long, piece_no int, ids array<int>, decoded binary"
    # texts of one chunk are one piece and are not shuffled
    short = docs.select(F.lit(0).cast("long").alias("doc_key"), F.col("doc_id").cast("long"), F.lit(0).alias("piece_no"), text_of("text").alias("piece")).where(F.length("piece") <= chunk)
    single = short.mapInArrow(run, ddl).select("doc_id", "ids", "decoded")
    many = pieces(docs, vocabulary.pattern, chunk, overlap).mapInArrow(run, ddl)
    many = many.groupBy("doc_key", "doc_id").agg(F.sort_array(F.collect_list(F.struct("piece_no", "ids", "decoded"))).alias("p"))
    # joined at once: bytes put together piece by piece would be copied as often as there are pieces
    decoded = F.unhex(F.array_join(F.transform("p.decoded", lambda x: F.hex(x)), ""))
    return single.unionByName(many.select("doc_id", F.flatten("p.ids").alias("ids"), decoded.alias("decoded")))


def digest(docs: DataFrame, vocabulary: Vocabulary, **sizes: int) -> DataFrame:
    """The columns of query op5."""
    found = encode(docs, vocabulary, **sizes)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
