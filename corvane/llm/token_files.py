"""Token ids in files: canonical Huffman codes of limited length from global counts, blocks that decode alone.

A file is a header (magic, JSON) with the code length of every id, then sections. A section holds whole documents: their
ids and lengths, the bit offset of every block of ``block`` ids (the checkpoints) and the codes as one stream of bits.
A block begins at its checkpoint and needs no other, so all blocks of a section are decoded side by side, one table
lookup an id. Numbers are little-endian; codes are written from their highest bit.
"""

from __future__ import annotations

import json
import os
import re
import string
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.llm.common import batch, bounded_batches, cut, shared_dir, text_of

MAGIC = b"TOKBITS1"
#: Files that one task reads at most follow from this many tasks.
MAX_TASKS = 10_000
#: Characters of distinct words that a worker remembers before it starts anew.
REMEMBERED = 14_000_000


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Bits of each symbol's code, none longer than ``max_bits``, the total least (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols have no code of {max_bits} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    levels, merged = [], leaves
    levels.append(np.ones(len(leaves), bool))
    for _ in range(max_bits - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        merged = both[order]
        levels.append(order < len(leaves))
    need, sizes = 2 * (len(used) - 1), np.zeros(len(used), np.int64)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:need].sum())
        sizes[:n] += 1
        need = 2 * (need - n)
    lengths[used] = sizes
    return lengths


@dataclass
class Code:
    """A canonical code: by length, then by symbol."""

    lengths: np.ndarray

    def __post_init__(self):
        self.bits = int(self.lengths.max(initial=1))
        used = np.flatnonzero(self.lengths)
        used = used[np.argsort(self.lengths[used], kind="stable")]
        share = np.left_shift(1, self.bits - self.lengths[used].astype(np.int64))
        first = np.cumsum(share) - share
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[used] = first >> (self.bits - self.lengths[used].astype(np.int64))
        #: for every string of ``bits`` bits the symbol it begins with and that symbol's length
        rest = (1 << self.bits) - int(share.sum())
        self.symbol = np.concatenate([np.repeat(used, share), np.zeros(rest, np.int64)]).astype(np.uint32)
        self.taken = np.concatenate([np.repeat(self.lengths[used], share), np.zeros(rest, np.uint8)]).astype(np.int64)

    def pack(self, ids: np.ndarray, block: int) -> tuple[np.ndarray, bytes]:
        """(bit offset of every block, the stream)."""
        size = self.lengths[ids].astype(np.int64)
        if not size.all():
            raise ValueError("an id has no code")
        ends = np.cumsum(size)
        at = ends - size
        total = int(ends[-1]) if len(ids) else 0
        shifted = self.codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
        # sums of disjoint bits of 32-bit words, exact in doubles
        n = (total + 31) // 32 + 1
        words = np.bincount(at >> 5, (shifted >> np.uint64(32)).astype(np.float64), n + 1)
        words += np.bincount((at >> 5) + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)
        return at[::block], words.astype(">u4").tobytes()[: (total + 7) // 8]

    def unpack(self, stream: bytes, offsets: np.ndarray, n: int, block: int) -> np.ndarray:
        """The ``n`` ids, all blocks side by side."""
        if not n:
            return np.zeros(0, np.uint32)
        held = stream + bytes(8 + self.bits * block // 8)
        windows = np.ndarray((len(held) - 3,), ">u4", held, strides=(1,))
        at, out = offsets.astype(np.int64), np.empty((min(block, n), len(offsets)), np.uint32)
        shift = np.uint32(32 - self.bits)
        for k in range(len(out)):
            key = (windows[at >> 3].astype(np.uint32) << (at & 7).astype(np.uint32)) >> shift
            out[k] = self.symbol[key]
            at += self.taken[key]
        return out.T.reshape(-1)[:n] if len(offsets) > 1 else out[:n, 0]

    def header(self, block: int) -> bytes:
        said = json.dumps({"block": block, "symbols": len(self.lengths)}).encode()
        table = zlib.compress(self.lengths.tobytes())
        return MAGIC + np.array([len(said), len(table)], "<u4").tobytes() + said + table


def section(code: Code, doc_ids: list, ids: list[np.ndarray], block: int) -> bytes:
    """Whole documents: counts, ids and lengths, checkpoints, bits, and the CRC-32 of it all."""
    offsets, stream = code.pack(np.concatenate(ids), block)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    body = b"".join([np.array([x or 0 for x in doc_ids], "<i8").tobytes(), known.tobytes(), np.array([len(x) for x in ids], "<u8").tobytes(), offsets.astype("<u8").tobytes(), stream])
    head = np.array([len(doc_ids), len(offsets), len(stream), zlib.crc32(body)], "<u8").tobytes()
    return head + body


def documents(stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) in the order of a file, section by section; raises where a section is cut short or damaged."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of token ids")
    said, table = np.frombuffer(stream.read(8), "<u4")
    block = json.loads(stream.read(int(said)))["block"]
    code = Code(np.frombuffer(zlib.decompress(stream.read(int(table))), np.uint8))
    while head := stream.read(32):
        docs, blocks, size, crc = map(int, np.frombuffer(head, "<u8"))
        body = stream.read(17 * docs + 8 * blocks + size)
        if len(head) != 32 or zlib.crc32(body) != crc:
            raise ValueError("a section is damaged")
        doc_ids, known = np.frombuffer(body, "<i8", docs), np.frombuffer(body, np.uint8, docs, 8 * docs)
        lengths = np.frombuffer(body, "<u8", docs, 9 * docs).astype(np.int64)
        ids = code.unpack(body[17 * docs + 8 * blocks :], np.frombuffer(body, "<u8", blocks, 17 * docs), int(lengths.sum()), block)
        for doc_id, there, end, n in zip(doc_ids.tolist(), known.tolist(), np.cumsum(lengths).tolist(), lengths.tolist(), strict=True):
            yield doc_id if there else None, ids[end - n : end]


class Units:
    """The library's ids of a text, by units that it encodes alone: a text parts at a space after another character.

    No pre-token has a space after another character and none looks past it, so the ids of a text are those of its units.
    Units are remembered; the new ones of a batch go to the library in one call, joined as they would stand in a text.
    """

    def __init__(self, data: bytes):
        self.library = tokenizers.Tokenizer.from_buffer(data)
        said = json.loads(data)
        if said["normalizer"] or said["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("only byte-level tokenizers without a prefix space are read by units")
        #: the same merges for units of letters alone: each is one pre-token, so their ends need not be looked for
        self.letters = tokenizers.Tokenizer.from_buffer(data)
        self.letters.pre_tokenizer = tokenizers.pre_tokenizers.CharDelimiterSplit("\n")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that the file writes as the characters of their numbers
        others = [b for b in range(256) if b not in plain]
        self.written = {b: 256 + n for n, b in enumerate(others) if b != 10}
        strings = {i: s for s, i in self.library.get_vocab(with_added_tokens=True).items()}
        #: bytes that each id stands for; the file says a byte by one character
        self.size = np.array([len(strings.get(i, "")) for i in range(max(strings) + 1)], np.int64)
        self.width = np.dtype("<u2" if len(self.size) <= 1 << 16 else "<u4")
        self.inner: dict[str, bytes | None] = {}
        self.heads: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.held = 0

    def alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.width).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: list[str]) -> None:
        """Remember units, each without the space before it."""
        self.held += sum(map(len, new))
        letters, rest = list(filter(str.isalpha, new)), list(filterfalse(str.isalpha, new))
        # letters and the punctuation that ends them are two pre-tokens
        ended = [(u, b) for u, b in zip(rest, [u.rstrip(string.punctuation) for u in rest], strict=True) if len(b) < len(u) and b.isalpha()]
        bases = [b for _, b in ended]
        letters += set(bases).difference(self.inner, letters)
        for some in (list(filter(str.isascii, letters)), list(filterfalse(str.isascii, letters))):
            if some:
                text = "\n".join(some)
                text = text if text.isascii() else text.encode().decode("latin-1").translate(self.written)
                space = chr(self.written[32])
                ids = self.letters.encode_batch_fast([space + text.replace("\n", f"\n{space}")], add_special_tokens=False)[0].ids
                self.part(some, list(map(len, text.split("\n"))), ids)
        tails = [u[len(b) :] for u, b in ended]
        if unknown := list(set(tails).difference(self.tails)):
            self.tails.update(zip(unknown, self.alone(unknown), strict=True))
        self.inner.update([(u, self.inner[b] + self.tails[t]) for (u, b), t in zip(ended, tails, strict=True)])
        rest = list(set(rest) - dict(ended).keys())
        odd = [u for u in rest if not u or u[0].isspace() or u[-1].isspace()]
        self.inner.update(zip(odd, self.alone([" " + u for u in odd]), strict=True))
        mixed = list(set(rest) - set(odd))
        if mixed:
            self.part(mixed, [len(u.encode()) for u in mixed], self.library.encode_batch_fast([" " + " ".join(mixed)], add_special_tokens=False)[0].ids)

    def part(self, units: list[str], sizes: list[int], ids: list[int]) -> None:
        """Deal the ids of units that stand one after another, each with a space before it, out to them, by the bytes each id stands for."""
        found = np.array(ids, self.width)
        ends = np.searchsorted(np.cumsum(self.size[found]), np.cumsum(np.array(sizes, np.int64) + 1), side="right") * self.width.itemsize
        raw, ends = found.tobytes(), ends.tolist()
        self.inner.update(zip(units, [raw[x:y] for x, y in zip([0, *ends], ends, strict=False)], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of ``width``."""
        split = [units(t) for t in texts]
        heads = [u.pop(0) for u in split]
        if new := list(set(heads).difference(self.heads)):
            self.heads.update(zip(new, self.alone(new), strict=True))
            self.held += sum(map(len, new))
        if new := list(set().union(*split).difference(self.inner)):
            self.learn(new)
        out = [self.heads[h] + b"".join(map(self.inner.__getitem__, u)) for h, u in zip(heads, split, strict=True)]
        if self.held > REMEMBERED:
            self.inner, self.heads, self.tails, self.held = {}, {}, {}, 0
        return out


#: a space that follows white space, or begins the text: there a text does not part
_LOOSE = re.compile(r"(?:^|[\s\x85\u180e]) ")

#: The same pairs in a text of ASCII.
_PAIRS = [f"{x} " for x in " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"]


def units(text: str) -> list[str]:
    """The text parted at its spaces, save at those after white space; the spaces between units are left out."""
    parts = text.split(" ")
    if not (any(x in text for x in _PAIRS) or text[:1] == " ") if text.isascii() else not _LOOSE.search(text):
        return parts
    found, held = [], [parts[0]]
    for part in parts[1:]:
        last = held[-1]
        if last and not _LOOSE.match(last[-1] + " "):
            found.append(" ".join(held))
            held = [part]
        else:
            held.append(part)
    return [*found, " ".join(held)]


_LOADED: dict[int, Units] = {}


class Library:
    """A tokenizer file; read once by the driver and broadcast (its size is checked)."""

    def __init__(self, spark: SparkSession, path: str, max_bytes: int = 32 << 20):
        with open(path, "rb") as f:
            data = f.read(max_bytes + 1)
        if len(data) > max_bytes:
            raise ValueError(f"{path} is larger than {max_bytes} bytes")
        self.shared = spark.sparkContext.broadcast(data)

    def units(self) -> Units:
        data = self.shared.value
        key = zlib.crc32(data)
        if key not in _LOADED:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            _LOADED[key] = Units(data)
        return _LOADED[key]


ENCODED = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())])


def encoded(docs: DataFrame, library: Library, end_id: int) -> DataFrame:
    """(part, seq, doc_id, width, ids): tokens of each whole text and ``end_id``, by ascending doc_id over parts and places; in the shared folder.

    Rows without doc_id come first; equal ids go by a hash of their texts, then by the texts, and share no one task for it.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, part, seq = library.units(), TaskContext.get().partitionId(), 0
        end = np.array([end_id], found.width).tobytes()
        for b in batches:
            ids = [x + end for x in found.encode(b.column(1).to_pylist())]
            n = b.num_rows
            yield batch(ENCODED, [[part] * n, np.arange(seq, seq + n), b.column(0), [found.width.itemsize] * n, ids])
            seq += n

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    return cut(rows.select("doc_id", "text").mapInArrow(run, "part int, seq long, doc_id long, width int, ids binary"))


def id_counts(rows: DataFrame) -> dict[int, int]:
    """How often each id occurs; as many rows reach the driver as there are ids in the vocabulary, at most."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for width, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                n = np.bincount(np.frombuffer(x.as_buffer(), f"<u{width}"))
                if len(n) > len(total):
                    n, total = total, n.astype(np.int64)
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield batch(schema, [used, total[used]])

    found = rows.select("width", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r.id: r.n for r in found.collect()}


def write(rows: DataFrame, max_bits: int = 18, block: int = 1024, ids_a_section: int = 1 << 20) -> DataFrame:
    """Write rows of ``encoded`` as files into the shared folder; (path, part, seq, n_docs, n_ids), one row a finished file.

    Code lengths come from the counts of all rows. A file holds neighbouring rows of one part; a document is never split
    over sections, however long. No rows: no file.
    """
    spark, counts = rows.sparkSession, id_counts(rows)
    bounded_batches(spark)
    table = np.zeros(max(counts, default=-1) + 1, np.int64)
    for i, n in counts.items():
        table[i] = n
    lengths = spark.sparkContext.broadcast(code_lengths(table, max(max_bits, int(len(counts) - 1).bit_length() if counts else 1)).tobytes())
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    schema = pa.schema([("path", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(np.frombuffer(lengths.value, np.uint8))
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        task, files, out, at = TaskContext.get(), [], None, None
        doc_ids, ids, held = [], [], 0

        def flush():
            if doc_ids:
                out.write(section(code, doc_ids, ids, block))
                files[-1][3] += len(doc_ids)
                files[-1][4] += held
            doc_ids.clear(), ids.clear()

        for b in batches:
            for part, seq, doc_id, width, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != (part, seq):
                    if out is not None:
                        flush()
                        out.close()
                    held, path = 0, f"{root}/{part:06d}-{seq:012d}-{task.taskAttemptId()}.tokens"
                    out = store.open_output_stream(path, compression=None)
                    out.write(code.header(block))
                    files.append([path, part, seq, 0, 0])
                at = (part, seq + 1)
                doc_ids.append(doc_id)
                ids.append(np.frombuffer(x, f"<u{width}"))
                held += len(ids[-1])
                if held >= ids_a_section:
                    flush()
                    held = 0
        if out is not None:
            flush()
            out.close()
            yield batch(schema, [list(x) for x in zip(*files, strict=True)])

    return cut(rows.mapInArrow(run, "path string, part int, seq long, n_docs long, n_ids long"))


def _store(folder: str):
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _scan(files: DataFrame, folder: str, schema: pa.Schema, ddl: str, value: Callable[[np.ndarray], object]) -> DataFrame:
    """A row a document: doc_id, start, n_tokens and a value of its ids. One file goes to one task, as many tasks run as there are files."""
    # one row a file, so the window that adds up what stands before is short
    before = F.sum("n_ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.withColumn("start", F.coalesce(before, F.lit(0))).select("path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(folder)
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for doc_id, ids in documents(stream):
                        rows.append((doc_id, start, len(ids), value(ids)))
                        start += len(ids)
                        held += len(ids)
                        if held >= 1 << 20 or len(rows) >= 10_000:
                            yield batch(schema, [list(x) for x in zip(*rows, strict=True)])
                            rows, held = [], 0
                if rows:
                    yield batch(schema, [list(x) for x in zip(*rows, strict=True)])

    return placed.repartition(min(MAX_TASKS, max(1, files.count()))).mapInArrow(run, ddl)


def read(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids array<int> of what ``write`` wrote below ``folder``; start counts the ids of all documents before."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return _scan(files, folder, schema, "doc_id long, start long, n_tokens long, ids array<int>", lambda ids: ids.astype(np.int32))


def round_trip(docs: DataFrame, library: Library, end_id: int, **sizes: int) -> DataFrame:
    """Encode, write and read back: doc_id, start, n_tokens, ids.

    A null text is empty, so its only token is ``end_id``. Rows without doc_id stay and come first; repeated ids stay, one
    row each; other columns are ignored; an empty table gives no rows.
    """
    return read(write(encoded(docs, library, end_id), **sizes), shared_dir(docs.sparkSession))


def digest(docs: DataFrame, library: Library, end_id: int, **sizes: int) -> DataFrame:
    """The columns of query op13, from the files."""
    files = write(encoded(docs, library, end_id), **sizes)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    return _scan(files, shared_dir(docs.sparkSession), schema, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
