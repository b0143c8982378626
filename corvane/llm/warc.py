"""WARC archives: one gzip member per record, revisit records for repeated payloads, a sequential verifying reader."""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import batch, bounded_batches, cut, shared_dir, text_of

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Record ids of our own pages; ids of foreign archives give no page_id.
OWN = "urn:x-page:"
#: Archives that one task reads at most follow from this many tasks.
MAX_TASKS = 10_000
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string())])
PAGES_DDL = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, level: int = 6) -> bytes:
    """One gzip member. A revisit carries the HTTP header alone; its Content-Length and payload digest are those of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block, digest = http if refers_to is not None else http + payload, sha1_base32(payload)
    uri = quote(url or "urn:none", safe="%:/?#[]@!$&'()*+,;=~")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{url} {digest}')}>" if page_id is None else f"<{OWN}{page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
    }
    if uri != url:  # what a URI cannot say, null included
        head["X-Url"] = json.dumps(url)
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{OWN}{refers_to}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in {**head, "Content-Length": len(block)}.items())
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def members(stream, size: int = 1 << 16) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time, without reading it whole."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(size)):
        parts.append(unpack.decompress(data))
        data = b""
        if unpack.eof:
            yield b"".join(parts)
            data, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def header_fields(lines: list[str]) -> dict[str, str]:
    """Fields by lower-case name; a line that begins with white space continues the one before it."""
    fields, name = {}, ""
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def verify(data: bytes, digest: str | None, what: str) -> None:
    """Raise where the data does not have its digest; no digest, or one by an algorithm unknown here, proves nothing."""
    algorithm, _, value = (digest or "").partition(":")
    algorithm = algorithm.lower().replace("-", "")
    if value and algorithm in hashlib.algorithms_guaranteed and not algorithm.startswith("shake"):
        found = hashlib.new(algorithm, data)
        if value.upper().rstrip("=") not in (base64.b32encode(found.digest()).decode().rstrip("="), found.hexdigest().upper()):
            raise ValueError(f"a {what} does not have its digest")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record; length and block digest are verified."""
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = header_fields(lines)
    n = int(fields.get("content-length", -1))
    block = rest[: max(n, 0)]
    if not version.startswith("WARC/") or len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("a record is not framed by its content length")
    verify(block, fields.get("warc-block-digest"), "block")
    return fields, block


def page_of(fields: dict[str, str], block: bytes) -> tuple | None:
    """The row of a response, revisit or resource record; None for records of other types."""
    kind = fields.get("warc-type", "").lower()
    if kind not in ("response", "revisit", "resource"):
        return None
    http, payload, declared = {}, block, None
    if fields.get("content-type", "").lower().startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = header_fields(head.decode("utf-8", "replace").split("\r\n")[1:])
        declared = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
    digest = fields.get("warc-payload-digest")
    if kind == "revisit":
        payload, size = None, declared
    else:
        size = len(payload)
        if "transfer-encoding" not in http:  # digests of a payload that travels in chunks may be of either form
            verify(payload, digest, "payload")
        digest = digest or f"sha1:{sha1_base32(payload)}"
    own = lambda name: int(x.removeprefix(OWN)) if (x := fields.get(name, "").strip("<>")).startswith(OWN) else None
    url = json.loads(fields["x-url"]) if "x-url" in fields else fields.get("warc-target-uri", "").strip("<>") or None
    bare = (digest or "").partition(":")[2] or None
    return own("warc-record-id"), url, payload, size, bare, kind, own("warc-refers-to"), fields.get("warc-record-id", "").strip("<>") or None


def write(pages: DataFrame, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write an archive per task into the shared folder; returns (path), one row for each archive of a finished task.

    Among equal payloads of at least ``min_bytes`` the smallest page_id is the response and others revisit it;
    several rows with that page_id are all responses. A null html is the empty payload, a null url stays null.
    Rows without page_id are responses unless a page with their payload has one. Very long pages are written
    whole, as one record each; an empty table writes no archive; other columns are ignored.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(text_of("html"), "UTF-8").alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    firsts = pages.select(F.col("page_id").cast("long"), F.sha2(F.encode(text_of("html"), "UTF-8"), 256).alias("key"))
    firsts = firsts.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    rows = rows.join(firsts, "key", "left").select(
        "page_id", "url", "payload", F.when((F.length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )
    schema = pa.schema([("path", pa.string())])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        path, out = f"{root}/{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz", None
        for b in batches:
            if out is None and b.num_rows:
                out = store.open_output_stream(path, compression=None)
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out.write(record(page_id, url, payload, first, date))
        if out is not None:
            out.close()
            yield batch(schema, [[path]])

    return cut(rows.mapInArrow(save, "path string"))


def read(paths: DataFrame, folder: str) -> DataFrame:
    """Rows of the archives at ``path``; each archive is read in sequence, record by record, and verified.

    One archive goes to one task, and as many tasks run as there are archives (at most MAX_TASKS). Records of
    other types than response, revisit and resource are verified and passed over. Archives of other writers
    give null page_id and refers_to; record_id is that of the record. No path, or an empty archive, gives no rows.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for b in batches:
            for path in b.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for member in members(stream):
                        page = page_of(*parse(member))
                        if page is None:
                            continue
                        rows.append(page)
                        held += len(member)
                        if held > 4 << 20:
                            yield batch(PAGES, [list(x) for x in zip(*rows, strict=True)])
                            rows, held = [], 0
                if rows:
                    yield batch(PAGES, [list(x) for x in zip(*rows, strict=True)])

    # a stated number of partitions is kept by adaptive execution; by path it would make one of such short rows
    return paths.repartition(min(MAX_TASKS, max(1, paths.count()))).mapInArrow(load, PAGES_DDL)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages and read them back: page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to, record_id."""
    return read(write(pages, min_bytes), shared_dir(pages.sparkSession))


def digest(pages: DataFrame) -> DataFrame:
    """The columns of query op6."""
    return round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
