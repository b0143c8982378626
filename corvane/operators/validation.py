"""Draft-04 validation of documents by schemas, told as one legible fault a document.

A verdict follows from one document and one schema alone, so documents are judged where they stand, a task's texts one after the
other (``functions.draft04``), and no pair of their nodes is ever a row. What a task holds is one document and the schemas it meets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from corvane.functions.draft04 import Schema, deeply, parsed
from corvane.operators.schemas import canonical, depth, texts
from corvane.session import FEW, settled

_NUMBERS = ("integer", "number")
_SAID = ["valid", "pointer", "keyword", "schema_pointer", "said"]
#: Documents of one schema are dealt into so many shares at most, where schemas are sorted before them.
SHARES = 256


def subtrees(tree: DataFrame, tops: DataFrame) -> DataFrame:
    """tops(doc, pointer) of containers -> doc, pointer, json: the canonical text of what stands there, numbers by value."""
    tops = tops.select(F.col("doc").alias("d"), F.col("pointer").alias("top")).distinct()
    inner = tree.join(tops, tree.doc.eqNullSafe(tops.d) & ((tree.pointer == tops.top) | F.startswith(tree.pointer, F.concat(tops.top, F.lit("/")))))
    n = depth("top")
    inner = inner.select(
        F.struct("doc", "top").alias("doc"), F.slice("path", n + 1, F.lit(1 << 30)).alias("path"), F.substring("within", n + 1, F.lit(1 << 30)).alias("within"),
        "kind", F.when(F.col("kind").isin(*_NUMBERS), number("value")).otherwise(F.col("value")).alias("value"))
    return canonical(inner).select("doc.doc", F.col("doc.top").alias("pointer"), "json")


def number(value: str) -> Column:
    """A number's text, the same for all ways to write its value: integers stay, others of a whole value become one."""
    v = F.col(value)
    whole = F.expr(f"try_cast({value} as double) = floor(try_cast({value} as double)) and abs(try_cast({value} as double)) < 1e15")
    return F.when(v.rlike(r"^-?\d+$"), v).when(whole, F.expr(f"cast(cast({value} as double) as long)").cast("string")).otherwise(F.expr(f"cast(try_cast({value} as double) as string)"))


def single(kind: str = "kind", value: str = "value") -> Column:
    """A text that is equal for equal single values and for no others; null for containers."""
    k = F.col(kind)
    return F.when(k.isin(*_NUMBERS), F.concat(F.lit("n"), number(value))).when(~k.isin("object", "array"), F.concat(F.substring(k, 1, 2), F.lit(":"), F.coalesce(F.col(value), F.lit(""))))


def _judge(texts: Iterator[tuple[str | None, Schema | None]]) -> list[pa.Array]:
    """valid, pointer, keyword, schema_pointer, said of each text by its schema; without one it has no fault."""
    columns: tuple[list, ...] = ([], [], [], [], [])
    for text, schema in texts:
        try:
            value = parsed(text)
        except (ValueError, RecursionError):
            row = (False, None, None, None, "no JSON")
        else:
            fault = schema and deeply(schema.verdict, value)
            row = (False, *fault) if fault else (True, None, None, None, None)
        for column, x in zip(columns, row, strict=True):
            column.append(x)
    return [pa.array(c, pa.bool_() if n == "valid" else pa.string()) for c, n in zip(columns, _SAID, strict=True)]


def _read(text: str) -> Schema | None:
    value = parsed(text)
    return Schema(value) if isinstance(value, dict) else None


def judged(asked: DataFrame, schemas: DataFrame) -> DataFrame:
    """asked(doc, schema, text, ..), the node table of schemas -> the columns of asked, then valid, pointer, keyword, schema_pointer, said: one row for each.

    Verdicts as ``verdicts`` tells them. A few schemas are sent to every task and no document is shuffled; of many, each comes
    sorted before a share of its documents, so a task holds one at a time and a schema of many documents is more than one task.
    """
    schemas, kept = settled(schemas), asked.columns
    held = texts(schemas)
    out = StructType([*asked.schema, *[StructField(n, BooleanType() if n == "valid" else StringType()) for n in _SAID]])
    if schemas.count() > FEW:
        return _sorted(asked, held).mapInArrow(_by_lead(kept), out)
    rows = held.collect()
    known = [r.json for r in rows]
    at = asked.sparkSession.createDataFrame([(r.doc, i) for i, r in enumerate(rows)], StructType([StructField("_doc", schemas.schema["doc"].dataType), StructField("_at", LongType())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [_read(t) for t in known]
        for b in batches:
            found = _judge((t, None if i is None else read[i]) for t, i in zip(b.column("text").to_pylist(), b.column("_at").to_pylist(), strict=True))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *found], names=out.names)

    return asked.join(F.broadcast(at), F.col("schema").eqNullSafe(F.col("_doc")), "left").drop("_doc").mapInArrow(run, out)


def _sorted(asked: DataFrame, held: DataFrame) -> DataFrame:
    """asked plus _lead, the text of a schema, in rows of their own before those of its documents in each share of them."""
    share = F.pmod(F.xxhash64("doc", "text"), F.lit(SHARES))
    rows = asked.withColumns({"_share": share, "_lead": F.lit(None).cast("string")})
    met = asked.select(F.col("schema").alias("_schema"), share.alias("_share")).distinct().join(held.hint("merge"), F.col("_schema").eqNullSafe(F.col("doc")), "left")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in asked.schema if f.name != "schema"]
    leads = met.select(F.col("_schema").alias("schema"), "_share", F.coalesce("json", F.lit("null")).alias("_lead"), *empty)
    return rows.unionByName(leads).repartition("schema", "_share").sortWithinPartitions("schema", "_share", F.col("_lead").isNull())


def _by_lead(kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def met(b):
            nonlocal schema
            for text, lead in zip(b.column("text").to_pylist(), b.column("_lead").to_pylist(), strict=True):
                if lead is None:
                    yield text, schema
                else:
                    schema = _read(lead)

        for b in batches:
            found = _judge(met(b))
            rows = b.filter(pc.is_null(b.column("_lead")))
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], *found], names=[*kept, *_SAID])

    return run


def verdicts(docs: DataFrame, tree: DataFrame, schemas: DataFrame, owners: DataFrame) -> DataFrame:
    """docs(doc, ..), node tables of instances and schemas, owners(doc, schema) -> doc, schema, valid, pointer, keyword, schema_pointer, said.

    One fault for each invalid document: the first in the order of the schema's keywords, followed through each union into the one
    alternative that its discriminator (an enum one step below) does not refuse, to the deepest fault there; where it refuses all,
    the union's own verdict with the declared values; where it selects none alone, the alternatives' names. A verdict of a union
    has no keyword. Documents without a node are no JSON; a schema that is no object, or not there, finds no fault. A reference is
    followed within its schema, keywords beside it say nothing; patterns are those of Python. Containers are told by their kind.
    Documents are put together from their nodes; where their texts are at hand, ``judged`` needs no shuffle of them.
    """
    own = owners.select(F.col("doc").alias("od"), "schema").distinct()
    every = docs.select("doc").distinct().hint("merge").join(own, F.col("doc").eqNullSafe(own.od)).drop("od")
    whole = texts(tree).select(F.col("doc").alias("td"), F.col("json").alias("text")).hint("merge")
    return judged(every.join(whole, F.col("doc").eqNullSafe(whole.td), "left").drop("td"), schemas).drop("text")
