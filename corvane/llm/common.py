"""What the training-data operators share: Arrow batching, the shared folder, null handling."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that very long texts do not pile up in one batch."""
    for key, value, default in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000", "10000"),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20), None),
    ):
        if default is None or spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, one of our own on a local master; elsewhere an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = os.path.join(tempfile.gettempdir(), "checkpoints")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write the rows into the shared folder and read them from there: lost executors cost no recomputation."""
    spark = df.sparkSession
    shared_dir(spark)
    path = f"{shared_dir(spark)}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` bound to ``value``: bound once, however the optimiser moves the expression."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def text_of(name: str) -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_hash(df: DataFrame) -> Column:
    """A hash over all columns of a row; columns of types that cannot be hashed as they are go in as JSON."""
    plain = lambda t: isinstance(t, T.AtomicType)
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    return F.xxhash64(*[quoted(f.name) if plain(f.dataType) else F.to_json(F.struct(quoted(f.name))) for f in df.schema])


def nested(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns as one struct, so that no name of theirs can clash with those of an operator."""
    return df.select(F.struct("*").alias(name))


def unnested(df: DataFrame, columns: list[str], name: str = "row", **replaced: Column) -> DataFrame:
    """The columns of the struct again, some of them replaced."""
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col(name).getField(c).alias(c) for c in columns])


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A record batch of plain lists or numpy arrays."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=t.type) for c, t in zip(columns, schema, strict=True)], schema=schema
    )
