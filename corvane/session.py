"""Session builder and table loader."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_OWN: dict[str, str] = {}


def get_spark(app: str = "corvane", **conf: str) -> SparkSession:
    """A session with the settings the library is written for: UTC, adaptive execution, Arrow."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table of that name; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``; where it is unset, one of our own on a local master, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-"))
    return found.rstrip("/")


#: Rows up to which a table is sent to every task that it is joined in.
FEW = 5_000


def weighed(df: DataFrame) -> DataFrame:
    """The rows as ``settled``, marked for joins by how many they are: few are broadcast, more never are.

    Node tables shrink to a small part of themselves in files, so a size told by files would have millions of rows broadcast.
    """
    rows = settled(df)
    return rows.hint("broadcast" if rows.count() <= FEW else "merge")


def settled(df: DataFrame) -> DataFrame:
    """The rows written as Parquet below the shared folder and read from there: computed once, and lost executors cost no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
