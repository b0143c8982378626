"""The stream of deposits gives what the batch operator gives, across several micro-batches."""

import datetime
import random

from pyspark.sql import functions as F

from corvane.operators import trajectory
from corvane.streaming import deposits, placed


def test_accumulate(spark, tmp_path):
    t = [datetime.datetime(2024, 1, 1, h) for h in range(6)]
    parts = [[(1, t[0], "a"), (1, t[1], "b"), (2, t[0], "x")], [(1, t[2], "b"), (2, t[1], "x"), (1, t[3], "a")], [(1, t[3], "c"), (1, t[0], "a"), (2, t[5], "y")]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "key long, stamp timestamp, content string").coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema("key long, stamp timestamp, content string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    sink = deposits.accumulate(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).option("path", str(tmp_path / "out"))
    assert sink.trigger(availableNow=True).start().awaitTermination(90)
    got = {(r.key, r.stamp, r.content): r.verdict for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[(1, t[3], "c")] == "conflict" and got[(1, t[0], "a")] in ("late", "deposited")
    plain = trajectory.deposits(spark.createDataFrame([*parts[0], *parts[1]], "key long, stamp timestamp, content string"), "key", ["stamp"], "content")
    for r in plain.where("not (key = 1 and stamp = timestamp'2024-01-01 00:00:00')").collect():
        assert got[(r.key, r.stamp, r.content)] == r.verdict


def test_any_order_of_arrival_gives_the_verdicts_of_the_batch(spark, tmp_path):
    r = random.Random(6)
    hours = [datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h) for h in range(12)]
    rows = [(key, r.choice(hours), n, r.choice(["a", "a", "b", None])) for key in range(6) for n in range(key * 6)]
    r.shuffle(rows)
    schema = "key long, stamp timestamp, arrival long, content string"
    for i in range(0, len(rows), 25):
        spark.createDataFrame(rows[i : i + 25], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = str(tmp_path / "out")
        sink = placed.accumulate(stream).writeStream.outputMode("update").foreachBatch(lambda df, _: df.write.mode("append").parquet(out)).option("checkpointLocation", str(tmp_path / "ck"))
        assert sink.trigger(availableNow=True).start().awaitTermination(150)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    last = spark.read.parquet(out).groupBy("key", "stamp", "arrival").agg(F.max_by(F.struct("content", "verdict"), "version").alias("m")).select("key", "stamp", "arrival", "m.*")
    want = trajectory.accumulated(spark.createDataFrame(rows, schema), "key", "stamp", "arrival", "content")
    assert sorted(map(repr, last.collect())) == sorted(map(repr, want.select(*last.columns).collect()))
