"""The sink that reconciles a folder and the source of SQLite snapshots."""

import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from corvane.sources import folder, sqlite


def files(root):
    return {os.path.relpath(os.path.join(d, n), root): open(os.path.join(d, n)).read() for d, _, names in os.walk(root) for n in names if not n.startswith(".manifest")}


def put(spark, root, rows, mode="overwrite", **options):
    df = spark.createDataFrame(rows, "name string, text string, identity string").repartition(3)
    df.write.format("reconciled_folder").mode(mode).options(**options).save(str(root))
    return {k: v for k, v in folder.done(root).items() if k != "files"}


def test_folder_holds_exactly_the_files(spark, tmp_path):
    folder.register(spark)
    root = tmp_path / "out"
    first = [("a.md", "one", "A"), ("sub/b.md", "two", "B"), ("c.md", None, None), ("d.md", "four", "D")]
    assert put(spark, root, first) == {"written": 4, "unchanged": 0, "renamed": 0, "pruned": []}
    assert files(root) == {"a.md": "one", "sub/b.md": "two", "c.md": "", "d.md": "four"}
    kept = os.stat(root / "a.md").st_mtime_ns
    assert put(spark, root, first) == {"written": 0, "unchanged": 4, "renamed": 0, "pruned": []}
    second = [("a.md", "one", "A"), ("e/b2.md", "two", "B"), ("c.md", "new", None)]
    assert put(spark, root, second) == {"written": 2, "unchanged": 1, "renamed": 1, "pruned": ["d.md"]}
    assert files(root) == {"a.md": "one", "e/b2.md": "two", "c.md": "new"} and os.stat(root / "a.md").st_mtime_ns == kept
    assert put(spark, root, [("f.md", "six", "F")], "append") == {"written": 1, "unchanged": 0, "renamed": 0, "pruned": []}
    assert set(files(root)) == {"a.md", "e/b2.md", "c.md", "f.md"}


def test_failing_tasks_and_bad_names_leave_the_files_as_they_were(spark, tmp_path):
    folder.register(spark)
    root = tmp_path / "out"
    put(spark, root, [("a.md", "one", None), ("b.md", "two", None)])
    before = files(root)
    broken = spark.range(0, 40, 1, 4).select(F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise(F.lit("text")).alias("text"))
    for df in (broken, spark.createDataFrame([("../x", "t")], "name string, text string"), spark.createDataFrame([("x", "t"), ("x", "u")], "name string, text string"), spark.createDataFrame([(None, "t")], "name string, text string")):
        with pytest.raises(Exception, match="lost|names no file|two texts"):
            df.write.format("reconciled_folder").mode("overwrite").save(str(root))
        assert {k: v for k, v in files(root).items() if not k.startswith(".staged")} == before
    assert put(spark, root, []) == {"written": 0, "unchanged": 0, "renamed": 0, "pruned": ["a.md", "b.md"]}


def test_snapshot_is_one_state_of_a_database_that_grows(spark, tmp_path):
    path = str(tmp_path / "live.db")
    db = sqlite3.connect(path)
    db.execute("pragma journal_mode = wal")
    db.execute("create table s (id integer primary key, title text, size real, raw blob, odd)")
    db.executemany("insert into s values (?, ?, ?, ?, ?)", [(i * 7, f"t{i}", i / 2 if i % 5 else None, b"x", "o" if i % 2 else 1) for i in range(1000)])
    db.execute("create table w (k text primary key, v integer) without rowid")
    db.executemany("insert into w values (?, ?)", [("a", 1), ("b", None), ("c", "no number")])
    db.execute('create table "e ""q" (x integer)')
    db.commit()
    read = lambda table: sqlite.read(spark, path, table, str(tmp_path / "shared"), 5)
    rows = read("s")
    assert rows.dtypes == [("id", "bigint"), ("title", "string"), ("size", "double"), ("raw", "binary"), ("odd", "string")]
    assert rows.rdd.getNumPartitions() == 5 and rows.count() == 1000
    some = rows.where("id > 700 and size is not null and title in ('t101', 't105', 't150', 't200', 't7')").select("id", "size")
    assert sorted(tuple(r) for r in some.collect()) == [(707, 50.5)]
    assert rows.where("odd = 'o'").count() == 500
    db.execute("begin")
    db.executemany("insert into s (id, title) values (?, ?)", [(i, "open") for i in range(100_000, 100_500)])
    assert read("s").count() == 1000  # not committed
    db.commit()
    assert read("s").count() == 1500
    assert sorted(tuple(r) for r in read("w").collect()) == [("a", 1), ("b", None), ("c", None)]
    assert read('e "q').count() == 0
    with pytest.raises(Exception, match="no table"):
        read("none")
