"""Rows of a table of a live SQLite database, read-only: registered as ``sqlite_snapshot``.

The planning of a read takes one consistent copy by the backup interface into a folder that all executors see, so a
database that is written to meanwhile gives each read one state. Tasks read ranges of row ids of the copy; comparisons of
columns with values go to SQLite, and only the columns asked for are read.
"""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.types import StructType

#: Spark's type for what a column declares, by the rules of SQLite: the first of these that the declaration holds.
AFFINITIES = (("INT", "long"), ("CHAR", "string"), ("CLOB", "string"), ("TEXT", "string"), ("BLOB", "binary"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double"))
_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
_PYTHON = {"bigint": int, "double": (int, float), "string": str, "binary": bytes}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path.removeprefix('file://').replace('?', '%3f').replace('#', '%23')}?mode=ro", uri=True)


@dataclass
class Rows(InputPartition):
    """Row ids from low up to high, or all rows where the table has no row ids."""

    low: int | None
    high: int | None


class SnapshotReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.table, self.schema, self.n = options["table"], schema, int(options.get("partitions", "8"))
        self.source, self.copy = options["path"], os.path.join(options["shared"].removeprefix("file://"), f"snapshot-{uuid.uuid4().hex}.db")
        self.conditions: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of columns with values of their own types; the others go back to Spark."""
        kinds = {f.name: f.dataType.simpleString() for f in self.schema}
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            given = list(f.value) if isinstance(f, In) else [f.value] if type(f) in _COMPARED else []
            if name not in kinds or any(not isinstance(v, _PYTHON.get(kinds[name], ())) or isinstance(v, bool) for v in given):
                yield f
            elif type(f) in _COMPARED:
                self.conditions.append(f"{_quoted(name)} {_COMPARED[type(f)]} ?")
                self.values += given
            elif isinstance(f, In):
                self.conditions.append(f"{_quoted(name)} in ({', '.join('?' * len(given))})")
                self.values += given
            elif isinstance(f, (IsNull, IsNotNull)):
                self.conditions.append(f"{_quoted(name)} is {'not ' * isinstance(f, IsNotNull)}null")
            else:
                yield f

    def partitions(self) -> list[Rows]:
        os.makedirs(os.path.dirname(self.copy), exist_ok=True)
        with _open(self.source) as live, sqlite3.connect(f"{self.copy}.part") as copy:
            live.backup(copy)
        os.replace(f"{self.copy}.part", self.copy)
        with _open(self.copy) as db:
            try:
                low, high = db.execute(f"select min(rowid), max(rowid) from {_quoted(self.table)}").fetchone()
            except sqlite3.OperationalError:  # a table without row ids
                return [Rows(None, None)]
        if low is None:
            return [Rows(0, 0)]
        step = -(-(high - low + 1) // self.n)
        return [Rows(k, min(k + step, high + 1)) for k in range(low, high + 1, step)]

    def read(self, part: Rows) -> Iterator[tuple]:
        where, values = list(self.conditions), list(self.values)
        if part.low is not None:
            where.append("rowid >= ? and rowid < ?")
            values += [part.low, part.high]
        columns = ", ".join(map(_quoted, self.schema.names))
        kinds = [_PYTHON[f.dataType.simpleString()] for f in self.schema]
        with _open(self.copy) as db:
            for row in db.execute(f"select {columns} from {_quoted(self.table)}" + (f" where {' and '.join(where)}" if where else ""), values):
                # SQLite holds values of any type in any column; one of another type than the column's is null, integers are doubles too
                yield tuple(None if not isinstance(v, k) else float(v) if k == (int, float) else v for v, k in zip(row, kinds, strict=True))


class SqliteSnapshot(DataSource):
    """Options: path of the database, table, shared (a folder that driver and executors see), partitions (8)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_snapshot"

    def schema(self) -> str:
        with _open(self.options["path"]) as db:
            columns = db.execute(f"pragma table_info({_quoted(self.options['table'])})").fetchall()
        if not columns:
            raise ValueError(f"no table {self.options['table']}")
        kind = lambda declared: next((t for word, t in AFFINITIES if word in declared.upper()), "double" if declared else "string")
        return ", ".join(f"`{name.replace('`', '``')}` {kind(declared)}" for _, name, declared, *_ in columns)

    def reader(self, schema: StructType) -> SnapshotReader:
        return SnapshotReader(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSnapshot)


def read(spark: SparkSession, path: str, table: str, shared: str, partitions: int = 8):
    """The rows of a table as of the planning of each read."""
    register(spark)
    return spark.read.format("sqlite_snapshot").options(path=path, table=table, shared=shared, partitions=str(partitions)).load()
