"""A sink that makes a folder hold exactly the files of a table: registered as ``reconciled_folder``.

``df(name, text[, identity]).write.format("reconciled_folder").mode("overwrite").save(path)``. The folder lies where driver and executors
see it. Tasks compare each file with the one held and stage what differs; only the commit moves staged files into place, each
by one rename, and then takes away what is no longer wanted. So a task or job that dies leaves the files as they were, a run over
the same table touches nothing, and a commit that was cut short is finished by the next run.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark import TaskContext
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Names below the folder that are the sink's own: what is staged, and what the last commit did.
STAGED, MANIFEST = ".staged", ".manifest.json"


def _digest(path: str) -> str | None:
    try:
        with open(path, "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()
    except FileNotFoundError:
        return None


@dataclass
class Staged(WriterCommitMessage):
    """(name, digest, staged path or None if the file held is the same, identity) of each row of a task."""

    files: list[tuple[str, str, str | None, str | None]] = field(default_factory=list)


class FolderWriter(DataSourceWriter):
    def __init__(self, root: str, schema: StructType, prune: bool):
        self.root, self.prune, self.names, self.run = root.removeprefix("file://"), prune, schema.names, uuid.uuid4().hex

    def write(self, rows: Iterator[Row]) -> Staged:
        done, folder = Staged(), os.path.join(self.root, STAGED, self.run, f"{TaskContext.get().partitionId()}-{TaskContext.get().taskAttemptId()}")
        for row in rows:
            row = dict(zip(self.names, row, strict=True))
            name, data = row["name"], (row["text"] or "").encode()
            parts = (name or "").split("/")
            if not name or parts[0] in (STAGED, MANIFEST) or any(p in ("", ".", "..") for p in parts):
                raise ValueError(f"{name!r} names no file of the folder")
            digest, staged = hashlib.sha256(data).hexdigest(), None
            if _digest(os.path.join(self.root, name)) != digest:
                os.makedirs(folder, exist_ok=True)
                staged = os.path.join(folder, str(len(done.files)))
                with open(staged, "wb") as f:
                    f.write(data)
            done.files.append((name, digest, staged, row.get("identity")))
        return done

    def commit(self, messages: list[Staged | None]) -> None:
        """Names and digests pass through here, never what files hold."""
        files = [f for m in messages if m for f in m.files]
        wanted = {name: identity for name, _, _, identity in files}
        if len({(name, digest) for name, digest, _, _ in files}) != len(wanted):
            raise ValueError("a name stands for two texts")
        held, before = [], self._manifest()
        for folder, dirs, names in os.walk(self.root):
            dirs[:] = [d for d in dirs if folder != self.root or d != STAGED]
            held += [os.path.relpath(os.path.join(folder, n), self.root) for n in names if n != MANIFEST]
        moved = {name: staged for name, _, staged, _ in files if staged}
        for name, staged in moved.items():
            os.makedirs(os.path.dirname(os.path.join(self.root, name)), exist_ok=True)
            os.replace(staged, os.path.join(self.root, name))
        arrived = {i for i in wanted.values() if i is not None}
        gone = sorted(n for n in held if n not in wanted) if self.prune else []
        renamed = [n for n in gone if before.get(n) in arrived]
        for name in gone:
            os.unlink(os.path.join(self.root, name))
        told = {"files": wanted, "written": len(moved), "unchanged": len(wanted) - len(moved), "renamed": len(renamed), "pruned": [n for n in gone if n not in renamed]}
        fresh = os.path.join(self.root, f"{MANIFEST}-{self.run}")
        with open(fresh, "w") as f:
            json.dump(told, f)
        os.replace(fresh, os.path.join(self.root, MANIFEST))
        self._clear()

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear()

    def _manifest(self) -> dict[str, str | None]:
        try:
            with open(os.path.join(self.root, MANIFEST)) as f:
                return json.load(f)["files"]
        except FileNotFoundError:
            return {}

    def _clear(self) -> None:
        """What this run has staged; other runs may be at work."""
        for folder, _, names in os.walk(os.path.join(self.root, STAGED, self.run), topdown=False):
            for n in names:
                os.unlink(os.path.join(folder, n))
            os.rmdir(folder)


class ReconciledFolder(DataSource):
    """Options: path; prune (true: files that no row names are taken away; those of an identity that arrives elsewhere count as renamed)."""

    @classmethod
    def name(cls) -> str:
        return "reconciled_folder"

    def writer(self, schema: StructType, overwrite: bool) -> FolderWriter:
        if not {"name", "text"} <= set(schema.names):
            raise ValueError("a table of files has the columns name and text")
        return FolderWriter(self.options["path"], schema, overwrite and self.options.get("prune", "true").lower() == "true")


def done(path: str) -> dict:
    """What the last commit did: files (name -> identity), written, unchanged, renamed, pruned."""
    with open(os.path.join(path, MANIFEST)) as f:
        return json.load(f)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ReconciledFolder)
