"""Tables of immutable parts, and small numbered files that say which of them count.

Data is first written under a new name and then published by one file, so a reader sees a change
as a whole or not at all, and a failure before leaves only unread folders. Of a folder of
numbered files the highest counts; a number can be taken once, so of two writers that started
from the same state one fails. The driver handles names of folders, never rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MARKER = "_SUCCESS"
_PARTS = "_parts"


@dataclass(frozen=True)
class Entry:
    """A file or folder: its path, name and the time of its last change in milliseconds."""

    path: str
    name: str
    changed: int


class Folder:
    """The file system of a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.fs = self._at(self.path).getFileSystem(self.conf)

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._at(f"{self.path}/{name}" if name else self.path))

    def find(self, pattern: str) -> list[Entry]:
        """What matches a glob under the path, by path."""
        found = self.fs.globStatus(self._at(f"{self.path}/{pattern}")) or []
        entries = [
            Entry(s.getPath().toString(), s.getPath().getName(), s.getModificationTime()) for s in found
        ]
        return sorted(entries, key=lambda e: e.path)

    def text(self, path: str) -> str:
        stream = self.fs.open(self._at(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str = "") -> None:
        """Write a file as a whole; it must not be there yet."""
        target = self._at(f"{self.path}/{name}")
        draft = self._at(f"{target.getParent().toString()}/.{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(target) or not self.fs.rename(draft, target):
            self.fs.delete(draft, False)
            raise RuntimeError(f"{target.toString()} was published by another writer")

    def delete(self, path: str) -> None:
        self.fs.delete(self._at(path), True)


def latest(folder: Folder, name: str) -> tuple[int, dict]:
    """The number and content of the highest published file of a folder; 0 and {} without one."""
    found = folder.find(f"{name}/[0-9]*.json")
    if not found:
        return 0, {}
    return int(found[-1].name.removesuffix(".json")), json.loads(folder.text(found[-1].path))


def publish(folder: Folder, name: str, number: int, content: dict) -> None:
    folder.create(f"{name}/{number:010d}.json", json.dumps(content, sort_keys=True))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to; a new checkpoint has a new one."""
    folder = Folder(spark, checkpoint)
    return json.loads(folder.text(f"{folder.path}/metadata"))["id"]


def cutoff(keep_hours: float) -> int:
    return int((time.time() - keep_hours * 3600) * 1000)


# --- tables of parts --------------------------------------------------------------------


def write_parts(
    df: DataFrame, path: str, key: str, touched: Iterable[str] | None = None, note: dict | None = None,
    check: Callable[[], None] | None = None, **options: str,
) -> None:
    """Publish the rows as the parts of a table, one for each value of ``key``.

    Without ``touched`` they replace the whole table. With it, the named parts are replaced, or go
    where ``df`` has no rows of theirs, and all others stay; a part that is not named must not
    have rows. ``note`` is kept with the parts. ``check`` is called when the rows are written and
    not yet published; what it raises leaves the table as it was.
    """
    folder = Folder(df.sparkSession, path)
    number, old = latest(folder, _PARTS)
    version = f"version={number + 1:010d}-{uuid.uuid4().hex[:8]}"
    df.write.options(**options).partitionBy(key).parquet(f"{folder.path}/{version}")
    if check is not None:
        check()
    made = {e.name.split("=", 1)[1]: version for e in folder.find(f"{version}/{key}=*")}
    parts = made
    if touched is not None:
        named = set(map(str, touched))
        if made.keys() - named:
            raise ValueError(f"rows of parts that were not named: {sorted(made.keys() - named)[:5]}")
        parts = {k: v for k, v in old.get("parts", {}).items() if k not in named} | made
    publish(folder, _PARTS, number + 1, {"parts": parts, "note": note or old.get("note", {})})


def read_parts(
    spark: SparkSession, path: str, key: str, schema: T.StructType, only: Iterable[str] | None = None
) -> DataFrame:
    """The table's rows; with ``only`` those of the named parts, whose folders alone are listed."""
    folder = Folder(spark, path)
    number, content = latest(folder, _PARTS)
    if not number:
        raise FileNotFoundError(f"no table at {path}")
    parts = content["parts"]
    wanted = parts if only is None else {k: parts[k] for k in map(str, only) if k in parts}
    if not wanted:
        return spark.createDataFrame([], schema)
    folders = [f"{folder.path}/{version}/{key}={part}" for part, version in sorted(wanted.items())]
    rows = spark.read.schema(schema).option("basePath", folder.path).parquet(*folders)
    return rows.select(*schema.names)


def note_of(spark: SparkSession, path: str) -> dict:
    """What was kept with the parts."""
    return latest(Folder(spark, path), _PARTS)[1].get("note", {})


def has_parts(spark: SparkSession, path: str) -> bool:
    return latest(Folder(spark, path), _PARTS)[0] > 0


def expire_parts(spark: SparkSession, path: str, key: str, keep_hours: float = 168) -> int:
    """Delete part folders that no longer count and have not changed for so long."""
    folder, limit = Folder(spark, path), cutoff(keep_hours)
    number, content = latest(folder, _PARTS)
    live = {f"{version}/{key}={part}" for part, version in content.get("parts", {}).items()}
    gone = 0
    for entry in folder.find(f"version=*/{key}=*"):
        version = entry.path.rsplit("/", 2)[1]
        if f"{version}/{entry.name}" not in live and entry.changed <= limit and int(version[8:18]) <= number:
            folder.delete(entry.path)
            gone += 1
    for entry in folder.find("version=*"):
        if int(entry.name[8:18]) <= number and not folder.find(f"{entry.name}/{key}=*") and entry.changed <= limit:
            folder.delete(entry.path)
    for entry in folder.find(f"{_PARTS}/[0-9]*.json")[:-1]:
        if entry.changed <= limit:
            folder.delete(entry.path)
    return gone
