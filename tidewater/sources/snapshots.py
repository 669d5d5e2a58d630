"""Snapshot commits: a folder of tables that changes as a whole.

A refresh writes every table to a folder of its own that no reader knows yet,
and then adds one small file to ``_snapshots``: a numbered list of all tables and
the folder of each.  The list with the highest number is the folder's state.

* A reader takes the newest list once, so it sees the tables of one refresh,
  also while the next one is being written.
* A refresh that is killed before its list exists changes nothing; what it left
  behind is in no list, and ``vacuum`` removes it.
* A list is written under a temporary name and renamed to its number, which
  fails if the number is taken: of two writers that started from the same
  state, one gets ``ConcurrentRefresh`` and neither mixes with the other.

Folders are never overwritten or renamed, so this holds on object stores too,
where moving a table means copying it; there the list is created under its own
name without overwriting.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

LISTS = "_snapshots"


class ConcurrentRefresh(RuntimeError):
    pass


class _Folder:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.path = self._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        out = self.path
        for p in parts:
            out = self._jvm.org.apache.hadoop.fs.Path(out, p)
        return out

    def names(self, *parts: str) -> list[str]:
        where = self.at(*parts)
        if not self.fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where))

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in self.names(LISTS) if n.isdigit())

    def read(self, number: int) -> dict[str, str]:
        where = self.at(LISTS, f"{number:012d}")
        stream = self.fs.open(where)
        try:
            size = self.fs.getFileStatus(where).getLen()
            return json.loads(bytes(stream.readNBytes(int(size))).decode())
        finally:
            stream.close()

    def write(self, number: int, tables: dict[str, str]) -> None:
        draft, final = self.at(LISTS, f".draft-{uuid.uuid4().hex}"), self.at(LISTS, f"{number:012d}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(tables, sort_keys=True, indent=1).encode()))
        finally:
            stream.close()
        if self.fs.exists(final) or not self.fs.rename(draft, final):
            self.fs.delete(draft, False)
            raise ConcurrentRefresh(f"{final} was committed by another refresh")


def new_version(root: str, name: str) -> str:
    """A folder for the next version of a table, not yet part of any snapshot."""
    return f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex[:16]}"


def current(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """(number, table -> folder) of the newest snapshot; (0, {}) before the first."""
    folder = _Folder(spark, root)
    numbers = folder.numbers()
    if not numbers:
        return 0, {}
    tables = folder.read(numbers[-1])
    return numbers[-1], {name: f"{root.rstrip('/')}/{place}" for name, place in tables.items()}


def commit(spark: SparkSession, root: str, based_on: int, written: dict[str, str]) -> int:
    """Publish ``written`` (table -> folder from ``new_version``) beside the unchanged tables of snapshot ``based_on``."""
    folder, prefix = _Folder(spark, root), root.rstrip("/") + "/"
    tables = folder.read(based_on) if based_on else {}
    tables |= {name: path.removeprefix(prefix) for name, path in written.items()}
    if folder.numbers()[-1:] not in ([], [based_on]):
        raise ConcurrentRefresh(f"{root} moved on from snapshot {based_on}")
    folder.write(based_on + 1, tables)
    return based_on + 1


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete table folders that none of the newest ``keep`` snapshots lists, and older lists; the deleted folders.

    Run it while no refresh is under way: an unfinished refresh is in no list yet.
    """
    folder = _Folder(spark, root)
    numbers = folder.numbers()
    kept = numbers[-max(1, keep):]
    lists = [folder.read(n) for n in kept]
    used = {place for tables in lists for place in tables.values()}
    gone = []
    for name in folder.names():
        if name == LISTS or not folder.fs.getFileStatus(folder.at(name)).isDirectory():
            continue
        for version in folder.names(name):
            if f"{name}/{version}" not in used and folder.fs.delete(folder.at(name, version), True):
                gone.append(f"{name}/{version}")
    for n in numbers:
        if n not in kept:
            folder.fs.delete(folder.at(LISTS, f"{n:012d}"), False)
    return gone
