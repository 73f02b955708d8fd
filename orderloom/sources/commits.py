"""Replacing the files of a folder in one step.

A folder holds Parquet files and a commit file, ``_commit-<number>``, that names the write they belong to by the id
Spark puts into the names of its files. A replacement

1. writes its files next to those that are there,
2. checks them,
3. adds a commit file with the next number, by moving a finished file to its place,
4. removes the files and the commit of the write before.

Readers take the commit with the largest number and the files of its write and no others, so a job that stops
anywhere in between leaves the old rows or the new ones, and never both or none. What it left over goes with
the next replacement. A commit may carry facts about its rows, such as their number.

Folders that were written without commits are read as they are. The move needs a file system on which a rename
appears as a whole (HDFS, a local disk or shared mount) or on which a file appears once it is complete (object
stores). Of two replacements at the same time one fails.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Check = Callable[[DataFrame], None]
PREFIX = "_commit-"
_WRITE = re.compile(r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")


class ConflictError(RuntimeError):
    """Somebody else replaced the folder at the same time."""


class NeverWrittenError(LookupError):
    """The folder has no finished write."""


@dataclass(frozen=True)
class Commit:
    """The ``number``-th write of a folder: the id in the names of its files, or the names themselves."""

    number: int
    write: str | None = None
    names: tuple[str, ...] = ()
    facts: dict = field(default_factory=dict)

    @property
    def glob(self) -> str:
        return f"*{self.write}*" if self.write else "{" + ",".join(self.names) + "}"


class Folder:
    """A folder and its file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._at = self._hadoop.fs.Path(self.path)
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._at.getFileSystem(self._conf)

    def _child(self, name: str):
        return self._hadoop.fs.Path(self._at, name)

    def names(self, pattern: str = "*") -> list[str]:
        """The names in the folder that fit a pattern; none if there is no such folder."""
        found = self._files.globStatus(self._child(pattern))
        return [status.getPath().getName() for status in found or []]

    def data(self) -> list[str]:
        return [name for name in self.names("[!_.]*")]

    def remove(self, names: list[str]) -> None:
        for name in names:
            self._files.delete(self._child(name), True)

    def last(self) -> Commit | None:
        """The commit that counts; None if the folder has none."""
        names = sorted(name for name in self.names(f"{PREFIX}*"))
        if not names:
            return None
        stream = self._files.open(self._child(names[-1]))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        got = json.loads(text)
        return Commit(int(names[-1].removeprefix(PREFIX)), got["write"], tuple(got["names"]), got["facts"])

    def commit(self, commit: Commit) -> None:
        """Write a commit file under another name and move it to its place."""
        place, made = self._child(f"{PREFIX}{commit.number:020d}"), self._child(f"_made-{uuid.uuid4().hex}")
        text = json.dumps({"write": commit.write, "names": commit.names, "facts": commit.facts})
        stream = self._files.create(made, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        # FileSystem.rename would put the file over one that is there.
        if self._files.exists(place) or not self._files.rename(made, place):
            self._files.delete(made, False)
            raise ConflictError(f"{self.path} was replaced by somebody else")


def replace(
    df: DataFrame,
    path: str,
    check: Check | None = None,
    facts: Callable[[DataFrame], dict] | dict | None = None,
    options: dict[str, str] | None = None,
) -> Commit:
    """Replace the rows of a folder. A write or check that fails leaves the old ones and none of its own files.

    ``facts`` go into the commit; they may be found on the written rows.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    before = folder.last()
    if before is None:
        # Files that were there without a commit are the write before; with none there, there is no such write.
        before = Commit(0, None, tuple(folder.data()))
        folder.commit(before)
    there = set(folder.data())
    try:
        df.write.mode("append").options(**(options or {})).parquet(folder.path)
        writes = {_WRITE.match(name)[1] for name in set(folder.data()) - there if _WRITE.match(name)}
        if len(writes) != 1:
            raise ConflictError(f"{path} got files of {len(writes)} writes at once")
        after = Commit(before.number + 1, writes.pop())
        rows = _rows(spark, folder.path, after, df.schema)
        if check:
            check(rows)
        after = Commit(after.number, after.write, (), (facts(rows) if callable(facts) else facts) or {})
        folder.commit(after)
    except Exception:
        folder.remove([name for name in set(folder.data()) - there if name not in _owned(folder)])
        raise
    tidy(spark, path)
    return after


def _owned(folder: Folder) -> set[str]:
    """The data files of the commit that counts."""
    now = folder.last()
    return set() if now is None else {n for n in folder.data() if n in now.names or (now.write and now.write in n)}


def tidy(spark: SparkSession, path: str) -> None:
    """Remove all files of a folder that do not belong to its last commit."""
    folder = Folder(spark, path)
    now = folder.last()
    if now is None:
        return
    owned = _owned(folder)
    folder.remove([name for name in folder.data() if name not in owned])
    mine = f"{PREFIX}{now.number:020d}"
    folder.remove([name for name in [*folder.names(f"{PREFIX}*"), *folder.names("_made-*")] if name != mine])


def _rows(spark: SparkSession, path: str, commit: Commit, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", commit.glob)
    return (reader.schema(schema) if schema else reader).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last finished write."""
    now = Folder(spark, path).last()
    if now is None:
        return spark.read.parquet(path)
    if not now.write and not now.names:
        raise NeverWrittenError(f"no write of {path} has finished")
    return _rows(spark, path, now)


def facts(spark: SparkSession, path: str) -> dict:
    """What the last commit says of its rows."""
    now = Folder(spark, path).last()
    return now.facts if now else {}


# --- what was made from what ------------------------------------------------------

MADE_FROM = "made_from"


def version(spark: SparkSession, path: str) -> str | None:
    """The id of the last write of a folder; None if it has no commit."""
    now = Folder(spark, path).last()
    return now.write if now else None


def digest(*parts) -> str | None:
    """A name for a step's inputs and settings; None if the version of an input is not known."""
    if any(part is None or isinstance(part, dict) and None in part.values() for part in parts):
        return None
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def is_made_from(spark: SparkSession, path: str, made_from: str | None) -> bool:
    """Whether the last write of a folder says it was made from just this."""
    return made_from is not None and facts(spark, path).get(MADE_FROM) == made_from


def listing(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int, int]]:
    """Name, length and time of every file at some paths, for the version of an input without commits."""
    hadoop, found = spark.sparkContext._jvm.org.apache.hadoop.fs, []
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for one in [path] if isinstance(path, str) else path:
        at = hadoop.Path(one)
        files = at.getFileSystem(conf)
        for status in files.globStatus(at) or []:
            each = files.listFiles(status.getPath(), True)
            while each.hasNext():
                file = each.next()
                found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(found)
