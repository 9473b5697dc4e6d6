"""Versioned tables with a commit pointer (K-S2 and the stream's snapshots).

Layout under one path: a data folder for each attempt to write a version, and ``_commits`` with one
small file per commit, numbered 1, 2, 3, ...: the newest complete one names the data folder in force.

* Writing takes two steps: the rows go to a folder of their own, then the pointer file is created. A
  writer that dies before leaves a folder that nothing names; it is never read.
* The pointer's number is the writer's last seen one plus one, and it is created only if it does not
  exist. Of two writers that started from the same state, one gets it, the other a ``ConflictingWrite``.
* ``expire`` deletes the data folders of all but the newest versions, and their pointers.

The file system must create files exclusively (HDFS and local disks do).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"
KEEP = 3


class ConflictingWrite(RuntimeError):
    """Another writer committed since this one looked."""


@dataclass(frozen=True)
class Commit:
    number: int
    version: str
    folder: str


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _read(self, path) -> str:
        stream = self._fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _numbers(self) -> list[int]:
        """Numbers of all pointer files, newest first."""
        folder = self._hadoop(f"{self.path}/{COMMITS}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted((int(n) for n in names if n.isdigit()), reverse=True)

    def commits(self) -> list[Commit]:
        """Complete commits, newest first."""
        out = []
        for number in self._numbers():
            text = self._read(self._hadoop(f"{self.path}/{COMMITS}/{number:012d}"))
            if text.endswith("\n"):  # else its writer died while it wrote
                version, folder = text[:-1].split("\t")
                out.append(Commit(number, version, folder))
        return out

    def current(self) -> Commit | None:
        found = self.commits()
        return found[0] if found else None

    def stage(self, df: DataFrame, version: str, partition_by: list[str] | None = None) -> str:
        """Write the rows of a version to a new folder; returns its name. Nothing is visible yet."""
        folder = f"data/{version}-{uuid.uuid4().hex[:12]}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{self.path}/{folder}")
        return folder

    def commit(self, version: str, folder: str, seen: int) -> Commit:
        """Make a staged folder the table. ``seen`` is the greatest number there was when the writer began
        (``last_number``)."""
        path = self._hadoop(f"{self.path}/{COMMITS}/{seen + 1:012d}")
        try:
            if self._numbers()[:1] not in ([], [seen]):
                raise ConflictingWrite(f"{self.path}: version {version} was written from commit {seen}, "
                                       f"but {self._numbers()[0]} is there")
            stream = self._fs.create(path, False)
        except ConflictingWrite:
            raise
        except Exception as e:  # py4j wraps the file system's FileAlreadyExistsException
            if "already exists" in str(e) or "AlreadyExists" in str(e):
                raise ConflictingWrite(f"{self.path}: commit {seen + 1} is taken") from e
            raise
        try:
            stream.write(f"{version}\t{folder}\n".encode())
        finally:
            stream.close()
        return Commit(seen + 1, version, folder)

    def last_number(self) -> int:
        return next(iter(self._numbers()), 0)

    def publish(self, df: DataFrame, version: str, partition_by: list[str] | None = None, keep: int = KEEP) -> DataFrame:
        """Write ``df`` as the new contents, commit, expire old versions; returns a reader of it."""
        seen = self.last_number()
        commit = self.commit(version, self.stage(df, version, partition_by), seen)
        self.expire(keep)
        return self._reader(commit, df)

    def _reader(self, commit: Commit, like: DataFrame | None = None) -> DataFrame:
        reader = self.spark.read if like is None else self.spark.read.schema(like.schema)
        return reader.parquet(f"{self.path}/{commit.folder}")

    def read(self, version: str | None = None) -> DataFrame | None:
        """The table, or its newest commit of ``version``; None if there is none."""
        for commit in self.commits():
            if version in (None, commit.version):
                return self._reader(commit)
        return None

    def expire(self, keep: int = KEEP) -> None:
        """Keep the newest ``keep`` commits. Folders without a commit may be in the writing and stay."""
        for commit in self.commits()[keep:]:
            self._fs.delete(self._hadoop(f"{self.path}/{commit.folder}"), True)
            self._fs.delete(self._hadoop(f"{self.path}/{COMMITS}/{commit.number:012d}"), False)
