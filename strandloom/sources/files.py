"""Folders on any file system that Spark knows, through its own file system classes."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        jvm = spark.sparkContext._jvm
        self._make = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._at = self._make(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at.getFileSystem(conf)
        self._copy = lambda a, b: jvm.org.apache.hadoop.fs.FileUtil.copy(self._fs, a, b.getFileSystem(conf), b, False, conf)

    def exists(self) -> bool:
        return self._fs.exists(self._at)

    def names(self, pattern: str = ".*") -> list[str]:
        """Sorted names in the folder; none if it isn't there."""
        found = [s.getPath().getName() for s in self._fs.listStatus(self._at)] if self.exists() else []
        return sorted(n for n in found if re.match(pattern, n))

    def move(self, target: str) -> None:
        to = self._make(target)
        if self._fs.exists(to):
            raise FileExistsError(target)
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self._at, to):
            raise OSError(f"{self.path} could not become {target}")

    def make(self) -> bool:
        """Create the folder; false if it was there. The check and the creation are one step for local and HDFS parents."""
        if self.exists():
            return False
        self._fs.mkdirs(self._at.getParent())
        return self._fs.mkdirs(self._at)

    def delete(self) -> None:
        self._fs.delete(self._at, True)

    def write_text(self, name: str, text: str) -> None:
        stream = self._fs.create(self._make(f"{self.path}/{name}"), False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def write_bytes(self, name: str, body: bytes) -> None:
        stream = self._fs.create(self._make(f"{self.path}/{name}"), False)
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()

    def copy(self, target: str) -> None:
        """Copy the folder with all it holds; the target must not exist."""
        to = self._make(target)
        if self._fs.exists(to):
            raise FileExistsError(target)
        self._fs.mkdirs(to.getParent())
        if not self._copy(self._at, to):
            raise OSError(f"{self.path} could not be copied to {target}")

    def newest(self, pattern: str = ".*") -> str | None:
        """The name changed last, the greater name of several; none in an empty folder."""
        found = [(s.getModificationTime(), s.getPath().getName()) for s in self._fs.listStatus(self._at)] if self.exists() else []
        return max((f for f in found if re.match(pattern, f[1])), default=(0, None))[1]

    def first_of(self, *names: str) -> str | None:
        """The path of the first of the names that is there."""
        there = set(self.names())
        return next((f"{self.path}/{n}" for n in names if n in there), None)

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._make(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
