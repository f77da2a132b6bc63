"""A list of numbered entries on shared storage, each written once and whole.

Writers compete for the next number: an entry is written aside and then put in place only if
that number is still free, so of several writers one wins and the others see its entry. On a
local or mounted file system a hard link does this, elsewhere a rename that must not replace
anything, which is atomic on file systems with atomic renames.
"""

from __future__ import annotations

import json
import os
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DIGITS = 10


class Folder:
    """Files under a path of any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.files = self._path("").getFileSystem(self.conf)

    def _path(self, name: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, pattern: str = "*") -> list[str]:
        """Paths below the folder that match a pattern, relative to it."""
        found = self.files.globStatus(self._path(pattern)) or []
        depth = pattern.count("/") + 1
        return ["/".join(str(f.getPath().toString()).split("/")[-depth:]) for f in found]

    def modified(self, name: str) -> float:
        """Seconds since 1970."""
        return self.files.getFileStatus(self._path(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self.files.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.files.delete(self._path(name), True)

    def create(self, name: str, text: str) -> bool:
        """Put a whole file in place unless there is one; whether this call did it."""
        aside = f".{name}-{uuid.uuid4().hex}"
        out = self.files.create(self._path(aside))
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self.files.getScheme() == "file":
                folder = self._path("").toUri().getPath()
                try:
                    os.link(f"{folder}/{aside}", f"{folder}/{name}")
                except FileExistsError:
                    return False
                return True
            return self._rename(aside, name)
        finally:
            self.delete(aside)

    def _rename(self, aside: str, name: str) -> bool:
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.conf)
        options = self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        try:
            context.rename(self._path(aside), self._path(name), self.jvm.java.lang.reflect.Array.newInstance(options, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e):
                raise
            return False
        return True


class Ledger:
    """Numbered entries from 1 on; what an entry holds is up to its users."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.folder.names("[0-9]*.json"))

    def get(self, number: int) -> dict:
        return json.loads(self.folder.read(f"{number:0{DIGITS}d}.json"))

    def newest(self) -> tuple[int, dict]:
        """The last entry and its number; 0 and an empty one before the first."""
        number = max(self.numbers(), default=0)
        return number, self.get(number) if number else {}

    def put(self, number: int, entry: dict) -> bool:
        """Write an entry as the one of this number; False if there is one already."""
        return self.folder.create(f"{number:0{DIGITS}d}.json", json.dumps(entry))

    def forget(self, keep: int) -> None:
        """Delete all but the last entries."""
        for number in self.numbers()[: -max(1, keep)]:
            self.folder.delete(f"{number:0{DIGITS}d}.json")
