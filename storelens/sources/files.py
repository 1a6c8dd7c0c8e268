"""Small file operations on any store that Spark's session can reach (Hadoop file systems).

Only metadata passes through the driver: names, sizes, times, and commit files of a few
kilobytes. ``create_new`` publishes a whole file under a name that must be free: of two
callers one succeeds, and no reader ever sees half a file.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Entry(NamedTuple):
    """A file or folder: its name, whole path, kind, bytes and modification time (milliseconds)."""

    name: str
    path: str
    is_folder: bool
    length: int
    modified_ms: int


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def entries(self, path: str) -> list[Entry]:
        """What a folder holds, by name; nothing if it is not there."""
        fs, where = self._at(path)
        if not fs.exists(where):
            return []
        found = [Entry(s.getPath().getName(), s.getPath().toString(), s.isDirectory(), s.getLen(), s.getModificationTime())
                 for s in fs.listStatus(where)]
        return sorted(found)

    def read(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.delete(where, True)

    def move(self, path: str, to: str) -> None:
        """Give a file another, free name; folders on the way are made."""
        fs, where = self._at(path)
        target = self._jvm.org.apache.hadoop.fs.Path(to)
        fs.mkdirs(target.getParent())
        if not fs.rename(where, target):
            raise OSError(f"{path} can't be moved to {to}")

    def create_new(self, path: str, text: str) -> bool:
        """Write ``text`` as the new file ``path``; False if the name is taken, by whoever was first."""
        fs, target = self._at(path)
        fs.mkdirs(target.getParent())
        draft = self._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self._publish(fs, draft, target)
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        finally:
            fs.delete(draft, False)

    def _publish(self, fs, draft, target) -> None:
        """Give the draft its name, unless the name is taken: a hard link on a local disk, else a rename that never replaces."""
        jvm = self._jvm
        if fs.getUri().getScheme() == "file":
            to_path = lambda p: jvm.java.nio.file.Path.of(p.toUri().getPath(), self._gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(to_path(target), to_path(draft))
            return
        options = self._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf).rename(draft, target, options)
