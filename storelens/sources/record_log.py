"""A streaming source for record logs: folders of append-only files, one record a line.

    spark.dataSource.register(RecordLog)
    spark.readStream.format("record_log").option("path", folder).load()

Each file of the folder is a partition of the log, and the offset in it is the number of
bytes read. A stream's offset holds one number for each file, so a query that starts again
from its checkpoint goes on exactly where it stopped; a last line without its end is left
until it is whole. Long stretches are split into ranges of ``chunkBytes``, read by separate
tasks; a line belongs to the range in which it begins. Files must be on a path that the
driver and all executors mount; other stores are read with Spark's file sources.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

CHUNK_BYTES = 64_000_000

_STEP = 1 << 20


@dataclass
class Stretch(InputPartition):
    """Bytes ``begin`` to ``end`` of a log file; ``end`` is a line's end or the begin of another stretch."""

    file: str
    begin: int
    end: int


def whole_lines(path: str, begin: int) -> int:
    """The offset behind the last whole line of a file that is known to be whole up to ``begin``."""
    size = os.path.getsize(path)
    with open(path, "rb") as f:
        at = size
        while at > begin:
            low = max(begin, at - _STEP)
            f.seek(low)
            found = f.read(at - low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            at = low
    return begin


def lines_of(path: str, begin: int, end: int) -> Iterator[tuple[int, str]]:
    """(offset, text) of the lines that begin in [begin, end)."""
    with open(path, "rb") as f:
        at = begin
        if begin:
            f.seek(begin - 1)
            if f.read(1) != b"\n":  # the line before goes on; whoever has its begin reads it
                at += len(f.readline())
        while at < end:
            line = f.readline()
            if not line.endswith(b"\n"):
                break
            yield at, line[:-1].removesuffix(b"\r").decode("utf-8", "replace")
            at += len(line)


class RecordLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self._folder = options["path"].removeprefix("file://").removeprefix("file:")
        self._suffix = options.get("suffix", "")
        self._chunk = int(options.get("chunkbytes", options.get("chunkBytes", CHUNK_BYTES)))
        self._seen: dict[str, int] = {}

    def _files(self) -> list[str]:
        found = []
        for folder, _, names in os.walk(self._folder):
            found += [os.path.relpath(os.path.join(folder, n), self._folder) for n in names
                      if not n.startswith((".", "_")) and n.endswith(self._suffix)]
        return sorted(found)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        for file in self._files():
            self._seen[file] = whole_lines(os.path.join(self._folder, file), self._seen.get(file, 0))
        return dict(self._seen)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for file, stop in sorted(end.items()):
            at = start.get(file, 0)
            while at < stop:
                out.append(Stretch(file, at, min(stop, at + self._chunk)))
                at = out[-1].end
        return out

    def read(self, partition: Stretch) -> Iterator[tuple]:
        for at, text in lines_of(os.path.join(self._folder, partition.file), partition.begin, partition.end):
            yield partition.file, at, text

    def commit(self, end: dict) -> None:
        """Files stay: other readers may be behind."""


class RecordLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return "partition string, position long, value string"

    def streamReader(self, schema) -> RecordLogReader:
        if "path" not in self.options:
            raise ValueError("a record log needs the option 'path'")
        return RecordLogReader(self.options)
