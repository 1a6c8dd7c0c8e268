"""A numbered commit log of stored tables under one folder.

``{base}/_commits/00000007.json`` holds the whole state after commit 7: for each name the
folder of its current version and what its writer noted. Readers take the highest number
and so see the versions of one commit together. A writer stores its data first, under a
folder of its own, and then creates the next number if it is absent: of two writers one
gets it, the other looks at the new state and decides anew. A writer that dies before its
commit leaves a folder that nobody refers to; ``vacuum`` removes those.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from storelens.sources.files import Files

#: Commits that stay readable after ``vacuum``, and how old an unreferenced folder must be to go (a writer may be at it).
KEPT_COMMITS, GRACE = 10, dt.timedelta(days=1)

State = dict[str, dict]


class CommitLog:
    def __init__(self, spark: SparkSession, base: str):
        self.base = base.rstrip("/")
        self._files = Files(spark)
        self._folder = f"{self.base}/_commits"

    def _path(self, number: int) -> str:
        return f"{self._folder}/{number:08d}.json"

    def numbers(self) -> list[int]:
        return [int(e.name[:-5]) for e in self._files.entries(self._folder)
                if e.name.endswith(".json") and e.name[:-5].isdigit()]

    def read(self, number: int) -> State:
        return json.loads(self._files.read(self._path(number)))["tables"]

    def latest(self) -> tuple[int, State]:
        """(number, tables) of the newest commit; (0, {}) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def commit(self, change: Callable[[State], State | None], at: dt.datetime | None = None) -> tuple[int, State]:
        """Publish ``change(tables)`` as the next commit, again on the newer state whenever another writer was first.

        ``change`` returns the new state, or None to leave things as they are. Returns the number and state that hold
        afterwards.
        """
        while True:
            number, tables = self.latest()
            new = change(dict(tables))
            if new is None:
                return number, tables
            content = {"commit": number + 1, "at": (at or dt.datetime.now()).isoformat(), "tables": new}
            if self._files.create_new(self._path(number + 1), json.dumps(content, sort_keys=True)):
                return number + 1, new

    def vacuum(self, now: dt.datetime | None = None, keep: int = KEPT_COMMITS, grace: dt.timedelta = GRACE) -> list[str]:
        """Remove all but the newest ``keep`` commits, and version folders (``{base}/{name}/v=...``) that no commit left
        refers to and that are older than ``grace``. Returns the folders removed."""
        numbers = self.numbers()
        kept = numbers[-keep:]
        used = {_folder(p) for n in kept for table in self.read(n).values() for p in _paths(table)}
        oldest = (now or dt.datetime.now()) - grace
        removed = []
        for name in self._files.entries(self.base):
            for version in self._files.entries(name.path) if name.is_folder and not name.name.startswith("_") else []:
                modified = dt.datetime.fromtimestamp(version.modified_ms / 1000)
                if version.name.startswith("v=") and f"{name.name}/{version.name}" not in used and modified < oldest:
                    self._files.delete(version.path)
                    removed.append(f"{name.name}/{version.name}")
        for n in numbers[:-keep]:
            self._files.delete(self._path(n))
        return removed


def _paths(table: dict) -> list[str]:
    return [table["path"]] if "path" in table else [d["path"] for d in table.get("days", {}).values()]


def _folder(path: str) -> str:
    """``name/v=version`` of a path below a base folder."""
    parts = path.rstrip("/").split("/")
    at = max(k for k, p in enumerate(parts) if p.startswith("v="))
    return "/".join(parts[at - 1:at + 1])
