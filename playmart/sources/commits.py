"""Commit logs: one small file per commit, numbered, created exclusively.

A commit is prepared outside the log (data written to folders of its own) and
becomes visible as a whole by its log entry. Writers are optimistic: each
tries the next free number, and the one who loses reads the log again and
retries on top of the winner, so no commit is lost or shares a number.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from playmart.sources import files

ATTEMPTS = 100


class CommitLog:
    """The log in ``folder``; entries are JSON objects with their ``seq``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, seq: int) -> str:
        return f"{self.folder}/{seq:020d}.json"

    def numbers(self) -> list[int]:
        """Numbers of the commits kept, oldest first."""
        names = [n for n, _ in files.children(self.spark, self.folder)]
        return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]

    def read(self, seq: int) -> dict:
        return json.loads(files.read_text(self.spark, self._path(seq)))

    def last(self) -> dict | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def entries(self) -> list[dict]:
        return [self.read(n) for n in self.numbers()]

    def append(self, build: Callable[[dict | None], dict]) -> dict:
        """Commits ``build(last entry)``; called again with the winner's entry
        if another writer takes the number first. ``build`` may raise to give
        up."""
        for _ in range(ATTEMPTS):
            last = self.last()
            entry = build(last) | {"seq": last["seq"] + 1 if last else 1}
            if files.put_if_absent(self.spark, self._path(entry["seq"]), json.dumps(entry, ensure_ascii=False)):
                return entry
        raise RuntimeError(f"no free commit number under {self.folder} after {ATTEMPTS} attempts")

    def drop_before(self, seq: int) -> None:
        """Removes entries older than ``seq``; the last one always stays."""
        for n in self.numbers()[:-1]:
            if n < seq:
                files.delete(self.spark, self._path(n))
