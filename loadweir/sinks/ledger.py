"""Which loads a plain table has begun and which it holds whole."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from loadweir.sinks.target import FileTree, Target, unversioned

# Ending of the folder beside a table that holds its marks.
LOADS = "__loads"


class LoadLedger:
    """Marks beside an existing table: an empty file per load and state, so a look-up is one name.

    A mark is one atomic creation of a file; there is no table of loads to read, rewrite or compact.
    """

    def __init__(self, spark: SparkSession, target: Target) -> None:
        self._files = FileTree(spark)
        self._folder = unversioned(target.path(spark)) + LOADS

    def _mark(self, load_id: str, state: str) -> str:
        return f"{self._folder}/{hashlib.sha256(load_id.encode()).hexdigest()}.{state}"

    def is_committed(self, load_id: str) -> bool:
        return self._files.exists(self._mark(load_id, "committed"))

    def may_hold(self, load_id: str) -> bool:
        """Whether rows of an uncommitted load may be there: it has begun, or nobody kept marks."""
        return self._files.exists(self._mark(load_id, "begun")) or not self._files.exists(self._folder)

    def begin(self, load_id: str) -> None:
        self._files.mark(self._mark(load_id, "begun"))

    def commit(self, load_id: str) -> None:
        self._files.mark(self._mark(load_id, "committed"))

    def clear(self) -> None:
        """Forget all loads: their rows are about to be replaced."""
        self._files.delete(self._folder)
