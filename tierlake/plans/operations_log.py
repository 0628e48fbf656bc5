"""The operations log as a stored table: failed-attempt count, insert-if-absent and
keep-latest applied to appended files.

An attempt is one appended file; nothing that is there is read or written again. Files lie in
a folder per generation. A compaction writes the rows to the next generation's folder; it
counts from its success marker on, and then the older folders go. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierlake.operators import oplog
from tierlake.schemas import OPLOG_SCHEMA
from tierlake.sinks.tables import _FS


@dataclass
class OperationsLog:
    spark: SparkSession
    root: str
    # An append that finds more files than this merges them first; the rows stay the same.
    compact_above: int = 1000

    def _folder(self, generation: int) -> str:
        return f"{self.root.rstrip('/')}/generation={generation}"

    def _generations(self) -> list[int]:
        """Generations that a finished write has marked, oldest first."""
        fs = _FS(self.spark, self.root)
        found = [int(n.removeprefix("generation=")) for n in fs.children() if n.startswith("generation=")]
        return sorted(g for g in found if fs.exists(f"{self._folder(g)}/_SUCCESS"))

    def _current(self) -> int:
        return max(self._generations(), default=0)

    def files(self) -> int:
        """Number of files in the current generation."""
        return sum(n.endswith(".parquet") for n in _FS(self.spark, self._folder(self._current())).children())

    def read(self) -> DataFrame:
        if not self._generations():
            return self.spark.createDataFrame([], OPLOG_SCHEMA)
        return self.spark.read.schema(OPLOG_SCHEMA).parquet(self._folder(self._current()))

    def failed_count(self, file_name: str) -> int:
        return int(oplog.failed_count(self.read(), file_name).first().failed_count)

    def _entries(self, entries: DataFrame | list[tuple]) -> DataFrame:
        """``entries``: a DataFrame, or rows of (fileName, downloadURL, status, updated_date, error)."""
        if isinstance(entries, DataFrame):
            return entries.select(*OPLOG_SCHEMA.fieldNames())
        return self.spark.createDataFrame(entries, OPLOG_SCHEMA).coalesce(1)

    def append(self, entries: DataFrame | list[tuple]) -> None:
        """Append attempts, also of files that are logged already: a later ``done``
        clears a failure."""
        if self.files() > self.compact_above:
            self._next_generation(self.read())
        self._entries(entries).write.mode("append").parquet(self._folder(self._current()))

    def record(self, entries: DataFrame | list[tuple]) -> None:
        """Append entries whose file is not logged yet (insert-if-absent)."""
        self.append(oplog.insert_if_absent(self.read(), self._entries(entries)))

    def log_status(self, file_name: str, url: str, status: str, at: dt.datetime,
                   error: str = "") -> None:
        """One attempt, as the downloader logs it."""
        self.append([(file_name, url, status, at, error)])

    def deduplicate(self) -> None:
        """Keep only each file's latest entry (ties kept)."""
        self._next_generation(oplog.deduplicate(self.read()))

    def _next_generation(self, rows: DataFrame) -> None:
        old = self._generations()
        # Adaptive execution sizes the files; a generation of small files becomes one or a few.
        rows.repartition("fileName").write.mode("overwrite").parquet(self._folder(max(old, default=0) + 1))
        for generation in old:
            _FS(self.spark, self.root).delete(self._folder(generation))

    def retry_candidates(self) -> DataFrame:
        return oplog.retry_candidates(self.read())
