"""Newest rows by key out of many small batches.

Rows stand in growing buckets, and those of the last batches beside them.  A batch
spreads over all buckets, so merging every one would write the whole table each
time.  What stands beside is merged when it is as large as the buckets: a row is
then written about log(batches) times, however many batches there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from lakemart.operators import latest
from lakemart.sinks.versions import Tables


class Gathered:
    """A table of the newest row of each key; readers see every batch that was added."""

    def __init__(self, tables: Tables, name: str, keys: tuple[str, ...], time: str):
        self.tables, self.name, self.keys, self.time = tables, name, keys, time
        self.late = f"{name}_late"

    def _newest(self, *frames: DataFrame) -> DataFrame:
        return latest.newest_per_key(reduce(DataFrame.unionByName, frames), list(self.keys), self.time)

    def _bytes(self, name: str) -> int:
        live = self.tables.live(name)
        return sum(h.size for h in live.held) if live else 0

    def read(self) -> DataFrame:
        return self._newest(*[self.tables.read(n) for n in (self.name, self.late) if self.tables.exists(n)])

    def add(self, rows: DataFrame) -> None:
        """Store a batch.  One that is added again after a failure changes nothing."""
        self.tables.add(self.late, rows)
        if self._bytes(self.late) >= self._bytes(self.name):
            self.merge()

    def merge(self) -> None:
        """Bring what stands beside the buckets into them.  It is dropped after that:
        rows that are in both are read once."""
        if not self.tables.exists(self.late) or self.tables.read(self.late).isEmpty():
            return
        rows = self._newest(self.tables.read(self.late))
        touched = [r[0] for r in rows.select(self.tables.bucket_of(self.name, self.keys)).distinct().collect()]
        if self.tables.exists(self.name):
            rows = self._newest(self.tables.read(self.name, touched), rows)
        self.tables.replace_buckets(self.name, rows, self.keys, touched)
        self.tables.write(self.late, self.tables.read(self.late).limit(0))
        for name in (self.name, self.late):
            self.tables.prune(name)
