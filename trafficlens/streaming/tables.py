"""Tables that a ``foreachBatch`` job keeps between its micro-batches.

A job is exactly-once when it takes everything it carries from tables written
by earlier batches and writes its own results under its batch id: a batch that
is run again reads the same tables and writes the same folders anew.

* a *snapshot* is rewritten by every batch (state such as open hours); the
  newest version before a batch is read, and the one before that is kept
  until the next batch, for a repetition.
* an *appended* table gets one part per batch with rows.  ``FAN`` parts of one
  level are merged into one of the next level, so there are at most ``FAN``
  parts per level, and every row is rewritten once per level.

Only parts with a ``_SUCCESS`` file count; a part that lies within a merged one
is skipped, so a job may stop between a merge and the removal of its parts.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

FAN = 10


class BatchTables:
    """Tables below the folder ``base`` (in the cluster's shared storage)."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, table: str) -> list[str]:
        p, fs = self._fs(os.path.join(self.base, table))
        if not fs.exists(p):
            return []
        found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return [q.getName() for q in found if fs.exists(done(q, "_SUCCESS"))]

    def _remove(self, table: str, names: list[str]) -> None:
        for n in names:
            p, fs = self._fs(os.path.join(self.base, table, n))
            fs.delete(p, True)

    def _read(self, table: str, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.base, table, name))

    # -- snapshots ---------------------------------------------------------

    def snapshot(self, table: str, before: int | None = None) -> DataFrame | None:
        """The newest version written by a batch below ``before`` (by any batch without it)."""
        versions = sorted(int(n[1:]) for n in self._names(table) if n.startswith("v"))
        versions = [v for v in versions if before is None or v < before]
        return self._read(table, f"v{versions[-1]}") if versions else None

    def write_snapshot(self, table: str, batch: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(os.path.join(self.base, table, f"v{batch}"))
        older = sorted(int(n[1:]) for n in self._names(table) if n.startswith("v") and int(n[1:]) < batch)
        self._remove(table, [f"v{v}" for v in older[:-1]])

    # -- appended tables ---------------------------------------------------

    def _parts(self, table: str) -> list[tuple[int, int, int]]:
        """(level, first batch, last batch) of the parts that make up the table."""
        parts = [tuple(map(int, n.split("-")[1:])) for n in self._names(table) if n.startswith("part-")]
        return sorted(p for p in parts if not any(q[0] > p[0] and q[1] <= p[1] and p[2] <= q[2] for q in parts))

    def append(self, table: str, batch: int, df: DataFrame) -> bool:
        """Write the rows of one batch; a batch without rows leaves no part."""
        name = f"part-0-{batch}-{batch}"
        df.write.mode("overwrite").parquet(os.path.join(self.base, table, name))
        if self._read(table, name).isEmpty() and any(p != (0, batch, batch) for p in self._parts(table)):
            self._remove(table, [name])  # the first part stays for its schema
            return False
        self._merge(table)
        return True

    def _merge(self, table: str) -> None:
        level = 0
        while True:
            same = [p for p in self._parts(table) if p[0] == level]
            if len(same) < FAN:
                return
            first, last = min(p[1] for p in same), max(p[2] for p in same)
            rows = reduce(DataFrame.unionByName, [self._read(table, "part-%d-%d-%d" % p) for p in same])
            rows.coalesce(max(1, len(same) // 4)).write.mode("overwrite").parquet(
                os.path.join(self.base, table, f"part-{level + 1}-{first}-{last}"))
            level += 1
            covered = [n for n in self._names(table) if n.startswith("part-") and tuple(map(int, n.split("-")[1:])) not in self._parts(table)]
            self._remove(table, covered)

    def rows(self, table: str, before: int | None = None) -> DataFrame | None:
        """All appended rows (with ``before``: of parts that end below that batch)."""
        parts = [p for p in self._parts(table) if before is None or p[2] < before]
        if not parts:
            return None
        return reduce(DataFrame.unionByName, [self._read(table, "part-%d-%d-%d" % p) for p in parts])

    def part_count(self, table: str) -> int:
        return len(self._parts(table))
