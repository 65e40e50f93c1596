"""Joining small per-key tables back onto the request rows.

A "dimension" here is a table keyed by ip, path, user agent, minute or asn,
computed from the rows by ``groupBy`` (map-side partial aggregation, so a hot
key costs one partial row per task, not a hot task).  It is joined back with
:func:`join_dim`:

* the independent dimensions of a plan are persisted and measured (rows and
  bytes) in one job by :func:`sizes`; a lost executor's blocks are recomputed
  from the dimension's short lineage (scan -> partial aggregate -> shuffle);
* a dimension is broadcast only when its rows and bytes are within bounds, the
  bytes summed over all dimensions of the plan (they sit on each executor at
  once); otherwise it is a shuffle join, in which the rows of heavy keys are
  dealt out (:func:`weighted_join`, given their counts) or left to AQE's skew-join
  handling, and it is not kept in the cache;
* a table derived from a measured one by filters or left joins on distinct keys
  reuses that measure (``small``) instead of running another job.

:func:`scope` bounds the life of the persisted tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_path

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000

#: Bytes of all broadcast dimensions of one plan together.
MAX_BROADCAST_BYTES = 256 << 20

#: Columns that a dimension may gain after it was measured (flags, scores).
EXTRA_COLUMNS = 30


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back (eager).

    Readers see a pruned, pushed-down scan, and the files outlive lost executors.
    """
    spark = df.sparkSession
    path = stage_path(spark, uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_PERSISTED: list[DataFrame] = []


def release_all() -> None:
    """Unpersist the per-key tables cached so far; plans that still use them recompute them."""
    while _PERSISTED:
        _PERSISTED.pop().unpersist()


@contextmanager
def scope():
    """Release, at the end, the per-key tables that were cached inside the block (and no others)."""
    before = list(_PERSISTED)
    try:
        yield
    finally:
        for df in [d for d in _PERSISTED if not any(d is b for b in before)]:
            df.unpersist()
        _PERSISTED[:] = before


def reuse(df: DataFrame) -> DataFrame:
    """Persist (memory and disk) a per-key table read by several consumers, so the
    row scan and aggregate behind it run once; lost blocks are recomputed."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _PERSISTED.append(df)
    return df


def row_bytes(df: DataFrame):
    """Bytes of a row in a broadcast table, with the columns it may gain."""
    texts = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    return sum(texts, F.lit(8 * (len(df.columns) + EXTRA_COLUMNS)))


def measured(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``df`` persisted, and whether it is within the bounds of a broadcast."""
    kept, small = sizes({"df": df}, max_rows)
    return kept["df"], small["df"]


def sizes(tables: Mapping[str, DataFrame], max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
          max_bytes: int | None = None, keep: tuple[str, ...] = ()) -> tuple[dict[str, DataFrame], dict[str, bool]]:
    """Persist each table and measure all of them in one job.

    Returns the tables and whether each may be broadcast: the smallest ones, as
    many as fit into ``max_bytes`` together and hold at most ``max_rows`` rows.
    Tables that may not are released again, except those named in ``keep``.
    Only one small row per table reaches the driver.
    """
    kept = {name: df.persist(StorageLevel.MEMORY_AND_DISK) for name, df in tables.items()}
    if not kept:
        return {}, {}
    left = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    tagged = [df.select(F.lit(name).alias("_table"), row_bytes(df).cast("bigint").alias("_bytes")) for name, df in kept.items()]
    found = reduce(DataFrame.unionByName, tagged).groupBy("_table").agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("b"))
    size = {name: (0, 0) for name in kept} | {r["_table"]: (r["b"], r["n"]) for r in found.collect()}
    small = {}
    for name in sorted(kept, key=lambda k: size[k]):
        b, n = size[name]
        small[name] = n <= max_rows and b <= left and max_rows > 0
        left -= b if small[name] else 0
        if small[name] or name in keep:
            _PERSISTED.append(kept[name])
        else:
            kept[name].unpersist()
    return kept, small


def join_dim(rows: DataFrame, dim: DataFrame, on: list[str] | str, how: str = "left",
             max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, small: bool | None = None,
             weight: str | None = None) -> DataFrame:
    """Left-join a per-key table onto the rows, broadcasting it only behind a size check.

    ``small`` is the measure of the table it was derived from; without it the
    table is measured (one job).  With ``weight`` (the column that counts a key's
    rows) a table beyond the bound is joined by :func:`weighted_join`.
    """
    if small is None:
        dim, small = measured(dim, max_broadcast_rows)
    if weight and not small:
        return weighted_join(rows, dim, [on] if isinstance(on, str) else list(on), weight)
    return rows.join(F.broadcast(dim) if small else dim, on=on, how=how)


def flag_join(rows: DataFrame, keys: DataFrame, on: str | list[str], flag: str, **kw) -> DataFrame:
    """Semi-join as a flag: ``flag`` is true when the row's key is in ``keys``."""
    cols = [on] if isinstance(on, str) else list(on)
    k = keys.select(*cols).distinct().withColumn(flag, F.lit(True))
    out = join_dim(rows, k, cols, "left", **kw)
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def null_safe_join(rows: DataFrame, dim: DataFrame, on: list[str], small: bool) -> DataFrame:
    """Left join on ``on``, where null equals null."""
    keys = {c: f"_dim_{c}" for c in on}
    dim = dim.withColumnsRenamed(keys)
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()])
    return rows.join(F.broadcast(dim) if small else dim, cond, "left").drop(*keys.values())


def scalar(one_row_agg: DataFrame):
    """A one-row, one-column aggregate as a scalar subquery Column.

    Global statistics (mean/std thresholds) are attached this way: Spark runs
    the aggregate once and inlines the value; no join and no driver collect.
    """
    return one_row_agg.scalar()


def weighted_join(rows: DataFrame, dim: DataFrame, on: list[str], weight: str) -> DataFrame:
    """Left join of a per-key table too large for a broadcast, its heavy keys dealt out.

    ``weight``: the column of ``dim`` that counts the rows of a key.  A key with more
    than half of a task's share of all rows is heavy (there are fewer of them than
    two per shuffle partition, so their list is broadcast); its rows are spread
    by hash over as many parts as it has such halves, and its one ``dim`` row is
    repeated for each part.  All other keys go to one task each, as usual.  The
    spreading is a hash of the row, so a task that runs again deals alike.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = dim.agg(F.sum(weight)).first()[0] or 0
    share = max(1, total // (2 * parts))
    heavy = dim.where(F.col(weight) > share).select(*on, F.ceil(F.col(weight) / F.lit(share)).cast("int").alias("_copies"))
    heavy = F.broadcast(heavy)
    r = rows.join(heavy, on, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("_copies")), F.lit(0)).cast("int"))
    d = dim.join(heavy, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
    return r.drop("_copies").join(d.drop("_copies"), [*on, "_part"], "left").drop("_part")
