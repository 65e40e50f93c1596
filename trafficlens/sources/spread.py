"""Spread a scan over the cluster when its files cannot be split.

Parsing and regex features are CPU-bound and run before the first shuffle,
so a few large unsplittable inputs (one gzip log, one row group) would leave
most cores idle.  Only then the rows are round-robin repartitioned to the
default parallelism; inputs that Spark splits by size are returned unchanged,
however few splits they have (no extra shuffle at scale).

Catalyst pushes filters through a repartition, which would move the parse
filter (and the regexes it needs) back into the few scan tasks.  The rows
are therefore passed through a one-element ``inline`` (a Generate), which
filters on its output cannot cross.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


UNSPLITTABLE = (".gz", ".gzip", ".zst", ".zstd", ".lz4", ".snappy", ".deflate", ".xz")


def spread(df: DataFrame, unsplittable: bool | None = None, min_partitions: int | None = None) -> DataFrame:
    """``unsplittable`` says whether the input's files cannot be split; by default the names of
    the files tell."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    if unsplittable is None:
        unsplittable = any(f.endswith(UNSPLITTABLE) for f in df.inputFiles())
    if not unsplittable:
        return df
    cols = df.columns
    return df.repartition(target).select(F.inline(F.array(F.struct(*[F.col(c) for c in cols]))))
