"""Exact-n sampling (S5) and reproducible train/validation split."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dims import reuse


def draw(key_cols: list[str], seed: int):
    """The seeded hash of a row's key: 32 hex digits, uniform, the same in any engine with MD5."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))


def _draw_below(fraction: float) -> str:
    """The hex text below which :func:`draw` falls with probability ``fraction`` (below 1)."""
    return f"{int(fraction * (1 << 60)):015x}"


def sample_exact(df: DataFrame, n: int, seed: int = 42, key_cols: list[str] | None = None,
                 order_cols: list[str] | None = None, oversample_sigmas: float = 8.0) -> DataFrame:
    """``n`` rows chosen uniformly by a seeded hash, without replacement.

    All rows when ``n`` is 0 or at least the row count.  The sample is the
    ``n`` rows with the smallest ``(draw(key_cols, seed), key_cols)``, so it
    is exact-n and reproducible (independent of partitioning), unlike
    ``DataFrame.sample``.  The result is returned in ``order_cols`` order when
    given (file order).

    A plain ``orderBy(hash).limit(n)`` would merge ``n`` rows from every input
    partition in one task.  Instead the rows are counted (one job) and each
    task keeps only rows whose hash is below a threshold expected to pass
    ``n + oversample_sigmas * sqrt(n)`` rows.  The candidates are persisted and
    counted: if at least ``n`` passed, every row of the sample is among them
    (all others hash higher) and the top-``n`` runs over the candidates only;
    otherwise the threshold is doubled and the filter re-run.
    """
    if n <= 0:
        return df
    key_cols = key_cols or ["raw_log"]
    d = df.withColumn("_h", draw(key_cols, seed))
    total = df.count()
    if total <= n:
        out = df
    else:
        fraction = (n + oversample_sigmas * math.sqrt(n) + 64) / total
        while True:
            if fraction >= 1.0:
                cand = d
                break
            cand = reuse(d.where(F.col("_h") < F.lit(_draw_below(fraction))))
            if cand.count() >= n:
                break
            fraction *= 2
        out = cand.orderBy("_h", *key_cols).limit(n).drop("_h")
    if order_cols:
        out = out.orderBy(*order_cols)
    return out


def split_flag(key_cols: list[str], fraction: float = 0.1, seed: int = 7):
    """Boolean column, true for the validation share ``fraction`` of rows."""
    if fraction >= 1:
        return F.lit(True)
    return draw(key_cols, seed) < F.lit(_draw_below(max(0.0, fraction)))


def train_validation_split(df: DataFrame, key_cols: list[str], fraction: float = 0.1,
                           seed: int = 7) -> tuple[DataFrame, DataFrame]:
    flag = split_flag(key_cols, fraction, seed)
    d = df.withColumn("_val", flag)
    return d.where(~F.col("_val")).drop("_val"), d.where(F.col("_val")).drop("_val")
