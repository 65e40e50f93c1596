"""Mergeable moments: count, mean and sum of squared deviations (``n, mean, m2``).

Parts of a column (days, files) are summarised on their own; :func:`merge` gives
the moments of all parts together without the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregates(value: str | Column) -> list[Column]:
    """``n, mean, m2`` of the non-null values, as aggregate columns."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    n = F.count(v)
    return [n.alias("n"), F.avg(v).alias("mean"), F.coalesce(F.var_pop(v) * n, F.lit(0.0)).alias("m2")]


def moments(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(*aggregates(value))


def merged(prefix: str = "") -> Column:
    """Aggregate: the moments (a struct ``n, mean, m2``) of all rows of moments together.

    The rows of a group are its parts (days of a client, say), a list of bounded
    size; they are added one by one, smallest first, so the result does not
    depend on the order in which they are read.
    """
    part = F.struct(*[F.col(prefix + c).alias(c) for c in ("n", "mean", "m2")])
    parts = F.sort_array(F.collect_list(F.when(F.col(prefix + "n") > 0, part)))

    def add(acc, x):
        n = acc["n"] + x["n"]
        apart = x["mean"] - acc["mean"]
        return F.struct(n.alias("n"), (acc["mean"] + apart * x["n"] / n).alias("mean"),
                        (acc["m2"] + x["m2"] + apart * apart * acc["n"] * x["n"] / n).alias("m2"))

    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    total = F.aggregate(parts, zero, add)
    return F.struct(total["n"].alias("n"), F.when(total["n"] > 0, total["mean"]).alias("mean"), total["m2"].alias("m2"))


def std_samp(prefix: str = "") -> Column:
    """Sample standard deviation of a row of moments; null below two values."""
    n, m2 = F.col(prefix + "n"), F.col(prefix + "m2")
    return F.when(n > 1, F.sqrt(m2 / (n - 1)))
