"""Evaluate expensive per-row expressions exactly once.

Catalyst substitutes a projected expression into every filter pushed below
its projection, so an expensive expression (a regex over the raw line) that
is both filtered on and projected would run two or three times per row.
Passing it through a one-element ``inline`` (a Generate) makes it a
generated column: filters that use it cannot move below the Generate, and
the expression is computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **exprs: Column) -> DataFrame:
    keep = [F.col(c) for c in df.columns if c not in exprs]
    gen = F.inline(F.array(F.struct(*[e.alias(k) for k, e in exprs.items()])))
    return df.select(*keep, gen)
