"""Regex helpers: many patterns -> one JVM ``rlike`` (or one RE2 string for DuckDB).

Java's ``java.util.regex`` and Python's ``re`` agree on the syntax used by the
pattern lists; ``(?d)`` (UNIX_LINES) makes ``.``/``$`` treat only ``\\n`` as a
line end, as in Python, and ``(?U)`` (UNICODE_CHARACTER_CLASS, implying
Unicode case folding) makes ``\\w``, ``\\d``, ``\\s``, ``\\b`` and ``(?i)``
Unicode-aware, as Python's ``re`` is for text (Java's defaults are ASCII).  A list is combined into one alternation of
non-capturing groups so each row is scanned once per list.  Patterns with
back-references cannot be combined (group numbers shift) and stay separate.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column
from pyspark.sql import functions as F

_BACKREF = re.compile(r"\\[1-9]|\(\?P=")


def alternation(patterns: Iterable[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


#: Patterns in one alternation; longer lists become several.
SHARD = 500


def java_flags(ignore_case: bool) -> str:
    return "(?idU)" if ignore_case else "(?dU)"


def java_regex(patterns: Iterable[str], ignore_case: bool) -> list[str]:
    """Return as few Java regexes as possible that together match like ``any(re.search)``."""
    pats = list(patterns)
    flags = java_flags(ignore_case)
    simple = [p for p in pats if not _BACKREF.search(p)]
    special = [p for p in pats if _BACKREF.search(p)]
    out = [flags + alternation(simple[i:i + SHARD]) for i in range(0, len(simple), SHARD)]
    out.extend(flags + p for p in special)
    return out


def compiles_in_java(spark, pattern: str, ignore_case: bool = True) -> bool:
    """Whether the JVM accepts the pattern, inside a group and under the flags it will run with."""
    try:
        spark._jvm.java.util.regex.Pattern.compile(java_flags(ignore_case) + alternation([pattern]))
        return True
    except (Py4JJavaError, IllegalArgumentException):  # PatternSyntaxException arrives as the latter
        return False


def matches_any(col: Column | str, patterns: Iterable[str], ignore_case: bool = True) -> Column:
    """True when any pattern is found in ``col``; false for null or an empty list."""
    c = F.col(col) if isinstance(col, str) else col
    regs = java_regex(patterns, ignore_case)
    if not regs:
        return F.lit(False)
    hit = None
    for r in regs:
        e = c.rlike(r)
        hit = e if hit is None else (hit | e)
    return F.coalesce(hit, F.lit(False))


def contains_any(col: Column | str, needles: Iterable[str]) -> Column:
    """Case-sensitive substring test of each needle (no regex); null -> false."""
    c = F.col(col) if isinstance(col, str) else col
    needles = list(needles)
    if not needles:
        return F.lit(False)
    hit = None
    for n in needles:
        e = c.contains(n)
        hit = e if hit is None else (hit | e)
    return F.coalesce(hit, F.lit(False))


def duck_regex(patterns: Iterable[str]) -> str:
    """Alternation for DuckDB ``regexp_matches`` (RE2), as a SQL string literal body."""
    return alternation(patterns).replace("'", "''")


def duck_matches_any(expr: str, patterns: Iterable[str], ignore_case: bool = True) -> str:
    pats = list(patterns)
    if not pats:
        return "FALSE"
    opt = ", 'i'" if ignore_case else ""
    return f"coalesce(regexp_matches({expr}, '{duck_regex(pats)}'{opt}), FALSE)"
