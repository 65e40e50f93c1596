"""Many regexes over many texts: an index of the literals that a match must contain.

An alternation of hundreds of patterns tries every one of them at every
character of a text.  Here each pattern is analysed once: :func:`needed` gives a
set of literals of which every match contains at least one (``eval\\(`` needs
``eval(``; ``(union|select)\\s`` needs ``union`` or ``select``).  One trigram of
each literal is its entry in the index.  Texts are cut into their distinct
trigrams, which meet the index in a join; a (text, pattern) pair that passes,
and whose literal the lower-cased text contains, is then matched by the regex
itself, so the result is exactly that of running every pattern.

Patterns without such a literal, and texts with characters beyond ASCII (which
can match a letter that they do not contain, as U+017F does "s"), go through
the alternations of :mod:`.regex` instead.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .regex import alternation, java_flags, matches_any

GRAM = 3
#: Patterns of a library from which on the index is used.
INDEX_FROM = 100


def _choices(items) -> list[frozenset[str]]:
    """Sets of literals of a parsed sequence, each of which every match meets."""
    out, run = [], []

    def flush():
        if len(run) >= GRAM:
            out.append(frozenset(["".join(run)]))
        run.clear()

    for op, arg in items:
        name = str(op)
        if name == "LITERAL" and arg < 128:
            run.append(chr(arg).lower())
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue  # no characters of the match; what stands around it stays adjacent
        else:
            flush()
            if name == "SUBPATTERN":
                out += _choices(arg[-1])
            elif name == "ATOMIC_GROUP":
                out += _choices(arg)
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] >= 1:
                out += _choices(arg[2])
            elif name == "BRANCH":
                best = [_best(_choices(branch)) for branch in arg[1]]
                if all(best):
                    out.append(frozenset().union(*best))
    flush()
    return out


def _best(choices: list[frozenset[str]]) -> frozenset[str] | None:
    """The set whose shortest literal is longest; of those the smallest."""
    return max(choices, key=lambda c: (min(map(len, c)), -len(c), sorted(c)), default=None)


def needed(pattern: str) -> frozenset[str] | None:
    """Lower-case literals of which every match of ``pattern`` contains one; None if there are none of ``GRAM`` characters."""
    try:
        return _best(_choices(parser.parse(pattern)))
    except (re.error, OverflowError, RecursionError):
        return None


def _grams(text: Column) -> Column:
    """The distinct trigrams of a lower-cased text."""
    n = F.length(text)
    at = F.when(n >= GRAM, F.sequence(F.lit(1), n - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.substr(text, i, F.lit(GRAM))))


def pattern_hits(keys: DataFrame, key: str, texts: Mapping[str, tuple[Column, list[str]]]) -> DataFrame:
    """``key`` and one boolean per entry of ``texts`` for the keys with any match.

    ``keys``: distinct non-null keys; ``texts``: flag -> (text of the key, patterns).
    Matching ignores case, as :func:`.regex.matches_any` does.
    """
    spark = keys.sparkSession
    entries, rest = [], {}
    for flag, (_, patterns) in texts.items():
        for p in dict.fromkeys(patterns):
            literals = needed(p)
            if literals is None:
                rest.setdefault(flag, []).append(p)
                continue
            regex = java_flags(True) + alternation([p])
            entries += [(flag, regex, x, x[:GRAM]) for x in literals]
    per_text = keys.select(F.col(key).alias("_key"), F.explode(F.array(*[
        F.struct(F.lit(flag).alias("flag"), text.alias("text")) for flag, (text, _) in texts.items()])).alias("t")).select("_key", "t.*").where("text is not null")
    ascii_only = ~F.col("text").rlike(r"[^\x00-\x7F]")

    index = spark.createDataFrame(entries, "flag string, regex string, literal string, gram string")
    grams = per_text.where(ascii_only).withColumn("low", F.lower("text")).withColumn("gram", F.explode(_grams(F.col("low"))))
    # the index is a reference list, bounded by the bytes of the pattern file
    found = (grams.join(F.broadcast(index), ["flag", "gram"]).where(F.col("low").contains(F.col("literal")))
             .select("_key", "flag", "text", "regex").where(F.rlike("text", "regex")).select("_key", "flag"))

    def inline(rows: DataFrame, lists: Mapping[str, list[str]]) -> DataFrame:
        hit = [(F.col("flag") == flag) & matches_any("text", p) for flag, p in lists.items() if p]
        return rows.where(reduce(lambda a, b: a | b, hit, F.lit(False))).select("_key", "flag")

    found = found.unionByName(inline(per_text.where(ascii_only), rest))
    found = found.unionByName(inline(per_text.where(~ascii_only), {flag: p for flag, (_, p) in texts.items()}))
    return found.groupBy(F.col("_key").alias(key)).agg(*[F.bool_or(F.col("flag") == flag).alias(flag) for flag in texts])
