"""Threat-pattern library (IO9): a text file of regexes in ``# NAME PATTERNS`` sections.

The file is input data passed by path.  Lines get ordinals, each pattern line
takes the category of the last header above it (header positions are few and
become one ``CASE WHEN`` over the line number), outer parentheses are stripped, and each pattern is checked with
Python ``re`` in a pandas UDF; a pattern that does not compile is kept as a
literal (``re.escape``).  The library is a reference list, so it is collected
(within a byte bound), checked in the JVM, and becomes alternations for ``rlike``.

Routing of section headers:

* default: every upper-case ``# ...`` comment is a header; its name is mapped
  to a category by :data:`HEADER_ALIASES` or by its normalised text, so each
  section feeds its own flag;
* ``compat=True``: only a header containing ``PATTERNS`` whose normalised name
  is a known category switches the category, as the reference does; other
  sections fall into the previous category.  A pattern that does not compile is
  first tried with its brackets balanced (status ``repaired``).
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.regex import compiles_in_java
from .reputation_lists import collect_list, read_ordered_lines, with_line_no

# Header names that do not normalise to a category name (fixed values of the file layout).
HEADER_ALIASES = {
    "wordpress_specific": "wordpress",
    "common_malicious_file_extensions": "malicious_file_ext",
    "obfuscation_techniques": "obfuscation",
    "cryptocurrency_mining": "crypto_mining",
    "ransomware_and_financial_malware": "ransomware",
    "common_attack_tools_and_frameworks": "attack_tools",
    "additional_attack_tools_and_techniques": "additional_tools",
}

# Own small default library for the training profile (used when no file is given).
# Families shared with the serving profile reuse its fixed lists.
DEFAULT_LIBRARY = {
    "query_string": [r"(union|select|insert|drop)\s", r"<script", r"\.\./", r"(base64_encode|eval)\("],
    "request_uri": [r"\.\./", r"/\.(git|svn|env|htaccess)", r"/(etc/passwd|proc/self/environ)",
                    r"\.(bak|old|swp|sql)$"],
    "user_agent": [r"sqlmap", r"nikto", r"masscan", r"zgrab", r"python-requests"],
    "referrer": [r"(semalt|buttons-for-website)\.com"],
    "sql_injection": fixed.S_SQL_PATTERNS,
    "xss": fixed.S_XSS_PATTERNS,
    "command_injection": fixed.S_CMD_PATTERNS,
    "file_inclusion": fixed.S_FILE_PATTERNS,
    "wordpress": fixed.S_WORDPRESS_PATTERNS,
    "shell_upload": fixed.S_SHELL_PATTERNS,
    "malicious_file_ext": fixed.S_MALICIOUS_EXT_PATTERNS,
}


def _norm(name) -> str:
    return name.strip("# ").strip().lower().replace(" ", "_")


def _one_outer_pair(s: str) -> bool:
    """True when s[0] == '(' closes exactly at s[-1] (ignoring escaped parens)."""
    depth = 0
    i = 0
    while i < len(s):
        ch = s[i]
        if ch == "\\":
            i += 2
            continue
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0 and i != len(s) - 1:
                return False
        i += 1
    return depth == 0


#: A plus sign that is meant as written: escaped, alone in a class, or repeating a word character.
_SOUND_PLUS = re.compile(r"\\\+|\[\+\]|\w\+")


def balanced(pattern: str) -> str:
    """A pattern that does not compile, with its brackets evened out and its loose ends closed (compat mode)."""
    surplus = pattern.count("(") - pattern.count(")")
    if surplus >= 0:
        pattern += ")" * surplus
    else:
        pattern = pattern[-surplus:] if pattern.startswith(")") else "(" * -surplus + pattern
    pattern += "]" * (pattern.count("[") - pattern.count("]"))
    if not _SOUND_PLUS.search(pattern):
        pattern = pattern.replace("+", r"\+")
    return pattern + "." if pattern.endswith(("\\", "|")) else pattern


def _compiles(pattern: str) -> bool:
    try:
        re.compile(pattern)
        return True
    except re.error:
        return False


@F.pandas_udf(T.StructType([T.StructField("pattern", T.StringType()), T.StructField("status", T.StringType())]))
def _compile_check(p: pd.Series, compat: pd.Series) -> pd.DataFrame:
    rows = []
    for s, cm in zip(p, compat):
        if _compiles(s):
            rows.append((s, "ok"))
        elif cm and _compiles(balanced(s)):
            rows.append((balanced(s), "repaired"))
        else:
            rows.append((re.escape(s), "escaped"))
    return pd.DataFrame(rows, columns=["pattern", "status"])


@F.pandas_udf(T.StringType())
def _header_category(text: pd.Series, compat: pd.Series) -> pd.Series:
    out = []
    known = set(fixed.THREAT_CATEGORIES)
    for t, cm in zip(text, compat):
        if cm:
            if t.startswith("# ") and "PATTERNS" in t:
                name = _norm(t.split("PATTERNS")[0])
                out.append(name if name in known else None)
            else:
                out.append(None)
            continue
        body = t[2:].strip() if t.startswith("# ") else ""
        if not body or body != body.upper() or not re.search(r"[A-Z]", body):
            out.append(None)
            continue
        name = _norm(body)
        if name.endswith("_patterns"):
            name = name[: -len("_patterns")]
        if name == "end_of":
            out.append("__end__")
            continue
        name = HEADER_ALIASES.get(name, name)
        out.append(name if name in known else None)
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.StringType())
def _strip_outer(p: pd.Series, compat: pd.Series) -> pd.Series:
    out = []
    for s, cm in zip(p, compat):
        if s.startswith("(") and s.endswith(")") and (cm or _one_outer_pair(s)):
            s = s[1:-1]
        out.append(s)
    return pd.Series(out, dtype=object)


def patterns_from_lines(lines: DataFrame, compat: bool = False, value_col: str = "value") -> DataFrame:
    """Lines (with ``line_no`` if present) -> (line_no, category, pattern, status).

    Section headers are few: their positions are collected (within the byte
    bound of a reference list) and each line takes the category of the last
    header above it through one flat ``CASE WHEN line_no >= start`` expression,
    so the lines stay distributed (no ordered window, no join).
    """
    if "line_no" not in lines.columns:
        lines = with_line_no(lines)
    d = lines.select("line_no", F.trim(F.col(value_col)).alias("line"))
    hdr = F.when(F.col("line").startswith("#"), _header_category(F.col("line"), F.lit(compat)))
    heads = (d.where(F.col("line").startswith("#")).select("line_no", hdr.alias("_hdr"))
              .where(F.col("_hdr").isNotNull()))
    heads = sorted(collect_list(heads), key=lambda h: -h["line_no"])
    category = F.lit(None).cast("string")
    if heads:
        category = None
        for h in heads:  # last header first
            cond = F.col("line_no") >= F.lit(h["line_no"])
            category = F.when(cond, F.lit(h["_hdr"])) if category is None else category.when(cond, F.lit(h["_hdr"]))
    d = d.withColumn("category", category)
    d = d.where((F.col("line") != "") & ~F.col("line").startswith("#") & F.col("category").isNotNull()
                & (F.col("category") != "__end__"))
    d = d.withColumn("_p", _strip_outer(F.col("line"), F.lit(compat)))
    d = d.withColumn("_c", _compile_check(F.col("_p"), F.lit(compat)))
    return d.select("line_no", "category", F.col("_c.pattern").alias("pattern"), F.col("_c.status").alias("status"))


def read_patterns(spark: SparkSession, path: str, compat: bool = False) -> DataFrame:
    """A pattern file or a directory of them, lines numbered in file order."""
    return patterns_from_lines(read_ordered_lines(spark, path), compat)


def library(patterns: DataFrame) -> dict[str, list[str]]:
    """The pattern table as ``category -> [pattern, ...]`` in file order, ready to run.

    Patterns are written for Python and run in Java: one that Java does not
    compile under the flags it will run with is taken literally, as one that
    Python does not compile (see :func:`library_status`).
    """
    lib: dict[str, list[str]] = {c: [] for c in fixed.THREAT_CATEGORIES}
    for category, pattern, _ in library_status(patterns):
        lib.setdefault(category, []).append(pattern)
    return lib


def library_status(patterns: DataFrame) -> list[tuple[str, str, str]]:
    """(category, pattern as run, status) in file order; status ``ok``, ``escaped``
    (Python does not compile it) or ``escaped_java`` (only Java does not)."""
    out = []
    for r in sorted(collect_list(patterns), key=lambda r: r["line_no"]):
        pattern, status = r["pattern"], r["status"]
        if not compiles_in_java(patterns.sparkSession, pattern):
            pattern, status = re.escape(pattern), "escaped_java"
        out.append((r["category"], pattern, status))
    return out
