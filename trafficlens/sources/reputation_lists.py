"""IP blocklist (IO7) and malicious user-agent list (IO8) sources.

Both are small reference lists read as text by Spark; the HTTP download of the
reference is not built (pass a path or a DataFrame of lines).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import BLOCKLIST_LINE_REGEX, FALLBACK_MALICIOUS_USER_AGENTS

log = logging.getLogger(__name__)

#: Bytes of a reference list that is compiled into a plan's regex literals.
MAX_LIST_BYTES = 8 << 20


def with_line_no(df: DataFrame) -> DataFrame:
    # Deterministic for a given file split layout; orders lines within the list.
    return df.withColumn("line_no", F.monotonically_increasing_id())


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one or more text files with a ``line_no`` in file order (path, then offset).

    Spark packs file splits into tasks by size, so a plain
    ``monotonically_increasing_id`` follows file order only within a split.
    The splits (one row each) are ranked by (file, start) and each line's
    number is its split's rank, then its position within the split.
    """
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_pos"))
    splits = raw.groupBy("_file", "_start").agg(F.min("_pos").alias("_p0"))
    splits = splits.withColumn("_rank", F.row_number().over(Window.orderBy("_file", "_start")) - 1)
    # Not persisted: a cached split table would be reused for a later read of the
    # same path under another split layout (or after the file changed).  The join
    # strategy is Spark's (AQE broadcasts the measured, one-row-per-split side).
    d = raw.join(splits, ["_file", "_start"], "left")
    return d.select("value", (F.col("_rank") * F.lit(1 << 33) + F.col("_pos") - F.col("_p0")).alias("line_no"))


def blocklist_from_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse blocklist lines ``ip # CC ASN organisation`` -> (ip, country, asn, organization, line_no).

    Comment and blank lines are skipped, unmatched lines dropped.  Duplicate IPs
    are kept here (ASN counts count lines); :func:`blocklist_by_ip` de-duplicates.
    """
    if "line_no" not in lines.columns:
        lines = with_line_no(lines)
    v = F.col(value_col)
    ok = ~v.startswith("#") & (F.trim(v) != "") & v.rlike(BLOCKLIST_LINE_REGEX)
    return lines.where(ok).select(
        F.regexp_extract(v, BLOCKLIST_LINE_REGEX, 1).alias("ip"),
        F.regexp_extract(v, BLOCKLIST_LINE_REGEX, 2).alias("country"),
        F.regexp_extract(v, BLOCKLIST_LINE_REGEX, 3).alias("asn"),
        F.trim(F.regexp_extract(v, BLOCKLIST_LINE_REGEX, 4)).alias("organization"),
        F.col("line_no").cast("bigint").alias("line_no"),
    )


def read_blocklist(spark: SparkSession, path: str | None) -> DataFrame:
    """IO7: the blocklist file.  No path or a missing file gives an empty list
    (every IP unlisted), as the serving side of the reference falls back to
    when its list cannot be fetched (Q11); a warning is logged."""
    from .access_log import _hadoop_status
    if path is None or not _hadoop_status(spark, path)[0]:
        log.warning("blocklist %s not available; using an empty list", path)
        return blocklist_from_lines(spark.createDataFrame([], "value string, line_no bigint"))
    return blocklist_from_lines(read_ordered_lines(spark, path))


def blocklist_by_ip(bl: DataFrame) -> DataFrame:
    """One row per IP; the last line wins (Q10)."""
    last = F.max_by(F.struct("country", "asn", "organization"), "line_no")
    return bl.groupBy("ip").agg(last.alias("_r")).select("ip", "_r.*")


def ua_list_from_lines(lines: DataFrame, value_col: str = "value", header: bool = True) -> DataFrame:
    """Malicious-UA list CSV: skip the header, first field trimmed -> ``pattern``."""
    if "line_no" not in lines.columns:
        lines = with_line_no(lines)
    d = lines
    if header:
        first = d.agg(F.min("line_no")).scalar()
        d = d.where(F.col("line_no") != first)
    field = F.trim(F.split(F.col(value_col), ",", 2)[0])
    return d.where(F.col(value_col) != "").select(field.alias("pattern")).where(F.col("pattern") != "")


def read_ua_list(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path is None:
        return fallback_ua_list(spark)
    return ua_list_from_lines(read_ordered_lines(spark, path))


def fallback_ua_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p,) for p in FALLBACK_MALICIOUS_USER_AGENTS], "pattern string")


def collect_list(table: DataFrame, max_bytes: int = MAX_LIST_BYTES) -> list:
    """The rows of a reference list, after its bytes were measured.

    The list becomes regex literals in a query plan, so its size is bounded; a
    larger one is no reference list and raises, with nothing collected.
    """
    texts = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in table.schema if isinstance(f.dataType, T.StringType)]
    size = table.agg(F.sum(sum(texts, F.lit(16)))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"a reference list of {size} bytes; the bound is {max_bytes}")
    return table.collect()


def ua_patterns(ua_list: DataFrame) -> list[str]:
    """The list as Python strings, to be compiled into ``rlike`` literals."""
    return [r["pattern"] for r in collect_list(ua_list.select("pattern"))]
