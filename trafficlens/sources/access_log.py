"""Access-log text sources (IO1, IO2)."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import strip_ws
from .spread import spread

log = logging.getLogger(__name__)


def _hadoop_status(spark: SparkSession, path: str):
    """(exists, is_dir) via the Hadoop FileSystem of the session (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return False, False
    return True, fs.getFileStatus(p).isDirectory()


def resolve_log_paths(spark: SparkSession, paths: list[str] | str) -> list[str]:
    """IO1 path rules: a directory means its ``*.log`` files (not recursive), a file
    is taken as is, a missing path is warned about and skipped."""
    if isinstance(paths, str):
        paths = [paths]
    out = []
    for p in paths:
        exists, is_dir = _hadoop_status(spark, p)
        if not exists:
            log.warning("skipping missing log path %s", p)
            continue
        out.append(p.rstrip("/") + "/*.log" if is_dir else p)
    return out


def read_access_logs(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """IO1 + U1: all lines of the given files/directories as one DataFrame.

    Columns ``value`` (the line) and the file-order columns ``source_file``,
    ``block_start`` (start of the line's split) and ``line_id`` (increasing
    within a split).  ``line_id`` is taken in the scan task, before the rows are
    spread over the cluster, so ``FILE_ORDER`` sorts lines as in their files;
    it is deterministic, so a retried task reproduces it.
    """
    resolved = resolve_log_paths(spark, paths)
    if not resolved:
        return spark.createDataFrame([], "value string, source_file string, block_start bigint, line_id bigint")
    df = spark.read.text(resolved).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )
    return spread(df)


def lines_from_documents(documents: DataFrame, content: str = "content") -> DataFrame:
    """IO2: log content held in a column -> one row per line.

    Surrounding white space of a content is stripped.  The other columns pass
    through; ``line_id`` counts the lines of a content from 0, so both together
    sort lines as they were.  The split runs in the tasks that hold the contents;
    a null content has no lines.
    """
    others = [c for c in documents.columns if c != content]
    lines = F.posexplode(F.split(strip_ws(F.col(content)), "\n")).alias("line_id", "value")
    return documents.select(*others, lines).select("value", *others, F.col("line_id").cast("bigint").alias("line_id"))


def lines_from_text(spark: SparkSession, content: str) -> DataFrame:
    """IO2: log content given as one string -> one row per line, split in a task and then dealt out."""
    lines = lines_from_documents(spark.createDataFrame([(content,)], "content string"))
    return lines.repartition(spark.sparkContext.defaultParallelism)
