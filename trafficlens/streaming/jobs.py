"""Structured Streaming jobs (ST1-ST3) built from the batch transforms.

* ST1 ``parse_stream``: new log lines -> parsed rows + row-local flags and a
  stream-static join with the (bounded, broadcast) per-IP blocklist.
* ST2 ``hourly_partial`` / ``hourly_total``: hourly class roll-up.
* ST3 ``rate_partial`` / ``rate_alerts``: per (ip, minute) request counts above a threshold.

The jobs with event-time state (late rows, alerts while the stream runs, gaps
across batches, statistics of closed days) are in :mod:`.event_time`.

:func:`run_to_table` runs a row stream, :func:`run_merged` an aggregation, to
completion with an ``availableNow`` trigger into a Parquet table in the shared
checkpoint folder; results never pass through the driver.  Aggregations merge the
partial counts of all batches when read, so late rows are counted.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as X
from ..functions import labels as L
from ..functions.fixed import FALLBACK_MALICIOUS_USER_AGENTS
from ..operators.dims import join_dim, materialize
from ..operators.parse import parse_access_log
from ..operators.summary import hourly_partials, hourly_totals
from ..session import checkpoint_dir
from ..sources import fixtures as fx


def event_log_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """The fixture access log as a stream of raw lines, from the ``events`` file source."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    ev = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
          .option("pathGlobFilter", "events.parquet").parquet(sf_dir)
          .withColumn("ts", F.col("ts").cast("timestamp")))
    return fx.lines_from_requests(spark.sql(fx.REQ_ALL_SQL, events=ev))


def log_text_stream(spark: SparkSession, directory: str) -> DataFrame:
    """ST1 source for real logs: new ``*.log`` files in a directory, one row per line."""
    return spark.readStream.option("pathGlobFilter", "*.log").text(directory)


def parse_stream(lines: DataFrame, blocklist: DataFrame | None = None) -> DataFrame:
    """ST1: parse + row-local flags (+ stream-static reputation lookup)."""
    p = parse_access_log(lines)
    p = p.withColumns({
        "is_error": X.is_error(), "is_server_error": X.is_server_error(),
        "has_query_params": X.has_query_params(), "path_traversal": X.path_traversal(),
        **X.ua_flags_S(FALLBACK_MALICIOUS_USER_AGENTS),
    })
    if blocklist is not None:
        from ..sources.reputation_lists import blocklist_by_ip
        # The static side is written once, as a stream's plan allows no line numbering, and counted; broadcast only within the bound.
        bl = materialize(blocklist_by_ip(blocklist).select("ip", "country", "asn"))
        p = join_dim(p, bl, "ip", "left").withColumns({
            "ip_is_known_bad": F.col("asn").isNotNull(),
            "country": F.coalesce("country", F.lit("Unknown")),
            "asn": F.coalesce("asn", F.lit("Unknown"))})
    return p


def hourly_partial(lines: DataFrame) -> DataFrame:
    """ST2, one micro-batch: A16 counts per hour, with the sums that later batches add to."""
    p = parse_access_log(lines).where(F.col("timestamp").isNotNull())
    return hourly_partials(p.withColumns({"is_legitimate": L.is_legitimate(), "is_human": L.is_human()}))


def hourly_total(partials: DataFrame) -> DataFrame:
    """ST2: the hourly table from the partial counts of all batches."""
    return hourly_totals(partials)


def rate_partial(lines: DataFrame) -> DataFrame:
    """ST3, one micro-batch: requests per (ip, minute)."""
    p = parse_access_log(lines).where(F.col("timestamp").isNotNull())
    return p.groupBy("ip", F.date_trunc("minute", "timestamp").alias("minute")).agg(F.count(F.lit(1)).alias("requests"))


def rate_alerts(partials: DataFrame, threshold: int = 30) -> DataFrame:
    """ST3: (ip, minute) with more than ``threshold`` requests over all batches."""
    g = partials.groupBy("ip", "minute").agg(F.sum("requests").alias("requests"))
    return g.where(F.col("requests") > threshold)


def run_merged(spark: SparkSession, source: DataFrame, partial: Callable[[DataFrame], DataFrame],
               total: Callable[[DataFrame], DataFrame], name: str | None = None) -> DataFrame:
    """Aggregate a stream without a watermark: no row is too late.

    Every micro-batch is aggregated on its own and its partial rows are written
    to a folder of that batch (a retried batch writes the same folder anew);
    ``total`` adds them up when the table is read.  Nothing is kept between
    batches, and a row counts in its own window whenever it arrives.
    """
    base = os.path.join(checkpoint_dir(spark), "streams", name or f"run-{uuid.uuid4().hex[:12]}")
    out = os.path.join(base, "partials")

    def write(batch: DataFrame, batch_id: int) -> None:
        partial(batch).write.mode("overwrite").parquet(os.path.join(out, f"_batch={batch_id}"))

    empty = partial(spark.createDataFrame([], source.schema))
    empty.write.mode("overwrite").parquet(os.path.join(out, "_batch=-1"))
    q = (source.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(base, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return total(spark.read.schema(empty.schema).option("basePath", out).parquet(os.path.join(out, "_batch=*")))


def run_to_table(spark: SparkSession, source: DataFrame, build: Callable[[DataFrame], DataFrame],
                 name: str | None = None) -> DataFrame:
    """Run the row stream ``build(source)`` until the available input is processed.

    Output goes through the file sink (exactly-once; its commit log ignores the
    files of a retried batch) to a Parquet table under the shared checkpoint
    folder, which is read back.
    """
    base = os.path.join(checkpoint_dir(spark), "streams", name or f"run-{uuid.uuid4().hex[:12]}")
    out, ckpt = os.path.join(base, "table"), os.path.join(base, "checkpoint")
    q = (build(source).writeStream.outputMode("append").option("checkpointLocation", ckpt)
         .format("parquet").option("path", out).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
