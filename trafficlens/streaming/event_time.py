"""Streaming jobs with event-time state (ST1 lag, ST2, ST3, closed days).

The jobs share a clock: the *horizon* of a batch is the largest timestamp of all
earlier batches minus the allowed ``delay``.  A period (hour, day) is closed
once the horizon has reached its end; rows of a closed period are late.

* :func:`run_hourly` (ST2): an hour is emitted once, when it closes; late rows go
  to a side table and are counted.  On-time and late rows together are all rows.
* :func:`run_alerts` (ST3): Spark's own windowed aggregation with a watermark holds
  the counts per (ip, minute); a pair is emitted in the batch in which it
  crosses the threshold, and never again.
* :func:`run_lag` (W1): the last timestamp per client is carried from batch to batch.
* :func:`run_days` (A6, A10, A11): a day's thresholds are computed when it closes;
  a late row opens the day again and its results are replaced.

State lives in :class:`~trafficlens.streaming.tables.BatchTables`; a batch that
is run again after a failure writes the same rows again.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import traffic as TR
from ..operators.moments import moments, std_samp
from ..operators.parse import parse_access_log
from ..operators.reputation import add_reputation
from ..operators.summary import hourly_partials, hourly_totals
from ..session import checkpoint_dir
from .tables import BatchTables


@dataclass
class Job:
    """A finished or stopped run: its tables, and the folder that a restart is given."""

    base: str
    tables: BatchTables


def _base(spark: SparkSession, name: str | None) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name or f"run-{uuid.uuid4().hex[:12]}")


def _run(spark: SparkSession, source: DataFrame, base: str, process: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    q = (source.writeStream.outputMode(mode).foreachBatch(process).option("checkpointLocation", os.path.join(base, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _later(a, b):
    """The later of two times, of which either may be missing."""
    return b if a is None else a if b is None else max(a, b)


class Clock:
    """The largest timestamp so far, kept in a snapshot of one row."""

    def __init__(self, tables: BatchTables, delay_seconds: int):
        self.tables, self.delay = tables, delay_seconds

    def newest(self, batch: int | None = None) -> int | None:
        """Microseconds; of all batches below ``batch``."""
        s = self.tables.snapshot("clock", batch)
        return s.first()["newest"] if s is not None else None

    def horizon(self, newest: int | None):
        """Periods that end at or before this are closed; null while nothing was seen."""
        return F.lit(None).cast("timestamp") if newest is None else F.timestamp_micros(F.lit(newest - self.delay * 1_000_000))

    def advance(self, batch: int, rows: DataFrame) -> int | None:
        seen = rows.agg(F.max(F.unix_micros("timestamp"))).first()[0]
        newest = _later(self.newest(batch), seen)
        self.tables.write_snapshot("clock", batch, rows.sparkSession.createDataFrame([(newest,)], "newest bigint").coalesce(1))
        return newest


def _closed(end, horizon):
    return F.coalesce(end <= horizon, F.lit(False))


# -- ST2 ---------------------------------------------------------------------

def run_hourly(spark: SparkSession, lines: DataFrame, delay: int = 7200, name: str | None = None) -> Job:
    """Hourly roll-up of a stream of lines; ``delay`` in seconds.

    Tables: ``hours`` (closed hours, each once), ``open`` (snapshot of the others),
    ``late`` (the late rows).  Rows without a time belong to no hour.
    """
    base = _base(spark, name)
    tables = BatchTables(spark, os.path.join(base, "tables"))
    clock = Clock(tables, delay)

    def process(batch: DataFrame, batch_id: int) -> None:
        p = parse_access_log(batch).where(F.col("timestamp").isNotNull())
        p = p.withColumns({"is_legitimate": L.is_legitimate(), "is_human": L.is_human(), "hour": F.date_trunc("hour", "timestamp")}).persist()
        end = F.col("hour") + F.expr("INTERVAL 1 HOUR")
        before = clock.horizon(clock.newest(batch_id))
        partial = hourly_partials(p.where(~_closed(end, before)))
        carried = tables.snapshot("open", batch_id)
        now = clock.horizon(clock.advance(batch_id, p))
        merged = (partial if carried is None else partial.unionByName(carried)).groupBy("hour").agg(
            *[F.sum(c).alias(c) for c in partial.columns if c != "hour"])
        tables.append("late", batch_id, p.where(_closed(end, before)))
        tables.append("hours", batch_id, merged.where(_closed(end, now)))
        tables.write_snapshot("open", batch_id, merged.where(~_closed(end, now)))
        p.unpersist()

    _run(spark, lines, base, process)
    return Job(base, tables)


def hourly_result(job: Job, with_late: bool = False) -> DataFrame:
    """The hourly table: closed and open hours; on request with the late rows added to theirs."""
    parts = job.tables.rows("hours").unionByName(job.tables.snapshot("open"))
    if with_late:
        parts = parts.unionByName(hourly_partials(job.tables.rows("late").drop("hour")))
    return hourly_totals(parts)


def late_per_hour(job: Job) -> DataFrame:
    return job.tables.rows("late").groupBy("hour").agg(F.count(F.lit(1)).alias("late_requests"))


# -- ST3 ---------------------------------------------------------------------

def run_alerts(spark: SparkSession, lines: DataFrame, threshold: int = 30, delay: str = "1 hour", name: str | None = None) -> Job:
    """Table ``alerts`` (ip, minute, requests, batch): each pair above ``threshold`` once, in the batch it crosses it.

    The counts are the state of a windowed aggregation, which drops a minute
    ``delay`` after its end; rows that come later still are not counted
    (``numRowsDroppedByWatermark`` of the stream's progress).
    """
    base = _base(spark, name)
    tables = BatchTables(spark, os.path.join(base, "tables"))
    p = parse_access_log(lines).where(F.col("timestamp").isNotNull())
    counts = (p.withWatermark("timestamp", delay).groupBy("ip", F.window("timestamp", "1 minute").alias("w"))
              .agg(F.count(F.lit(1)).alias("requests")).select("ip", F.col("w.start").alias("minute"), "requests"))

    def process(changed: DataFrame, batch_id: int) -> None:
        """``changed``: the new total of every (ip, minute) with rows in this batch."""
        above = changed.where(F.col("requests") > threshold).withColumn("batch", F.lit(batch_id).cast("bigint"))
        earlier = tables.rows("alerts", batch_id)
        if earlier is not None:
            above = above.join(earlier.select("ip", "minute"), ["ip", "minute"], "left_anti")
        tables.append("alerts", batch_id, above)

    _run(spark, counts, base, process, "update")
    return Job(base, tables)


# -- W1 across batches -------------------------------------------------------

def run_lag(spark: SparkSession, lines: DataFrame, expiry: int | None = None, tiebreak: list[str] | None = None, name: str | None = None) -> Job:
    """Table ``rows``: parsed rows with ``time_diff`` to the client's previous row, also of an earlier batch.

    For a log whose files come in time order the result is that of the batch
    operator.  A row before its client's carried timestamp is ``out_of_order``:
    its gap counts within its own batch only.  A client not seen for ``expiry``
    seconds of event time is forgotten.
    """
    base = _base(spark, name)
    tables = BatchTables(spark, os.path.join(base, "tables"))

    def process(batch: DataFrame, batch_id: int) -> None:
        p = parse_access_log(batch)
        order = tiebreak or TR.default_order(p)
        p = p.persist()
        state = tables.snapshot("last", batch_id)
        here = p.where(F.col("timestamp").isNotNull()).groupBy("ip").agg(F.max("timestamp").alias("seen"))
        rows = p.withColumn("_carried", F.lit(1))
        if state is not None:
            # the carried row stands before the batch's rows of the same time
            seeds = state.join(here.select("ip"), "ip", "left_semi").select("ip", F.col("seen").alias("timestamp"), F.lit(0).alias("_carried"))
            rows = rows.unionByName(seeds, allowMissingColumns=True)
            here = here.unionByName(state)
        d = TR.add_time_diff(rows, tiebreak=["_carried", *order])
        d = d.where("_carried = 1").drop("_carried")
        if state is not None:
            d = d.join(state.withColumnRenamed("seen", "_seen"), "ip", "left").withColumn(
                "out_of_order", F.coalesce(F.col("timestamp") < F.col("_seen"), F.lit(False))).drop("_seen")
        else:
            d = d.withColumn("out_of_order", F.lit(False))
        last = here.groupBy("ip").agg(F.max("seen").alias("seen"))
        if expiry is not None:
            newest = last.agg(F.max("seen")).scalar()
            last = last.where(F.unix_micros("seen") >= F.unix_micros(newest) - expiry * 1_000_000)
        tables.append("rows", batch_id, d)
        tables.write_snapshot("last", batch_id, last)
        p.unpersist()

    _run(spark, lines, base, process)
    return Job(base, tables)


# -- closed days -------------------------------------------------------------

DAY_RESULTS = ("spike_minutes", "spikes", "asns")


def run_days(spark: SparkSession, lines: DataFrame, blocklist: DataFrame, delay: int = 3600, finish: bool = True,
             only: tuple[str, ...] = DAY_RESULTS, name: str | None = None) -> Job:
    """A6, A10 and A11 per closed day.

    Kept: counts per (day, ip, minute).  When a day closes, or gets late rows after
    that, its partitions of the tables ``spike_minutes``, ``spikes`` and ``asns``
    (below ``results``; ``only`` some of them) are computed from the counts and
    replaced.  ``finish`` closes the days that are still open at the end.
    """
    base = _base(spark, name)
    tables = BatchTables(spark, os.path.join(base, "tables"))
    clock = Clock(tables, delay)
    results = os.path.join(base, "results")

    def publish(days: DataFrame, upto: int | None) -> None:
        dates = [r["day"] for r in days.distinct().collect()]  # a few dates; as literals they prune the files
        counts = tables.rows("minutes", upto)
        if not dates or counts is None:
            return
        counts = counts.where(F.col("day").isin(dates)).groupBy("day", "ip", "minute").agg(F.sum("n").alias("count")).persist()
        made = {"spike_minutes": lambda: _spike_minutes(counts), "spikes": lambda: _spikes(counts), "asns": lambda: _asns(counts, blocklist)}
        for table in only:
            (made[table]().write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day")
             .parquet(os.path.join(results, table)))
        counts.unpersist()

    def process(batch: DataFrame, batch_id: int) -> None:
        p = parse_access_log(batch).where(F.col("timestamp").isNotNull()).withColumn("day", F.to_date("timestamp")).persist()
        end = F.date_add("day", 1).cast("timestamp")
        now = clock.horizon(clock.advance(batch_id, p))
        tables.append("minutes", batch_id, p.groupBy("day", "ip", TR.minute_of().alias("minute")).agg(F.count(F.lit(1)).alias("n")))
        here, carried = p.select("day").distinct(), tables.snapshot("open_days", batch_id)
        seen = here if carried is None else here.unionByName(carried).distinct()
        # closed by now: days that were open, and closed ones with late rows
        publish(seen.where(_closed(end, now)), batch_id + 1)
        tables.write_snapshot("open_days", batch_id, seen.where(~_closed(end, now)).coalesce(1))
        p.unpersist()

    _run(spark, lines, base, process)
    if finish:
        left = tables.snapshot("open_days")
        if left is not None:
            publish(left, None)
    return Job(base, tables)


def day_results(spark: SparkSession, job: Job, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(job.base, "results", table))


def _spike_minutes(counts: DataFrame) -> DataFrame:
    """Every minute of a day with its A6 flag (a day without spikes keeps its partition)."""
    per_min = counts.groupBy("day", "minute").agg(F.sum("count").alias("requests"))
    m = moments(per_min, ["day"], "requests")
    z = (F.col("requests") - F.col("mean")) / std_samp()
    return (per_min.join(F.broadcast(m), "day").select("day", "minute", "requests", F.coalesce((std_samp() > 0) & (z > 3.0), F.lit(False)).alias("is_spike")))


def _spikes(counts: DataFrame) -> DataFrame:
    ip = _rates(counts)
    return TR.with_spike_flag_serve(ip, scope=["day"]).select("day", "ip", "requests_per_minute", "during_traffic_spike")


def _rates(counts: DataFrame) -> DataFrame:
    return counts.groupBy("day", "ip").agg(F.avg("count").alias("requests_per_minute"), F.sum("count").alias("ip_rows"))


def _asns(counts: DataFrame, blocklist: DataFrame) -> DataFrame:
    ip = add_reputation(_rates(counts), blocklist, "serve")
    hot = TR.coordinated_asns_serve(ip, ["day"]).withColumn("is_coordinated", F.lit(True))
    return (ip.select("day", "asn").distinct().join(hot, ["day", "asn"], "left")
            .withColumn("is_coordinated", F.coalesce("is_coordinated", F.lit(False))))
