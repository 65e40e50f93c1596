"""A store of per-day partials from which whole-input results are combined.

A log grows by days.  :func:`write_days` summarises the rows of some days into
tables partitioned by ``day`` and replaces just these partitions, so re-running
a day changes that day only.  The functions below combine all days into what
the operators of :mod:`trafficlens.operators` give on the whole input:

* counts, sums, minima and maxima add up;
* gaps between requests (W1) are taken within a day as moments; the gap from a
  client's last row of one day to its first row of the next day on which it was seen is
  added when days are combined;
* distinct paths per client are kept as exact sets of (ip, path);
* the A6 threshold comes from the merged moments of the days' per-minute counts.

Rows without a time are partition ``NO_DAY``: they count as requests and are
seen on no day.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import traffic as TR
from ..operators.dims import scalar
from ..operators.moments import aggregates, merged, std_samp
from ..operators.summary import hourly_partials, hourly_totals

NO_DAY = "1970-01-01"


def _seconds(later, earlier):
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def with_day(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("day", F.coalesce(F.to_date("timestamp"), F.lit(NO_DAY).cast("date")))


def day_tables(parsed: DataFrame, tiebreak: list[str] | None = None) -> dict[str, DataFrame]:
    """The partials of every day that has rows."""
    d = TR.add_time_diff(with_day(parsed), key=["day", "ip"], tiebreak=tiebreak, with_prev=False)
    d = d.withColumns({"is_legitimate": L.is_legitimate(), "is_human": L.is_human()}) if "classification" in d.columns else d
    status = F.col("status_code")
    ip = d.groupBy("day", "ip").agg(
        F.count(F.lit(1)).alias("rows"), F.count("timestamp").alias("requests"),
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"),
        F.count("status_code").alias("statuses"), F.count_if(status >= 400).alias("errors"), F.count_if(status >= 500).alias("server_errors"),
        *aggregates("time_diff"), F.min("time_diff").alias("least_gap"))
    timed = d.where(F.col("timestamp").isNotNull())
    minutes = timed.groupBy("day", TR.minute_of().alias("minute")).agg(F.count(F.lit(1)).alias("requests"))
    out = {"ip": ip, "ip_path": d.select("day", "ip", "path").distinct(), "minute": minutes,
           "minute_moments": minutes.groupBy("day").agg(*aggregates("requests"))}
    if "classification" in d.columns:
        out["hour"] = hourly_partials(d).withColumn("day", F.to_date("hour"))
    return out


def write_days(parsed: DataFrame, base: str, tiebreak: list[str] | None = None) -> None:
    """Replace the partitions of the days that ``parsed`` has rows of; it must hold these days whole."""
    for name, df in day_tables(parsed, tiebreak).items():
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(os.path.join(base, name))


def read_days(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, table))


def ip_counts(spark: SparkSession, base: str) -> DataFrame:
    """A1 of all days."""
    return read_days(spark, base, "ip").groupBy("ip").agg(F.sum("rows").alias("request_count"))


def rate_train(spark: SparkSession, base: str) -> DataFrame:
    """A2 of all days: ``ip, request_count_per_ip, requests_per_minute``."""
    g = read_days(spark, base, "ip").groupBy("ip").agg(
        F.sum("rows").alias("request_count_per_ip"), F.min("first_seen").alias("a"), F.max("last_seen").alias("b"))
    n, span = F.col("request_count_per_ip"), _seconds(F.col("b"), F.col("a")) / 60.0
    rate = F.when(n > 1, F.when(span > 0, n / span).otherwise(n.cast("double"))).otherwise(F.lit(1.0))
    return g.select("ip", "request_count_per_ip", rate.alias("requests_per_minute"))


def ip_stats(spark: SparkSession, base: str) -> DataFrame:
    """A3 of all days."""
    days = read_days(spark, base, "ip")
    # the gap between a client's days, as the moments of one value; one row per client and day, few per client
    before = F.lag("last_seen").over(Window.partitionBy("ip").orderBy(F.col("day")))
    seen = days.where(F.col("requests") > 0).withColumn("gap", _seconds(F.col("first_seen"), before)).where(F.col("gap").isNotNull())
    gaps = seen.select("ip", F.lit(1).cast("bigint").alias("n"), F.col("gap").alias("mean"), F.lit(0.0).alias("m2"), F.col("gap").alias("least_gap"))
    m = (days.select("ip", "n", "mean", "m2", "least_gap").unionByName(gaps)
         .groupBy("ip").agg(merged().alias("m"), F.min("least_gap").alias("min_time_between_requests"))
         .select("ip", "m.*", "min_time_between_requests")
         .select("ip", F.col("mean").alias("avg_time_between_requests"), "min_time_between_requests", std_samp().alias("std_time_between_requests")))
    sums = days.groupBy("ip").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("requests").alias("request_count"),
        (F.sum("errors") / F.sum("statuses")).alias("error_rate"), (F.sum("server_errors") / F.sum("statuses")).alias("server_error_rate"))
    paths = read_days(spark, base, "ip_path").groupBy("ip").agg(F.count_distinct("path").alias("unique_paths"))
    dur, cnt = _seconds(F.col("last_seen"), F.col("first_seen")) / 60.0, F.col("request_count")
    return (sums.join(m, "ip").join(paths, "ip").withColumn("duration_minutes", dur)
            .withColumn("requests_per_minute", F.when(dur > 0, cnt / dur).otherwise(cnt.cast("double"))))


def spike_minutes(spark: SparkSession, base: str, z: float = 3.0) -> DataFrame:
    """A6 of all days: the threshold from the days' merged moments."""
    m = scalar(read_days(spark, base, "minute_moments").agg(merged().alias("m")))
    sd = F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)))
    return read_days(spark, base, "minute").where((sd > 0) & ((F.col("requests") - m["mean"]) / sd > z)).select("minute")


def hourly_counts(spark: SparkSession, base: str) -> DataFrame:
    """A16 of all days."""
    return hourly_totals(read_days(spark, base, "hour").drop("day"))


def distinct_ips(spark: SparkSession, base: str) -> DataFrame:
    """A23 of all days."""
    return read_days(spark, base, "ip").select("ip").distinct()
