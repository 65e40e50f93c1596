"""Per-client traffic statistics and detectors.

Design for skew: a single client IP may send a third of all requests.

* Aggregates are ``groupBy`` with map-side partial aggregation, never a window
  over ``partitionBy("ip")``.
* The lag of W1 needs row order within an IP.  It is computed within
  (ip, time bucket) partitions, so a hot IP is spread over many tasks, and the
  first row of each bucket is stitched to the last timestamp of the IP's
  previous non-empty bucket, found by a small window over the per-bucket
  maxima.  Result is exactly a lag over the whole IP.
* Global thresholds are scalar subqueries over one-row aggregates.
* ``scope``: optional columns (e.g. a day) that bound every statistic, as
  the reference's per-chunk statistics do (Q1).  They are added to every
  grouping and window key; a global threshold becomes a per-scope table
  (one row per scope value), joined on the scope.  Scope columns must be
  non-null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import FILE_ORDER
from .dims import join_dim, scalar

FAR_FUTURE = "9999-12-31 00:00:00"


#: Window partitions over which the rows without a time of one key are spread.
NULL_TIME_PARTS = 64


def _seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def minute_of(ts: str = "timestamp") -> Column:
    return F.date_trunc("minute", F.col(ts))


def default_order(df: DataFrame) -> list[str]:
    """Tie-break for equal timestamps: file order where the reader provided it
    (``FILE_ORDER`` columns present), then the raw line."""
    return [c for c in FILE_ORDER if c in df.columns] + [c for c in ["raw_log"] if c in df.columns]


def add_time_diff(df: DataFrame, key: str | list[str] = "ip", ts: str = "timestamp",
                  tiebreak: list[str] | None = None, bucket: str = "minute",
                  with_prev: bool = True) -> DataFrame:
    """``prev_timestamp`` (lag of ``ts`` within ``key`` ordered by ts, nulls
    last, then ``tiebreak``, by default :func:`default_order`) and ``time_diff``
    in seconds (null for the first row and for rows with a null ts).  ``key`` may
    be several columns (scope + ip)."""
    keys = [key] if isinstance(key, str) else list(key)
    tiebreak = tiebreak or default_order(df)
    b = F.coalesce(F.date_trunc(bucket, F.col(ts)), F.to_timestamp(F.lit(FAR_FUTURE)))
    d = df.withColumn("_tb", b)
    # Rows without a time have no order among them but for the first (by tie-break),
    # which is found by the aggregate below; the window spreads them by hash.
    none, place = F.col(ts).isNull(), F.struct(*[F.col(c) for c in tiebreak]) if tiebreak else F.struct(F.lit(0))
    d = d.withColumn("_part", F.when(none, F.pmod(F.xxhash64(place), F.lit(NULL_TIME_PARTS))).otherwise(F.lit(0)))
    w = Window.partitionBy(*keys, "_tb", "_part").orderBy(F.col(ts).asc_nulls_last(), *[F.col(c) for c in tiebreak])
    d = d.withColumn("_lag", F.lag(ts).over(w)).withColumn("_rn", F.row_number().over(w))
    # Per-(key, bucket) maxima, partially aggregated from the scan (small: one row
    # per key and active bucket).
    bmax = d.groupBy(*keys, "_tb").agg(F.max(ts).alias("_bmax"), F.min(F.when(none, place)).alias("_first"))
    wb = Window.partitionBy(*keys).orderBy("_tb")
    # Previous non-empty bucket's last timestamp.  The far-future bucket holds the
    # null-ts rows and has a null max, so it never feeds a later bucket.
    prev = bmax.withColumn("_pmax", F.lag("_bmax").over(wb)).select(*keys, "_tb", "_pmax", "_first")
    d = d.join(prev, [*keys, "_tb"], "left")
    prev_ts = (F.when(none, F.when(place == F.col("_first"), F.col("_pmax")))
               .when(F.col("_rn") == 1, F.col("_pmax")).otherwise(F.col("_lag")))
    d = d.withColumn("prev_timestamp", prev_ts)
    d = d.withColumn("time_diff", _seconds_between(F.col(ts), F.col("prev_timestamp")))
    d = d.drop("_tb", "_part", "_lag", "_rn", "_pmax", "_first")
    if not with_prev:
        d = d.drop("prev_timestamp")
    return d


# ---------------------------------------------------------------------------
# Training profile (T)
# ---------------------------------------------------------------------------

def ip_counts(df: DataFrame) -> DataFrame:
    """A1: requests per IP."""
    return df.groupBy("ip").agg(F.count(F.lit(1)).alias("request_count"))


def ip_stats_train(df: DataFrame, ts: str = "timestamp", scope: list[str] | None = None) -> DataFrame:
    """Per-IP aggregates used by T: A1, A2, A3 (without time_diff moments), A4, A5.

    ``avg_time_between_requests`` is exact without the window: consecutive gaps
    of the non-null timestamps telescope to (last - first) / (n_ts - 1).
    """
    g = df.groupBy(*(scope or []), "ip").agg(
        F.count(F.lit(1)).alias("request_count_per_ip"),
        F.count(ts).alias("request_count"),
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
        F.count_distinct("path").alias("unique_paths"),
    )
    span_min = _seconds_between(F.col("last_seen"), F.col("first_seen")) / 60.0
    n = F.col("request_count_per_ip")
    rpm_t = (F.when(n > 1, F.when(span_min > 0, n / span_min).otherwise(n.cast("double")))
             .otherwise(F.lit(1.0)))
    cnt = F.col("request_count")
    rpm3 = F.when(span_min > 0, cnt / span_min).otherwise(cnt.cast("double"))
    avg_gap = F.when(cnt > 1, _seconds_between(F.col("last_seen"), F.col("first_seen")) / (cnt - 1))
    return (g.withColumn("requests_per_minute", rpm_t)
             .withColumn("duration_minutes", span_min)
             .withColumn("ip_requests_per_minute", rpm3)
             .withColumn("avg_time_between_requests", avg_gap)
             .withColumn("potential_dos", F.coalesce(
                 (F.col("ip_requests_per_minute") > 30) & (F.col("avg_time_between_requests") < 1.0)
                 & (cnt > 50), F.lit(False)))
             .withColumn("potential_scanner", (F.col("unique_paths") > 20) & (cnt > 30)))


def ip_stats_full(df_with_diff: DataFrame, ts: str = "timestamp") -> DataFrame:
    """A3 as a report: all per-IP statistics, including time_diff moments (needs W1)."""
    g = df_with_diff.groupBy("ip").agg(
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
        F.count(ts).alias("request_count"),
        F.avg("time_diff").alias("avg_time_between_requests"),
        F.min("time_diff").alias("min_time_between_requests"),
        F.stddev_samp("time_diff").alias("std_time_between_requests"),
        F.avg((F.col("status_code") >= 400).cast("double")).alias("error_rate"),
        F.avg((F.col("status_code") >= 500).cast("double")).alias("server_error_rate"),
        F.count_distinct("path").alias("unique_paths"),
    )
    dur = _seconds_between(F.col("last_seen"), F.col("first_seen")) / 60.0
    cnt = F.col("request_count")
    return (g.withColumn("duration_minutes", dur)
             .withColumn("requests_per_minute",
                         F.when(dur > 0, cnt / dur).otherwise(cnt.cast("double"))))


def spike_minutes_train(df: DataFrame, ts: str = "timestamp", z: float = 3.0,
                        scope: list[str] | None = None) -> DataFrame:
    """Minutes whose request count has z-score > ``z`` over minutes with requests
    (of the same scope)."""
    scope = scope or []
    per_min = df.where(F.col(ts).isNotNull()).groupBy(*scope, minute_of(ts).alias("minute")).count()
    if scope:
        # Per-scope mean and std: one row per scope value, joined on the scope.
        st = per_min.groupBy(*scope).agg(F.avg("count").alias("_m"), F.stddev_samp("count").alias("_s"))
        per_min = join_dim(per_min, st, scope, "inner")
        mean, std = F.col("_m"), F.col("_s")
    else:
        # Mean and std in one scalar subquery (one pass over the per-minute table).
        st = scalar(per_min.agg(F.struct(F.avg("count").alias("m"), F.stddev_samp("count").alias("s"))))
        mean, std = st.getField("m"), st.getField("s")
    return per_min.where((std > 0) & ((F.col("count") - mean) / std > z)).select(*scope, "minute")


def coordinated_asns_train(ip_dim: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """A7 from the per-IP table (``asn``, ``request_count_per_ip``): ASN with more than
    100 rows, more than 5 IPs and a coefficient of variation of per-IP counts < 0.5."""
    scope = scope or []
    g = ip_dim.groupBy(*scope, "asn").agg(
        F.sum("request_count_per_ip").alias("asn_rows"),
        F.count("ip").alias("asn_ips"),
        F.stddev_samp("request_count_per_ip").alias("sd"),
        F.avg("request_count_per_ip").alias("mean"),
    )
    cv = F.when(F.col("mean") > 0, F.col("sd") / F.col("mean")).otherwise(F.lit(0.0))
    return g.where((F.col("asn_rows") > 100) & (F.col("asn_ips") > 5) & F.coalesce(cv < 0.5, F.lit(False))) \
            .select(*scope, "asn")


def high_error_paths(df: DataFrame, min_status: int, min_count: int = 5) -> DataFrame:
    """A8 (min_status 500) / A14 (min_status 400): paths with more than ``min_count``
    requests of status >= ``min_status``."""
    return (df.where(F.col("status_code") >= min_status).groupBy("path").count()
              .where(F.col("count") > min_count).select("path"))


# ---------------------------------------------------------------------------
# Serving profile (S)
# ---------------------------------------------------------------------------

def ip_minute_counts(df: DataFrame, ts: str = "timestamp", scope: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(scope or []), "ip", minute_of(ts).alias("minute_bucket")).count()


def ip_rate_serve(df: DataFrame, ts: str = "timestamp", scope: list[str] | None = None) -> DataFrame:
    """Per IP, the mean request count over its active minutes; also the IP's
    row count (weights for row-level statistics)."""
    m = ip_minute_counts(df, ts, scope)
    return m.groupBy(*(scope or []), "ip").agg(
        F.avg(F.when(F.col("minute_bucket").isNotNull(), F.col("count"))).alias("requests_per_minute"),
        F.sum("count").alias("ip_rows"),
    )


def _weighted_threshold(ip_rate: DataFrame, k: float, scope: list[str]) -> DataFrame:
    """mean + k * std_samp of ``requests_per_minute`` over rows, per scope (column ``_thr``)."""
    r = ip_rate.where(F.col("requests_per_minute").isNotNull())
    w = F.col("ip_rows").cast("double")
    x = F.col("requests_per_minute")
    m = r.groupBy(*scope).agg(F.sum(w).alias("n"), F.sum(w * x).alias("sx"), F.sum(w * x * x).alias("sxx"))
    n, sx, sxx = F.col("n"), F.col("sx"), F.col("sxx")
    mean = sx / n
    # Clamp the rounding residue of a zero variance at 0.
    var = F.when(n > 1, F.greatest((sxx - sx * sx / n) / (n - 1), F.lit(0.0)))
    return m.select(*scope, (mean + F.lit(k) * F.sqrt(var)).alias("_thr"))


def spike_threshold_serve(ip_rate: DataFrame, k: float = 2.0) -> Column:
    """A10 threshold: mean + k * std_samp of ``requests_per_minute`` over *rows*.

    Computed from the per-IP table with row-count weights in one aggregate
    (sums of w, w*x and w*x^2; map-side partial), as a scalar subquery.
    """
    return scalar(_weighted_threshold(ip_rate, k, []).select("_thr"))


def with_spike_flag_serve(ip_rate: DataFrame, k: float = 2.0, scope: list[str] | None = None) -> DataFrame:
    """A10 on the per-IP table: ``during_traffic_spike`` = rate above the threshold
    of its scope (the whole input without a scope)."""
    rpm = F.col("requests_per_minute")
    if not scope:
        return ip_rate.withColumn("during_traffic_spike",
                                  F.coalesce(rpm > spike_threshold_serve(ip_rate, k), F.lit(False)))
    d = join_dim(ip_rate, _weighted_threshold(ip_rate, k, scope), scope, "left")
    return d.withColumn("during_traffic_spike", F.coalesce(rpm > F.col("_thr"), F.lit(False))).drop("_thr")


def coordinated_asns_serve(ip_dim: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """ASNs whose row-weighted mean rate exceeds mean + std_samp of all ASN means
    (of the same scope)."""
    scope = scope or []
    a = ip_dim.where(F.col("requests_per_minute").isNotNull()).groupBy(*scope, "asn").agg(
        (F.sum(F.col("ip_rows") * F.col("requests_per_minute")) / F.sum("ip_rows")).alias("asn_rpm"))
    if scope:
        t = a.groupBy(*scope).agg((F.avg("asn_rpm") + F.stddev_samp("asn_rpm")).alias("_thr"))
        a = join_dim(a, t, scope, "inner")
        thr = F.col("_thr")
    else:
        thr = scalar(a.agg(F.avg("asn_rpm") + F.stddev_samp("asn_rpm")))
    return a.where(F.coalesce(F.col("asn_rpm") > thr, F.lit(False))).select(*scope, "asn")


def potential_dos_serve() -> Column:
    """A12, per row: rate > 30 and time_diff < 1 s (nulls -> false)."""
    return F.coalesce((F.col("requests_per_minute") > 30) & (F.col("time_diff") < 1), F.lit(False))


def potential_scanner_serve() -> Column:
    """A13, per row: rate > 10 and a 4xx status."""
    return F.coalesce((F.col("requests_per_minute") > 10) & (F.col("status_code") >= 400)
                      & (F.col("status_code") < 500), F.lit(False))
