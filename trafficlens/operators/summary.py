"""Roll-ups of classified rows.

All are single ``groupBy``/``agg`` passes with map-side partial aggregation;
class counts are ``count_if`` columns of one aggregate (no pivot, no reindex).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import features as X
from ..functions.fixed import CLASSES, ILLEGITIMATE_CLASSES, UNKNOWN_CLASS
from ..schemas import HOURLY_COUNT_COLUMNS, HOURLY_PCT_COLUMNS


def _cls(name: str) -> Column:
    return F.col("classification") == name


def hourly_counts(classified: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Per hour (rows with a timestamp), totals, class counts and mean confidence."""
    d = classified.where(F.col(ts).isNotNull())
    legit = F.coalesce(F.col("is_legitimate"), F.lit(False))
    human = F.coalesce(F.col("is_human"), F.lit(False))
    return d.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.count("ip").alias("total_requests"),
        F.count_if(legit).alias("legitimate_requests"),
        F.count_if(~legit).alias("illegitimate_requests"),
        F.count_if(human).alias("human_requests"),
        F.count_if(~human).alias("bot_requests"),
        *[F.count_if(_cls(c)).alias(f"{c}_requests") for c in CLASSES],
        F.avg("confidence").alias("avg_confidence"),
    )


def hourly_partials(classified: DataFrame, ts: str = "timestamp") -> DataFrame:
    """A16 counts per hour of a part of the rows, with the sums that other parts add to."""
    d = classified.where(F.col(ts).isNotNull())
    legit, human = F.col("is_legitimate"), F.col("is_human")
    return d.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.count("ip").alias("total_requests"),
        F.count_if(legit).alias("legitimate_requests"),
        F.count_if(~legit).alias("illegitimate_requests"),
        F.count_if(human).alias("human_requests"),
        F.count_if(~human).alias("bot_requests"),
        *[F.count_if(_cls(c)).alias(f"{c}_requests") for c in CLASSES],
        F.sum("confidence").alias("_confidence"), F.count("confidence").alias("_confidences"),
    )


def hourly_totals(partials: DataFrame) -> DataFrame:
    """A16 from the partial counts of all parts."""
    sums = [c for c in partials.columns if c not in ("hour", "_batch", "day")]
    g = partials.groupBy("hour").agg(*[F.sum(c).alias(c) for c in sums])
    return g.withColumn("avg_confidence", F.col("_confidence") / F.col("_confidences")).drop("_confidence", "_confidences")


def pct(num: str, den: str = "total_requests") -> Column:
    return F.col(num) * 100.0 / F.col(den)


def hourly_summary(classified: DataFrame, ts: str = "timestamp", digits: int = 2) -> DataFrame:
    """A16 + A17: the hourly table with eight percentages rounded to ``digits``."""
    h = hourly_counts(classified, ts)
    pcts = {p: F.round(pct(p.replace("_pct", "_requests")), digits) for p in HOURLY_PCT_COLUMNS}
    return h.withColumns(pcts).select("hour", *HOURLY_COUNT_COLUMNS, "avg_confidence", *HOURLY_PCT_COLUMNS)


def hourly_summary_alt(classified: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Second hourly form: unrounded percentages, bot and illegitimate as 100 minus
    the complement, illegitimate and bot counts derived from the totals."""
    d = classified.where(F.col(ts).isNotNull())
    h = d.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.count("classification").alias("total_requests"),
        F.count_if(F.coalesce(F.col("is_legitimate"), F.lit(False))).alias("legitimate_requests"),
        F.count_if(F.coalesce(F.col("is_human"), F.lit(False))).alias("human_requests"),
    )
    return (h.withColumn("legitimate_pct", pct("legitimate_requests"))
             .withColumn("human_pct", pct("human_requests"))
             .withColumn("bot_pct", 100.0 - F.col("human_pct"))
             .withColumn("illegitimate_pct", 100.0 - F.col("legitimate_pct"))
             .withColumn("illegitimate_requests", F.col("total_requests") - F.col("legitimate_requests"))
             .withColumn("bot_requests", F.col("total_requests") - F.col("human_requests")))


def class_breakdown(classified: DataFrame) -> DataFrame:
    """Count and percentage of all rows for the four classes and 'unknown';
    0 for an absent class, percentages 0 for an empty input."""
    names = CLASSES + [UNKNOWN_CLASS]
    agg = classified.agg(F.count(F.lit(1)).alias("_n"),
                         *[F.count_if(_cls(c)).alias(f"_c{i}") for i, c in enumerate(names)])
    stack = "stack({}, {}) as (classification, count)".format(
        len(names), ", ".join(f"'{c}', _c{i}" for i, c in enumerate(names)))
    return agg.selectExpr("_n", stack).select(
        "classification", "count",
        F.when(F.col("_n") > 0, F.col("count") * 100.0 / F.col("_n")).otherwise(F.lit(0.0)).alias("pct"))


def time_range(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """A20."""
    return df.agg(F.min(ts).alias("start_time"), F.max(ts).alias("end_time"))


def illegitimate(df: DataFrame) -> DataFrame:
    """P11 mask: rows classified as one of the illegitimate classes."""
    return df.where(F.col("classification").isin(ILLEGITIMATE_CLASSES))


def attack_totals(classified: DataFrame) -> DataFrame:
    """A21 over illegitimate rows with a malicious pattern.  File inclusion and path
    traversal overlap; both terms and their sum are reported (Q21)."""
    a = illegitimate(classified).where(F.col("has_malicious_pattern"))
    trav = X.path_traversal()
    r = a.agg(
        F.count(F.lit(1)).alias("potential_attacks"),
        F.count_if("sql_injection_matches").alias("sql_injection"),
        F.count_if("xss_matches").alias("xss"),
        F.count_if("cmd_injection_matches").alias("command_injection"),
        F.count_if("file_inclusion_matches").alias("file_inclusion"),
        F.count_if(trav).alias("path_traversal"),
        F.count_if("wordpress_matches").alias("wordpress"),
        F.count_if("shell_upload_matches").alias("shell_upload"),
    )
    return r.withColumn("file_inclusion_or_traversal", F.col("file_inclusion") + F.col("path_traversal"))


def top_k(df: DataFrame, key: str, k: int) -> DataFrame:
    """S3: the ``k`` most frequent values of ``key`` among illegitimate rows, ties by key.

    Partial counts per key are aggregated map-side; ``orderBy+limit`` is a
    top-k (TakeOrderedAndProject), so no global sort of all keys.
    """
    return (illegitimate(df).groupBy(key).count()
            .orderBy(F.desc("count"), F.asc(key)).limit(k))


def top_k_ranked(df: DataFrame, key: str, k: int) -> DataFrame:
    t = top_k(df, key, k)
    w = Window.orderBy(F.desc("count"), F.asc(key))
    return t.withColumn("rank", F.row_number().over(w))


def first_example_per_class(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Per class, the raw line of its first row in (ip, timestamp, raw_log) order."""
    order = order or ["ip", "timestamp", "raw_log"]
    return df.groupBy("classification").agg(
        F.min_by("raw_log", F.struct(*[F.col(c) for c in order])).alias("example"))


def report_totals(hourly: DataFrame) -> DataFrame:
    """A22 over an hourly table: sums, sum ratios in percent, unweighted mean of hourly confidence."""
    s = hourly.agg(
        F.sum("total_requests").alias("total_requests"),
        F.sum("legitimate_requests").alias("legitimate_requests"),
        F.sum("illegitimate_requests").alias("illegitimate_requests"),
        F.sum("human_requests").alias("human_requests"),
        F.sum("bot_requests").alias("bot_requests"),
        F.avg("avg_confidence").alias("avg_model_confidence"),
    )
    return s.withColumns({
        f"{k}_pct": F.col(f"{k}_requests") * 100.0 / F.col("total_requests")
        for k in ("legitimate", "illegitimate", "human", "bot")})


def distinct_ips(df: DataFrame) -> DataFrame:
    """A23."""
    return df.select("ip").distinct()
