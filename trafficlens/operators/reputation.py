"""IP and ASN reputation.

The blocklist is a reference list (one line per bad IP); it is joined to the
per-IP table, never to the request rows, so the join is #distinct IPs wide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.reputation_lists import blocklist_by_ip
from .dims import join_dim


def asn_reputation(bl: DataFrame) -> DataFrame:
    """Per ASN, blocklist line count, score = min(100, count / max count * 100),
    country and organisation of the ASN's first line."""
    g = bl.groupBy("asn").agg(
        F.count(F.lit(1)).alias("count"),
        F.min_by(F.struct("country", "organization"), "line_no").alias("_f"),
    )
    mx = g.agg(F.max("count")).scalar()
    score = F.least(F.lit(100.0), F.col("count") / mx * 100.0)
    return g.select("asn", "count", "_f.country", "_f.organization", score.alias("reputation_score"))


def reputation_table(bl: DataFrame, profile: str) -> DataFrame:
    """The blocklist side of J1: one row per listed IP with its country, ASN,
    organisation and ASN score (``train``: 100; ``serve``: the A15 score)."""
    by_ip = blocklist_by_ip(bl)
    if profile == "serve":
        asn = asn_reputation(bl).select("asn", F.col("reputation_score").alias("_asn_score"))
        by_ip = by_ip.join(asn, "asn", "left")
    else:
        by_ip = by_ip.withColumn("_asn_score", F.lit(100.0))
    return by_ip.withColumn("_hit", F.lit(True))


def add_reputation(ip_dim: DataFrame, bl: DataFrame, profile: str,
                   max_broadcast_rows: int = 2_000_000, table: DataFrame | None = None,
                   small: bool | None = None) -> DataFrame:
    """J1 on a per-IP table.

    ``train``: a listed IP gets ip score 100 and ASN score 100.
    ``serve``: a listed IP gets ip score 100 and its ASN's A15 score.
    Unlisted: country/asn/organization 'Unknown', scores 0, ``ip_is_known_bad`` false.
    ``table``/``small``: the :func:`reputation_table` of ``bl`` and its measure,
    when the caller already has them.
    """
    by_ip = table if table is not None else reputation_table(bl, profile)
    d = join_dim(ip_dim, by_ip, "ip", "left", max_broadcast_rows=max_broadcast_rows, small=small)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return (d.withColumn("ip_reputation_score", F.when(hit, 100.0).otherwise(0.0))
             .withColumn("ip_is_known_bad", hit)
             .withColumn("country", F.coalesce("country", F.lit("Unknown")))
             .withColumn("asn", F.coalesce("asn", F.lit("Unknown")))
             .withColumn("organization", F.coalesce("organization", F.lit("Unknown")))
             .withColumn("asn_reputation_score", F.when(hit, F.coalesce("_asn_score", F.lit(0.0)))
                         .otherwise(0.0))
             .drop("_hit", "_asn_score"))
