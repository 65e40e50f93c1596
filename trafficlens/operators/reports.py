"""Report tables (R1-R4): the summary report and chart series as DataFrames.

The reference renders markdown/HTML/PNG; here every report is a tidy table a
user can write, plot or query: R1 ``(section, rank, key, count, pct)``, R2/R3
``(chart, hour, series, value)``, R4 = A22.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import features as X
from ..functions.fixed import (CLASSES, ILLEGITIMATE_CLASSES, NO_USER_AGENT_SHARE, OLD_BROWSER_SHARE,
                               UNKNOWN_CLASS)
from . import summary as SM

R1_COLUMNS = ["section", "rank", "key", "count", "pct"]


def _section(df: DataFrame, section: str, key, count, pct=None, rank=None) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        (rank if rank is not None else F.lit(0)).cast("int").alias("rank"),
        key.cast("string").alias("key"),
        count.cast("bigint").alias("count"),
        (pct if pct is not None else F.lit(None)).cast("double").alias("pct"),
    )


def _scalar_sections(classified: DataFrame) -> DataFrame:
    """Overview (A20), class breakdown (A19) and attack totals (A21) from ONE aggregate
    over the classified rows, emitted as report rows by a single ``inline``."""
    cls = F.col("classification")
    attack_row = cls.isin(ILLEGITIMATE_CLASSES) & F.coalesce(F.col("has_malicious_pattern"), F.lit(False))
    attack_flags = [
        ("sql_injection", F.col("sql_injection_matches")), ("xss", F.col("xss_matches")),
        ("command_injection", F.col("cmd_injection_matches")), ("file_inclusion", F.col("file_inclusion_matches")),
        ("path_traversal", X.path_traversal()), ("wordpress", F.col("wordpress_matches")),
        ("shell_upload", F.col("shell_upload_matches")),
    ]
    names = CLASSES + [UNKNOWN_CLASS]
    one = classified.agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
        *[F.count_if(cls == c).alias(f"c_{c}") for c in names],
        F.count_if(attack_row).alias("a_potential_attacks"),
        *[F.count_if(attack_row & flag).alias(f"a_{k}") for k, flag in attack_flags],
    )
    n = F.col("n")

    def row(section, rank, key, count, pct=None):
        return F.struct(F.lit(section).alias("section"), F.lit(rank).cast("int").alias("rank"),
                        key.cast("string").alias("key"), count.cast("bigint").alias("count"),
                        (pct if pct is not None else F.lit(None)).cast("double").alias("pct"))

    rows = [row("overview", 0, F.lit("total_requests"), n),
            row("overview", 1, F.concat(F.lit("start_time="), F.col("t0").cast("string")), F.lit(None)),
            row("overview", 2, F.concat(F.lit("end_time="), F.col("t1").cast("string")), F.lit(None))]
    rows += [row("classes", 0, F.lit(c), F.col(f"c_{c}"),
                 F.when(n > 0, F.col(f"c_{c}") * 100.0 / n).otherwise(F.lit(0.0))) for c in names]
    attacks = ["potential_attacks"] + [k for k, _ in attack_flags]
    rows += [row("attacks", 0, F.lit(k), F.col(f"a_{k}")) for k in attacks]
    # File inclusion and path traversal overlap; their sum is reported as well (Q21).
    rows.append(row("attacks", 0, F.lit("file_inclusion_or_traversal"),
                    F.col("a_file_inclusion") + F.col("a_path_traversal")))
    return one.select(F.inline(F.array(*rows)))


def report_columns(classified: DataFrame) -> DataFrame:
    """The columns that :func:`summary_report` reads, to be materialised before it."""
    return classified.select("timestamp", "ip", "asn", "country", "path", "raw_log", "classification", *[
        c for c in classified.columns if c.endswith("_matches") or c in ("has_malicious_pattern", "n")])


def summary_report(classified: DataFrame, top_ips: int = 10, top_asns: int = 5, top_countries: int = 5,
                   top_paths: int = 10) -> DataFrame:
    """Overview, class breakdown, attack totals, four top-k lists and examples.

    Six passes over the (materialised) classified table: one aggregate for all
    scalar sections, one partial-count + top-k per list, one for the examples.
    """
    parts = [_scalar_sections(classified)]
    for section, key, k in (("top_ips", "ip", top_ips), ("top_asns", "asn", top_asns),
                            ("top_countries", "country", top_countries), ("top_paths", "path", top_paths)):
        t = SM.top_k_ranked(classified, key, k)
        parts.append(_section(t, section, F.col(key), F.col("count"), rank=F.col("rank")))
    ex = SM.first_example_per_class(classified)
    parts.append(_section(ex, "examples", F.concat_ws(": ", F.col("classification"), F.col("example")),
                          F.lit(None)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def chart_series(hourly: DataFrame) -> DataFrame:
    """R2: long-format series of the four charts (composition %, volume,
    stacked composition %, confidence) from an hourly table."""
    comp = ["legitimate_human_pct", "legitimate_bot_pct", "illegitimate_human_pct", "illegitimate_bot_pct"]
    specs = [("composition", c, c) for c in comp] + [("volume", "total_requests", "total_requests")] \
        + [("stacked", c, c) for c in comp] + [("confidence", "avg_confidence", "avg_confidence")]
    stack = "stack({}, {}) as (chart, series, value)".format(
        len(specs), ", ".join(f"'{ch}', '{s}', CAST({col} AS DOUBLE)" for ch, s, col in specs))
    return hourly.selectExpr("hour", stack).select("chart", "hour", "series", "value")


def ua_series_approx(hourly: DataFrame) -> DataFrame:
    """R3 as the reference draws it: class percentages standing in for user-agent
    kinds (old browser = 0.7 x illegitimate human, none = 0.3 x illegitimate bot)."""
    stack = ("stack(4, 'modern_browser', legitimate_human_pct, 'known_bot', legitimate_bot_pct, "
             f"'old_browser', illegitimate_human_pct * {OLD_BROWSER_SHARE}D, "
             f"'no_user_agent', illegitimate_bot_pct * {NO_USER_AGENT_SHARE}D) "
             "as (series, value)")
    return hourly.selectExpr("hour", stack).select(F.lit("ua_composition").alias("chart"), "hour", "series",
                                                   F.col("value").cast("double").alias("value"))


def ua_series_true(enriched: DataFrame, ts: str = "timestamp") -> DataFrame:
    """R3, measured: per hour, the share of each user-agent kind (X23) in percent."""
    d = enriched.where(F.col(ts).isNotNull()).withColumn("series", X.ua_category())
    g = d.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour"), "series").count()
    # the hours' totals come from the few counts of an hour, not from the rows again
    total = F.sum("count").over(Window.partitionBy("hour"))
    return g.select(F.lit("ua_composition_measured").alias("chart"), "hour", "series",
                    (F.col("count") * 100.0 / total).alias("value"))


def summary_statistics(hourly: DataFrame) -> DataFrame:
    """R4 = A22."""
    return SM.report_totals(hourly)
