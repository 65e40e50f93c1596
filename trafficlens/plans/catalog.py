"""Registered queries: one per operator group of the inventory, over the driver's tables.

Every query derives the access log from ``events`` (``sources.fixtures``),
renders it as raw combined-format lines and parses them with the library, so
each query exercises scan -> parse -> operator and its work grows with the
tables.  Doubles are rounded to 6 decimals in the outputs so that the DuckDB
oracle (``plans.oracle``) can compare values.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as X
from ..functions import fixed
from ..functions import labels as L
from ..operators import parse as PO
from ..operators import reports as RP
from ..operators import summary as SM
from ..operators import traffic as TR
from ..operators.dims import join_dim, materialize
from ..operators.reputation import add_reputation, asn_reputation
from ..operators.sampling import sample_exact, train_validation_split
from ..schemas import PARSED_COLUMNS
from ..sources import fixtures as fx
from ..sources.reputation_lists import blocklist_from_lines
from . import enrich as EN
from . import label as LB
from . import model as MD

TIE = ["n"]


def r6(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6)


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------

def lines(spark: SparkSession, sf: str) -> DataFrame:
    return fx.access_log_lines(spark, sf)


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return PO.parse_access_log(lines(spark, sf))


def blocklist(spark: SparkSession) -> DataFrame:
    return blocklist_from_lines(fx.blocklist_lines(spark))


def with_class_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({"is_legitimate": L.is_legitimate(), "is_human": L.is_human()})


def classified(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed rows with the fixture's labels and M5 flags."""
    return with_class_flags(parsed(spark, sf))


def parsed_stage(spark: SparkSession, sf: str) -> DataFrame:
    """The parsed table written once to the shared checkpoint folder (a stage
    table), so the several scans of an enrichment do not re-parse the text."""
    return materialize(parsed(spark, sf))


def enriched_train(spark: SparkSession, sf: str) -> DataFrame:
    return EN.enrich_train(parsed_stage(spark, sf), blocklist(spark), tiebreak=TIE)


def enriched_serve(spark: SparkSession, sf: str) -> DataFrame:
    return EN.enrich_serve(parsed_stage(spark, sf), blocklist(spark), tiebreak=TIE)


def classified_serve(spark: SparkSession, sf: str) -> DataFrame:
    return with_class_flags(enriched_serve(spark, sf))


def with_reputation(spark: SparkSession, df: DataFrame, profile: str) -> DataFrame:
    ips = add_reputation(SM.distinct_ips(df), blocklist(spark), profile)
    return join_dim(df, ips, "ip")


def odd_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The fixture lines, of which each five hold one with an IPv6-mapped client (not
    parseable: IPv4 only), one with a status beyond the integer range and one with a NUL character."""
    v, k = F.col("value"), F.pmod(F.col("n"), F.lit(5))
    return lines(spark, sf).withColumn("value", F.when(k == 0, F.concat(F.lit("::ffff:"), v))
                                       .when(k == 1, F.regexp_replace(v, r'" [0-9]+ ', '" 99999999999 '))
                                       .when(k == 2, F.concat(F.substr(v, F.lit(1), F.length(v) - 1), F.char(F.lit(0)), F.lit('x"')))
                                       .otherwise(v))


# ---------------------------------------------------------------------------
# parse, filter, union (P*, U1)
# ---------------------------------------------------------------------------

def p1_parse(spark, sf):
    return parsed(spark, sf).select("n", *PARSED_COLUMNS)


def p1_odd_lines(spark, sf):
    """Lines that match but hold odd values: a status beyond the integer range, a NUL character."""
    p = PO.parse_access_log(odd_lines(spark, sf))
    return p.select("n", "status_code", F.length("user_agent").cast("bigint").alias("ua_chars"))


def p7_rejects(spark, sf):
    return PO.parse_rejects(odd_lines(spark, sf)).select("n", "stripped_line")


def p8_redirect_filter(spark, sf):
    kept = PO.drop_redirects(PO.parse_access_log(lines(spark, sf), drop_redirects=False))
    return kept.groupBy("status_code").count()


def p9_counters(spark, sf):
    return PO.parse_counters(odd_lines(spark, sf))


def p10_whitelist(spark, sf):
    return PO.filter_status(parsed(spark, sf), whitelist="50[0-9]").select("n", "status_code")


def p10_blacklist(spark, sf):
    return PO.filter_status(parsed(spark, sf), blacklist="4").select("n", "status_code")


def u1_union(spark, sf):
    all_rows = PO.parse_access_log(lines(spark, sf), drop_redirects=False)
    kept = PO.drop_redirects(all_rows)
    skipped = all_rows.where(F.col("status_code").isin(fixed.REDIRECT_STATUS_CODES))
    return kept.unionByName(skipped).select("n", "status_code")


# ---------------------------------------------------------------------------
# per-IP statistics and detectors
# ---------------------------------------------------------------------------

def w1_time_diff(spark, sf):
    d = TR.add_time_diff(parsed(spark, sf), tiebreak=TIE)
    return d.select("n", "prev_timestamp", r6("time_diff").alias("time_diff"))


def a1_ip_counts(spark, sf):
    return TR.ip_counts(parsed(spark, sf))


def a2_rate_train(spark, sf):
    s = TR.ip_stats_train(parsed(spark, sf))
    return s.select("ip", "request_count_per_ip", r6("requests_per_minute").alias("requests_per_minute"))


def a3_ip_stats(spark, sf):
    s = TR.ip_stats_full(TR.add_time_diff(parsed(spark, sf), tiebreak=TIE))
    dbl = ["avg_time_between_requests", "min_time_between_requests", "std_time_between_requests",
           "error_rate", "server_error_rate", "duration_minutes", "requests_per_minute"]
    return s.withColumns({c: r6(c) for c in dbl})


def a4_dos_train(spark, sf):
    return TR.ip_stats_train(parsed(spark, sf)).where("potential_dos").select("ip")


def a5_scanner_train(spark, sf):
    return TR.ip_stats_train(parsed(spark, sf)).where("potential_scanner").select("ip")


def a6_spike_train(spark, sf):
    return TR.spike_minutes_train(parsed(spark, sf))


def a7_asn_train(spark, sf):
    ip = add_reputation(TR.ip_stats_train(parsed(spark, sf)), blocklist(spark), "train")
    return TR.coordinated_asns_train(ip)


def a8_error_path_train(spark, sf):
    return TR.high_error_paths(parsed(spark, sf), 500)


def a9_rate_serve(spark, sf):
    return TR.ip_rate_serve(parsed(spark, sf)).select("ip", r6("requests_per_minute").alias("requests_per_minute"))


def a10_spike_serve(spark, sf):
    ip = TR.ip_rate_serve(parsed(spark, sf))
    thr = TR.spike_threshold_serve(ip)
    return ip.select("ip", F.coalesce(F.col("requests_per_minute") > thr, F.lit(False)).alias("during_traffic_spike"))


def _by_day(spark, sf) -> DataFrame:
    """Parsed rows with a non-null ``day`` scope column (Q1: statistics per day)."""
    day = F.coalesce(F.to_date("timestamp"), F.lit("1970-01-01").cast("date"))
    return parsed(spark, sf).withColumn("day", day)


def q1_scope_time_diff(spark, sf):
    d = TR.add_time_diff(_by_day(spark, sf), key=["day", "ip"], tiebreak=TIE, with_prev=False)
    return d.select("n", "day", r6("time_diff").alias("time_diff"))


def q1_scope_spike_train(spark, sf):
    return TR.spike_minutes_train(_by_day(spark, sf), scope=["day"])


def q1_scope_spike_serve(spark, sf):
    ip = TR.with_spike_flag_serve(TR.ip_rate_serve(_by_day(spark, sf), scope=["day"]), scope=["day"])
    return ip.select("day", "ip", "during_traffic_spike")


def a11_asn_serve(spark, sf):
    ip = add_reputation(TR.ip_rate_serve(parsed(spark, sf)), blocklist(spark), "serve")
    return TR.coordinated_asns_serve(ip)


def _serve_rate_rows(spark, sf) -> DataFrame:
    p = parsed(spark, sf)
    d = TR.add_time_diff(p, tiebreak=TIE, with_prev=False)
    return join_dim(d, TR.ip_rate_serve(p).drop("ip_rows"), "ip")


def a12_dos_serve(spark, sf):
    return _serve_rate_rows(spark, sf).select("n", TR.potential_dos_serve().alias("potential_dos"))


def a13_scanner_serve(spark, sf):
    return _serve_rate_rows(spark, sf).select("n", TR.potential_scanner_serve().alias("potential_scanner"))


def a14_error_path_serve(spark, sf):
    return TR.high_error_paths(parsed(spark, sf), 400)


def a15_asn_reputation(spark, sf):
    # The blocklist is a reference list; the query also scans the request log
    # to report the request volume of each listed ASN's clients.
    a = asn_reputation(blocklist(spark))
    req = with_reputation(spark, parsed(spark, sf), "serve").groupBy("asn").agg(
        F.count(F.lit(1)).alias("requests"))
    return a.join(req, "asn", "left").select(
        "asn", "count", "country", "organization", r6("reputation_score").alias("reputation_score"),
        F.coalesce("requests", F.lit(0)).alias("requests"))


# ---------------------------------------------------------------------------
# reputation and row-local features (J1, X*)
# ---------------------------------------------------------------------------

def _rep(spark, sf, profile):
    r = add_reputation(SM.distinct_ips(parsed(spark, sf)), blocklist(spark), profile)
    return r.select("ip", "country", "asn", "organization", r6("ip_reputation_score").alias("ip_reputation_score"),
                    "ip_is_known_bad", r6("asn_reputation_score").alias("asn_reputation_score"))


def j1_reputation_train(spark, sf):
    return _rep(spark, sf, "train")


def j1_reputation_serve(spark, sf):
    return _rep(spark, sf, "serve")


def x1_x3_basic(spark, sf):
    e = enriched_train(spark, sf)
    return e.select("n", "is_error", "is_server_error", "path_length", "has_query_params")


UA_T = ["has_suspicious_patterns", "has_user_agent", "is_known_bot", "is_common_browser", "is_old_browser",
        "is_suspicious_user_agent", "is_malicious_user_agent"]
UA_S = ["has_suspicious_patterns", "has_user_agent", "is_old_browser", "is_known_bot",
        "is_suspicious_user_agent", "is_malicious_user_agent"]
PATTERN_FLAGS = X.MATCH_FLAGS + ["has_malicious_pattern"]


def x4_x10_ua_train(spark, sf):
    return enriched_train(spark, sf).select("n", *UA_T)


def x4_x10_ua_serve(spark, sf):
    return enriched_serve(spark, sf).select("n", *UA_S)


def x11_x13_patterns_train(spark, sf):
    return enriched_train(spark, sf).select("n", *PATTERN_FLAGS)


def x11_x13_patterns_serve(spark, sf):
    return enriched_serve(spark, sf).select("n", *PATTERN_FLAGS)


def x14_likely_train(spark, sf):
    return enriched_train(spark, sf).select("n", "likely_malicious_human")


def x14_likely_serve(spark, sf):
    return enriched_serve(spark, sf).select("n", "likely_malicious_human")


def _risk(e: DataFrame, cols: list[str]) -> DataFrame:
    return e.select("ip", *cols, r6("combined_reputation_score").alias("combined_reputation_score")).distinct()


def x16_x18_risk(spark, sf):
    return _risk(enriched_train(spark, sf), ["is_hostroyale_asn", "is_high_risk_country", "is_high_risk_asn"])


def x16_x18_risk_serve(spark, sf):
    return _risk(enriched_serve(spark, sf), ["is_high_risk_country", "is_high_risk_asn"])


def x8_old_browser_presets(spark, sf):
    """Q9: X8 under both presets and both profiles."""
    flags = {f"old_{prof}_{preset}": (X.ua_flags_T([], old_browser=preset) if prof == "train"
                                      else X.ua_flags_S([], old_browser=preset))["is_old_browser"]
             for prof in ("train", "serve") for preset in ("reference", "corrected")}
    return parsed(spark, sf).select("n", *[v.alias(k) for k, v in flags.items()])


def x20_calendar(spark, sf):
    return parsed(spark, sf).select("n", *[v.alias(k) for k, v in X.calendar_columns().items()])


def x21_path_split(spark, sf):
    return parsed(spark, sf).select("n", X.base_path().alias("base_path"), X.query_string().alias("query_string"))


def x22_traversal(spark, sf):
    return parsed(spark, sf).select("n", X.path_traversal().alias("path_traversal"))


def x23_ua_category(spark, sf):
    return enriched_train(spark, sf).select("n", X.ua_category().alias("ua_category"))


# ---------------------------------------------------------------------------
# classes, hourly roll-ups, reports
# ---------------------------------------------------------------------------

def m5_flags(spark, sf):
    return classified(spark, sf).select("n", "classification", "is_legitimate", "is_human")


def q2_compat_flags(spark, sf):
    return parsed(spark, sf).select("n", L.is_legitimate(compat=True).alias("is_legitimate"))


def a16_hourly(spark, sf):
    h = SM.hourly_counts(classified(spark, sf))
    return h.withColumn("avg_confidence", r6("avg_confidence"))


def a17_hourly_pct(spark, sf):
    h = SM.hourly_summary(classified(spark, sf))
    from ..schemas import HOURLY_PCT_COLUMNS
    return h.select("hour", *HOURLY_PCT_COLUMNS)


def a18_hourly_alt(spark, sf):
    h = SM.hourly_summary_alt(classified(spark, sf))
    return h.withColumns({c: r6(c) for c in ("legitimate_pct", "human_pct", "bot_pct", "illegitimate_pct")})


def a19_class_breakdown(spark, sf):
    return SM.class_breakdown(classified(spark, sf)).withColumn("pct", r6("pct"))


def a20_time_range(spark, sf):
    return SM.time_range(parsed(spark, sf))


def a21_attacks(spark, sf):
    return SM.attack_totals(classified_serve(spark, sf))


def a22_report_totals(spark, sf):
    t = SM.report_totals(SM.hourly_summary(classified(spark, sf)))
    return t.withColumns({c: r6(c) for c in t.columns if c.endswith("_pct") or c == "avg_model_confidence"})


def a23_distinct_ips(spark, sf):
    return SM.distinct_ips(parsed(spark, sf))


def _top(spark, sf, key, k, profile=None):
    d = classified(spark, sf)
    if profile:
        d = with_reputation(spark, d, profile)
    return SM.top_k(d, key, k)


def s3_top_ips(spark, sf):
    return _top(spark, sf, "ip", 10)


def s3_top_asns(spark, sf):
    return _top(spark, sf, "asn", 5, "serve")


def s3_top_countries(spark, sf):
    return _top(spark, sf, "country", 5, "serve")


def s3_top_paths(spark, sf):
    return _top(spark, sf, "path", 10)


def s4_examples(spark, sf):
    return SM.first_example_per_class(classified(spark, sf))


def r1_summary(spark, sf):
    return RP.summary_report(materialize(RP.report_columns(classified_serve(spark, sf)))).withColumn("pct", r6("pct"))


def r2_chart_series(spark, sf):
    s = RP.chart_series(SM.hourly_summary(classified(spark, sf)))
    return s.withColumn("value", r6("value"))


def r3_ua_series(spark, sf):
    s = RP.ua_series_approx(SM.hourly_summary(classified(spark, sf)))
    return s.withColumn("value", r6("value"))


def r3_ua_series_measured(spark, sf):
    return RP.ua_series_true(enriched_train(spark, sf)).withColumn("value", r6("value"))


def m6_training_text(spark, sf):
    e = enriched_train(spark, sf).withColumn("reasoning", F.lit(""))
    return LB.training_examples(e)


# ---------------------------------------------------------------------------
# rows-only (no SQL oracle): sampling, labelling, ML, answer parsing
# ---------------------------------------------------------------------------

def s5_sample(spark, sf):
    return sample_exact(parsed_stage(spark, sf), 1000, seed=42, key_cols=["raw_log", "n"], order_cols=["n"]) \
        .select("n", "ip", "timestamp", "path", "status_code")


def s7_split(spark, sf):
    tr, va = train_validation_split(parsed(spark, sf), ["raw_log", "n"], 0.1)
    return tr.select("n", F.lit("train").alias("split")).unionByName(
        va.select("n", F.lit("validation").alias("split")))


def m1_prompts(spark, sf):
    return LB.labelling_prompts(enriched_train(spark, sf)).select("n", "prompt")


def m2_label(spark, sf):
    stage = parsed_stage(spark, sf)
    keys = sample_exact(stage, 1000, key_cols=["raw_log", "n"]).select("n")
    out = LB.label(EN.enrich_train(stage, blocklist(spark), tiebreak=TIE, only=keys), max_samples=0)
    return out.select("n", "classification", "confidence", "reasoning")


def m3_answer_parse(spark, sf):
    """Label answers in the shapes a remote labeller returns, built from the rows'
    fixture labels, parsed back: fenced JSON, bare JSON, loose fields, prose, JSON
    without a class, a broken fence before a whole object, nested braces, two objects."""
    p = parsed(spark, sf)
    reason = F.concat(F.lit("path "), F.col("path"))
    js = F.to_json(F.struct("classification", "confidence", reason.alias("reasoning")))
    bare = F.to_json(F.struct("confidence", reason.alias("reasoning")))
    deep = F.to_json(F.struct("classification", "confidence", F.lit("a {b} c").alias("reasoning"),
                              F.struct(F.lit(1).alias("k")).alias("extra")))
    shape = F.pmod(F.col("n"), F.lit(8))
    text = (F.when(shape == 0, F.concat(F.lit("Here you go:\n```json\n"), js, F.lit("\n```")))
             .when(shape == 1, F.concat(F.lit("Result: "), js))
             .when(shape == 2, F.concat(F.lit('"classification": "'), F.col("classification"),
                                        F.lit('", "confidence": '), F.col("confidence").cast("string")))
             .when(shape == 4, F.concat(F.lit("Result: "), bare))
             .when(shape == 5, F.concat(F.lit('```json\n{"classification": oops}\n```\n'), js))
             .when(shape == 6, F.concat(F.lit("Result: "), deep))
             .when(shape == 7, F.concat(js, F.lit(" or "), js))
             .otherwise(F.lit("I cannot decide.")))
    r = L.parse_label_answer(text)
    return p.select("n", r["classification"].alias("classification"), r["confidence"].alias("confidence"),
                    r["reasoning"].alias("reasoning"))


def m7_prompt(spark, sf):
    """The full serving prompt over rows that have the gap (W1) but no other feature: defaults for the rest."""
    d = TR.add_time_diff(parsed(spark, sf), tiebreak=TIE)
    return d.select("n", L.serving_prompt(d.columns).alias("prompt"))


def m4_answer_parse(spark, sf):
    p = parsed(spark, sf)
    text = F.concat(F.lit("Classification: "), F.col("classification"), F.lit("\nConfidence: "),
                    F.col("confidence").cast("string"), F.lit("\nReasoning: request to "), F.col("path"),
                    F.lit("\n\ntrailing text"))
    r = L.parse_generated_answer(text)
    # Fields by name: a "r.*" star would resolve against the fixture SQL's alias "r".
    fields = ["classification", "confidence", "reasoning", "is_legitimate", "is_human"]
    return p.select("n", *[r.getField(f).alias(f) for f in fields])


def _fit(enriched: DataFrame):
    """Model and metrics; ``train`` reads its rows once, so they need not be a stage table."""
    labeled = enriched.where(F.col("classification").isin(fixed.CLASSES))
    return MD.train(labeled, 0.1, key_cols=["raw_log", "n"])


def _train(spark, sf):
    e = materialize(enriched_train(spark, sf))
    return _fit(e), e


def m8_train_eval(spark, sf):
    model, metrics = _fit(enriched_train(spark, sf))
    return metrics


def m8_invariants(spark, sf):
    """What holds for the metrics of any trained model."""
    return m8_train_eval(spark, sf).select(
        (F.col("train_rows") + F.col("validation_rows") + F.col("skipped_rows")).alias("rows_used"),
        (F.col("eval_loss") >= 0).alias("finite_loss"), F.col("accuracy").between(0.0, 1.0).alias("accuracy_in_range"))


def m9_invariants(spark, sf):
    """What holds for the classified rows of any trained model."""
    known = F.col("classification").isin(fixed.CLASSES)
    flags = (F.col("is_legitimate") == F.col("classification").startswith("legitimate")) & (
        F.col("is_human") == F.col("classification").contains("human"))
    return m9_classify(spark, sf).agg(
        F.count(F.lit(1)).alias("rows"), F.every(known).alias("known_classes"),
        F.every(F.col("confidence").between(0.0, 1.0)).alias("confidence_in_range"), F.every(flags).alias("flags_follow"))


def m9_classify(spark, sf):
    (model, _), e = _train(spark, sf)
    return MD.classify(model, e.drop("classification", "confidence")).select(
        "n", "classification", "confidence", "is_legitimate", "is_human")


# ---------------------------------------------------------------------------
# streaming (ST1-ST3): the same transforms over a file stream, run to completion
# ---------------------------------------------------------------------------

def st1_stream_parse(spark, sf):
    from ..streaming import jobs as ST
    out = ST.run_to_table(spark, ST.event_log_stream(spark, sf), ST.parse_stream)
    return out.select("n", "ip", "timestamp", "path", "status_code", "has_query_params", "is_error")


def st2_stream_hourly(spark, sf):
    from ..streaming import jobs as ST
    out = ST.run_merged(spark, ST.event_log_stream(spark, sf), ST.hourly_partial, ST.hourly_total)
    return out.withColumn("avg_confidence", r6("avg_confidence"))


def st3_stream_rate_alert(spark, sf):
    from ..streaming import jobs as ST
    return ST.run_merged(spark, ST.event_log_stream(spark, sf), ST.rate_partial, ST.rate_alerts)


NAMES = [
    "p1_parse", "p1_odd_lines", "p7_rejects", "p8_redirect_filter", "p9_counters", "p10_whitelist", "p10_blacklist", "u1_union",
    "w1_time_diff", "a1_ip_counts", "a2_rate_train", "a3_ip_stats", "a4_dos_train", "a5_scanner_train",
    "a6_spike_train", "a7_asn_train", "a8_error_path_train", "a9_rate_serve", "a10_spike_serve",
    "a11_asn_serve", "q1_scope_time_diff", "q1_scope_spike_train", "q1_scope_spike_serve", "a12_dos_serve", "a13_scanner_serve", "a14_error_path_serve", "a15_asn_reputation",
    "j1_reputation_train", "j1_reputation_serve", "x1_x3_basic", "x4_x10_ua_train", "x4_x10_ua_serve",
    "x11_x13_patterns_train", "x11_x13_patterns_serve", "x14_likely_train", "x14_likely_serve",
    "x16_x18_risk", "x16_x18_risk_serve", "x8_old_browser_presets", "x20_calendar", "x21_path_split", "x22_traversal",
    "x23_ua_category", "m5_flags", "q2_compat_flags", "a16_hourly", "a17_hourly_pct", "a18_hourly_alt",
    "a19_class_breakdown", "a20_time_range", "a21_attacks", "a22_report_totals", "a23_distinct_ips",
    "s3_top_ips", "s3_top_asns", "s3_top_countries", "s3_top_paths", "s4_examples", "r1_summary",
    "r2_chart_series", "r3_ua_series", "r3_ua_series_measured", "m6_training_text",
    "s5_sample", "s7_split", "m1_prompts", "m2_label", "m3_answer_parse", "m7_prompt", "m4_answer_parse",
    "m8_train_eval", "m9_classify", "m8_invariants", "m9_invariants", "st1_stream_parse", "st2_stream_hourly", "st3_stream_rate_alert",
]

QUERIES = {name: globals()[name] for name in NAMES}
