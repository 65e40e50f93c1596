"""Feature enrichment plans: ``enrich_train`` (profile T) and ``enrich_serve`` (profile S).

Plan shape (both profiles)::

    rows ──┬─ groupBy(ip)          -> per-IP table  + blocklist (J1) + ASN flags
           ├─ groupBy(path)        -> per-path table: error counts + path regex flags
           ├─ groupBy(user_agent)  -> per-UA table:   UA flags + UA regex flags
           ├─ distinct(referer)    -> per-referer table: referer regex flags
           ├─ groupBy(minute)      -> spike minutes (T)
           └─ W1 lag within (ip, minute) ── join per-IP / path / UA / referer / minute tables

Each per-key table is built with map-side partial aggregation (hot keys are
cheap) and evaluated once per distinct key (regexes run once per distinct path,
user agent and referer, not per request).  The independent tables (per-IP,
blocklist, per-path, per-UA, per-referer, spike minutes) are persisted and
measured together in one job; those that fit the byte and row bounds together are
broadcast (:mod:`trafficlens.operators.dims`).  The final per-IP features are as
many as the per-IP table's rows; a coordinated-ASN set is measured on its own
when that table is large.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import features as X
from ..functions import fixed
from ..functions.pattern_index import INDEX_FROM, pattern_hits
from ..operators import traffic as TR
from ..operators.dims import DEFAULT_MAX_BROADCAST_ROWS, flag_join, join_dim, measured, null_safe_join, sizes
from ..operators.reputation import add_reputation, reputation_table
from ..schemas import PARSED_COLUMNS
from ..sources.reputation_lists import ua_patterns
from ..sources.threat_patterns import DEFAULT_LIBRARY, library

T_FEATURES = [
    "prev_timestamp", "time_diff", "request_count_per_ip", "requests_per_minute", "is_error",
    "is_server_error", "path_length", "has_query_params", "has_suspicious_patterns", "has_user_agent",
    "is_known_bot", "is_common_browser", "is_old_browser", "is_suspicious_user_agent",
    "is_malicious_user_agent", "path_matches", "query_matches", "ua_matches", "referrer_matches",
    "sql_injection_matches", "xss_matches", "cmd_injection_matches", "file_inclusion_matches",
    "wordpress_matches", "shell_upload_matches", "malicious_ext_matches", "has_malicious_pattern",
    "likely_malicious_human", "ip_reputation_score", "ip_is_known_bad", "country", "asn", "organization",
    "asn_reputation_score", "is_hostroyale_asn", "is_high_risk_country", "is_high_risk_asn",
    "combined_reputation_score", "potential_dos", "potential_scanner", "minute", "during_traffic_spike",
    "from_coordinated_asn", "to_high_error_path",
]

S_FEATURES = [
    "hour_of_day", "day_of_week", "is_weekend", "is_business_hours", "time_diff", "minute_bucket",
    "requests_per_minute", "during_traffic_spike", "country", "asn", "organization",
    "ip_reputation_score", "asn_reputation_score", "combined_reputation_score", "ip_is_known_bad",
    "is_high_risk_country", "is_high_risk_asn", "from_coordinated_asn", "potential_dos",
    "potential_scanner", "to_high_error_path", "has_suspicious_patterns", "has_user_agent",
    "is_old_browser", "is_known_bot", "is_suspicious_user_agent", "is_malicious_user_agent",
    "has_malicious_pattern", "path_matches", "query_matches", "ua_matches", "referrer_matches",
    "sql_injection_matches", "xss_matches", "cmd_injection_matches", "file_inclusion_matches",
    "wordpress_matches", "shell_upload_matches", "malicious_ext_matches", "likely_malicious_human",
]


def _dim_by(rows: DataFrame, col: str, aggs: list[F.Column], scope: list[str] | None = None) -> DataFrame:
    """groupBy a nullable column (within the scope)."""
    scope = scope or []
    return rows.groupBy(*scope, col).agg(*aggs) if aggs else rows.select(*scope, col).distinct()


def _key_features(rows: DataFrame, keys: DataFrame, small: bool, col: str, exprs: Mapping[str, F.Column],
                  max_rows: int, agg_flags: Mapping[str, F.Column] | None = None,
                  scope: list[str] | None = None) -> DataFrame:
    """Attach to ``rows`` features that depend only on the key column ``col``.

    ``keys`` is the per-key table (``_dim_by``: the distinct keys and their
    aggregates) and ``small`` its measure.  ``exprs`` are expressions over
    ``col`` alone (regex flags etc.); ``agg_flags`` are boolean expressions over
    the per-key aggregates.  A null key joins a null key and nothing else.

    * small: the expressions run once per distinct key and the per-key table is
      broadcast onto the rows;
    * else: the expressions run inline on the rows (no shuffle of the rows),
      and each aggregate flag joins only the set of keys that carry it.
    """
    agg_flags = agg_flags or {}
    on = [*(scope or []), col]
    if small:
        dim = keys.select(*on, *[e.alias(n) for n, e in exprs.items()], *[e.alias(n) for n, e in agg_flags.items()])
        return null_safe_join(rows, dim, on, True)
    d = rows.withColumns(dict(exprs))
    for n, e in agg_flags.items():
        flagged, few = measured(keys.where(e).select(*on, F.lit(True).alias(n)), max_rows)
        d = null_safe_join(d, flagged, on, few).withColumn(n, F.coalesce(F.col(n), F.lit(False)))
    return d


def _passthrough(df: DataFrame, features: list[str]) -> list[str]:
    return [c for c in df.columns if c not in PARSED_COLUMNS and c not in features]


def _false_if_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in cols})


def _ua_entries(given: list[str] | DataFrame | None) -> list[str]:
    if given is None:
        return fixed.FALLBACK_MALICIOUS_USER_AGENTS
    return ua_patterns(given) if isinstance(given, DataFrame) else given


def enrich_train(parsed: DataFrame, blocklist: DataFrame, malicious_user_agents: list[str] | DataFrame | None = None,
                 patterns: Mapping[str, list[str]] | DataFrame | None = None, tiebreak: list[str] | None = None,
                 compat_ua: bool = False, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 scope: list[str] | None = None, old_browser: str = "reference",
                 lag_bucket: str = "minute", only: DataFrame | None = None, indexed: bool | None = None) -> DataFrame:
    """Profile T: parsed rows -> parsed + 44 feature columns (+ pass-through columns).

    ``scope``: optional non-null columns of ``parsed`` (e.g. a day) that bound
    every statistic (Q1); by default statistics cover the whole input.
    ``old_browser``: X8 preset, ``reference`` or ``corrected`` (Q9).
    ``lag_bucket``: time bucket of the W1 window partitions (ip, bucket); the
    result does not depend on it.  A finer bucket ("second") bounds the largest
    window partition when single clients send bursts within one minute.
    ``only``: keys (any columns of ``parsed``) of the rows to return; statistics
    still cover all rows (a sample is drawn first, then enriched).
    ``malicious_user_agents``: entries, or a table from ``read_ua_list`` (IO8).
    ``patterns``: a library, or a table from ``read_patterns`` (IO9).
    ``indexed``: apply it through a literal index; by default from ``INDEX_FROM`` patterns on.
    """
    scope = list(scope or [])
    ua_list = _ua_entries(malicious_user_agents)
    lib = DEFAULT_LIBRARY if patterns is None else library(patterns) if isinstance(patterns, DataFrame) else patterns
    mb = max_broadcast_rows
    rows = parsed
    if indexed is None:
        indexed = sum(map(len, lib.values())) >= INDEX_FROM

    path_aggs = [F.count_if(F.col("status_code") >= 500).alias("_srv")]
    # One job persists and counts the independent per-key tables.
    t, small = sizes({
        "ip": TR.ip_stats_train(rows, scope=scope),      # A1, A2, A4, A5
        "blocklist": reputation_table(blocklist, "train"),
        "path": _dim_by(rows, "path", path_aggs, scope),  # A8 counts
        "user_agent": _dim_by(rows, "user_agent", []),
        "referer": _dim_by(rows, "referer", []),
        "spike_minutes": TR.spike_minutes_train(rows, scope=scope),  # A6
    }, mb, keep=("ip",))

    # Per-IP: reputation (J1), coordinated ASN (A7).  The per-IP aggregate feeds
    # the reputation join, A7 and the final join: computed once (persisted).
    ip = add_reputation(t["ip"], blocklist, "train", mb, table=t["blocklist"], small=small["blocklist"])
    ip = ip.select(*scope, "ip", "request_count_per_ip", "requests_per_minute", "potential_dos",
                   "potential_scanner", "ip_reputation_score", "ip_is_known_bad", "country", "asn", "organization",
                   "asn_reputation_score")
    ip = flag_join(ip, TR.coordinated_asns_train(ip, scope), [*scope, "asn"], "from_coordinated_asn",
                   max_broadcast_rows=mb, small=small["ip"] or None)

    # Per-path: X2-X4, X11-X12 on the path, A8.  Per-user-agent: X5-X10 and ua_matches.
    path_exprs = {
        "path_length": X.path_length(),
        "has_query_params": X.has_query_params(),
        "has_suspicious_patterns": X.suspicious_path_T(),
        **({} if indexed else X.path_pattern_flags_T(lib)),
    }
    path_agg_flags = {"to_high_error_path": F.col("_srv") > 5}
    ua_exprs = {**X.ua_flags_T(ua_list, compat_ua, old_browser), **({} if indexed else X.ua_pattern_flags_T(lib))}

    d = TR.add_time_diff(rows, key=[*scope, "ip"], tiebreak=tiebreak, bucket=lag_bucket)
    if only is not None:
        d = d.join(only, only.columns, "left_semi")
    d = join_dim(d, ip, [*scope, "ip"], "left", small=small["ip"], weight="request_count_per_ip")
    d = _key_features(d, t["path"], small["path"], "path", path_exprs, mb, path_agg_flags, scope)
    d = _key_features(d, t["user_agent"], small["user_agent"], "user_agent", ua_exprs, mb)
    if indexed:
        referer = F.when(F.col("referer") != "-", F.col("referer"))
        for key, texts in (("path", X.path_pattern_texts_T(lib)), ("user_agent", {"ua_matches": (F.col("user_agent"), lib.get("user_agent", []))}),
                           ("referer", {"referrer_matches": (referer, lib.get("referrer", []))})):
            keys = t[key].select(key).where(F.col(key).isNotNull()).distinct()
            d = join_dim(d, pattern_hits(keys, key, texts), key, max_broadcast_rows=mb)
    else:
        d = _key_features(d, t["referer"], small["referer"], "referer", X.referer_pattern_flags_T(lib), mb)
    d = d.withColumn("minute", TR.minute_of())
    d = flag_join(d, t["spike_minutes"], [*scope, "minute"], "during_traffic_spike",
                  small=small["spike_minutes"])
    d = d.withColumns({
        "is_error": X.is_error(),
        "is_server_error": X.is_server_error(),
    })
    bool_cols = [c for c in T_FEATURES if c not in (
        "prev_timestamp", "time_diff", "request_count_per_ip", "requests_per_minute", "path_length",
        "ip_reputation_score", "country", "asn", "organization", "asn_reputation_score",
        "combined_reputation_score", "minute", "has_malicious_pattern", "likely_malicious_human",
        "is_hostroyale_asn", "is_high_risk_country", "is_high_risk_asn", "has_user_agent",
        "is_error", "is_server_error", "has_query_params")]
    d = _false_if_null(d, bool_cols)
    d = d.withColumn("has_user_agent", F.coalesce("has_user_agent", X.has_user_agent_T()))
    d = d.withColumn("has_malicious_pattern", X.any_of(X.MATCH_FLAGS))
    d = d.withColumn("likely_malicious_human", X.likely_malicious_human_T())
    d = d.withColumns(X.reputation_flags(fixed.T_HIGH_RISK_COUNTRIES, fixed.T_FLAGGED_ASN))
    return d.select(*PARSED_COLUMNS, *T_FEATURES, *_passthrough(d, T_FEATURES))


def enrich_serve(parsed: DataFrame, blocklist: DataFrame, malicious_user_agents: list[str] | DataFrame | None = None,
                 tiebreak: list[str] | None = None,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 scope: list[str] | None = None, old_browser: str = "reference",
                 lag_bucket: str = "minute") -> DataFrame:
    """Profile S: parsed rows -> parsed + serving features (+ pass-through columns).

    ``scope``, ``old_browser``, ``lag_bucket``, ``malicious_user_agents``: as for :func:`enrich_train`.
    """
    scope = list(scope or [])
    ua_list = _ua_entries(malicious_user_agents)
    mb = max_broadcast_rows
    rows = parsed

    path_aggs = [F.count_if(F.col("status_code") >= 400).alias("_err")]
    # One job persists and counts the independent per-key tables.
    t, small = sizes({
        "ip": TR.ip_rate_serve(rows, scope=scope),       # A9
        "blocklist": reputation_table(blocklist, "serve"),
        "path": _dim_by(rows, "path", path_aggs, scope),  # A14 counts
        "user_agent": _dim_by(rows, "user_agent", []),
        "referer": _dim_by(rows, "referer", []),
    }, mb, keep=("ip",))

    # Per-IP: reputation (J1), A11 coordinated ASN, A10 threshold.  The per-IP
    # aggregate feeds the reputation join, A11, the A10 threshold and the final
    # join (persisted).
    ip = add_reputation(t["ip"], blocklist, "serve", mb, table=t["blocklist"], small=small["blocklist"])
    ip = flag_join(ip, TR.coordinated_asns_serve(ip, scope), [*scope, "asn"], "from_coordinated_asn",
                   max_broadcast_rows=mb, small=small["ip"] or None)
    ip = TR.with_spike_flag_serve(ip, scope=scope)

    # Per-path: X4 (S), families on base path and query, A14.  Per-user-agent: X5-X10 (S), families.
    base_hits = X.family_hits_S(X.base_path())
    query_hits = X.family_hits_S(X.query_string())
    path_exprs = {
        "has_suspicious_patterns": X.suspicious_path_S(),
        **{f"_b_{k}": v for k, v in base_hits.items()},
        **{f"_q_{k}": v for k, v in query_hits.items()},
    }
    path_agg_flags = {"to_high_error_path": F.col("_err") > 5}
    ua_hits = X.family_hits_S(F.coalesce(F.col("user_agent"), F.lit("")))
    ua_exprs = {**X.ua_flags_S(ua_list, old_browser), **{f"_u_{k}": v for k, v in ua_hits.items()}}

    d = rows.withColumns(X.calendar_columns())
    d = TR.add_time_diff(d, key=[*scope, "ip"], tiebreak=tiebreak, with_prev=False, bucket=lag_bucket)
    d = d.withColumn("minute_bucket", TR.minute_of())
    d = join_dim(d, ip, [*scope, "ip"], "left", small=small["ip"], weight="ip_rows").drop("ip_rows")
    d = _key_features(d, t["path"], small["path"], "path", path_exprs, mb, path_agg_flags, scope)
    d = _key_features(d, t["user_agent"], small["user_agent"], "user_agent", ua_exprs, mb)
    ref_hits = X.family_hits_S(F.coalesce(F.col("referer"), F.lit("")))
    d = _key_features(d, t["referer"], small["referer"], "referer", {f"_r_{k}": v for k, v in ref_hits.items()}, mb)
    fams = list(fixed.S_FAMILIES)
    d = _false_if_null(d, [f"_{p}_{k}" for p in "bqur" for k in fams]
                       + ["has_suspicious_patterns", "to_high_error_path", "has_user_agent", "is_old_browser",
                          "is_known_bot", "is_suspicious_user_agent", "is_malicious_user_agent",
                          "ip_is_known_bad", "from_coordinated_asn", "during_traffic_spike"])
    d = d.withColumns({k: X.any_of([f"_{p}_{k}" for p in "bqur"]) for k in fams})
    d = d.withColumns({
        "path_matches": X.any_of([f"_b_{k}" for k in fams]),
        "query_matches": X.any_of([f"_q_{k}" for k in fams]),
        "ua_matches": X.any_of([f"_u_{k}" for k in fams]),
        "referrer_matches": X.any_of([f"_r_{k}" for k in fams]),
    })
    d = d.withColumn("has_malicious_pattern", X.any_of(fams))
    d = d.withColumns(X.reputation_flags(fixed.S_HIGH_RISK_COUNTRIES, None))
    d = d.withColumn("potential_dos", TR.potential_dos_serve())
    d = d.withColumn("potential_scanner", TR.potential_scanner_serve())
    d = d.withColumn("likely_malicious_human", X.likely_malicious_human_S())
    d = d.drop(*[f"_{p}_{k}" for p in "bqur" for k in fams])
    return d.select(*PARSED_COLUMNS, *S_FEATURES, *_passthrough(d, S_FEATURES))
