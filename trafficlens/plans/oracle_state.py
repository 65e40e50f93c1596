"""DuckDB oracle SQL for the queries of :mod:`.catalog_state` (correctness gate, not library code)."""

from __future__ import annotations

from ..functions import fixed
from ..schemas import HOURLY_COUNT_COLUMNS
from ..sources import fixtures as fx
from . import bayes as NB
from . import oracle as O
from .enrich import S_FEATURES, T_FEATURES

PARSED = ("ip, ts AS \"timestamp\", method, path, protocol, status_code, response_size, referer, "
          f"user_agent, {O.RAW} AS raw_log")


def build(base: dict[str, str]) -> dict[str, str]:
    """``base``: the oracles of the batch queries, which several of these equal."""
    q: dict[str, str] = {}
    T = O.t_flags()

    # ST2: a row of an hour that ended before the newest time of all earlier files, less a day, is late
    files = (f"{O.PRE}, f AS (SELECT *, {fx.FILE_OF_SQL} AS file, date_trunc('hour', ts) AS hour FROM req),\n"
             "top AS (SELECT file, max(ts) AS newest FROM f GROUP BY file),\n"
             "clock AS (SELECT a.file, max(b.newest) AS newest FROM top a LEFT JOIN top b ON b.file < a.file GROUP BY a.file),\n"
             "l AS (SELECT f.*, coalesce(hour + INTERVAL 1 HOUR <= newest - INTERVAL 1 DAY, FALSE) AS late FROM f JOIN clock USING (file))")
    q["st2_event_time"] = (
        f"{files} SELECT hour, count(*) FILTER (WHERE NOT late) AS total_requests,"
        " count(*) FILTER (WHERE NOT late AND classification NOT LIKE 'legitimate%') AS illegitimate_requests,"
        " round(avg(confidence) FILTER (WHERE NOT late), 6) AS avg_confidence, count(*) FILTER (WHERE late) AS late_requests"
        " FROM l GROUP BY hour")
    bot = O.s_flags()["is_known_bot"]
    q["st1_stream_reputation"] = (f"{O.PRE} SELECT n, b.ip IS NOT NULL AS ip_is_known_bad, coalesce(b.country, 'Unknown') AS country,"
                                  f" coalesce(b.asn, 'Unknown') AS asn, {bot} AS is_known_bot FROM req r LEFT JOIN bl b ON r.ip = b.ip")
    q["j3_weighted_join"] = (f"{O.PRE}{O.IPT} SELECT r.n, i.nrows AS request_count_per_ip, round(CASE WHEN nrows > 1 THEN"
                             " CASE WHEN span > 0 THEN nrows / span ELSE CAST(nrows AS DOUBLE) END ELSE 1.0 END, 6) AS requests_per_minute"
                             " FROM req r JOIN ipt2 i ON r.ip = i.ip")
    q["x11_x13_patterns_indexed"] = base["x11_x13_patterns_train"]
    q["st2_event_time_all"] = base["a16_hourly"]
    q["st3_event_time"] = f"{O.PRE} SELECT ip, date_trunc('minute', ts) AS minute FROM req GROUP BY 1, 2 HAVING count(*) > 30"
    q["st1_time_diff"] = f"{O.PRE}{O.W1} SELECT n, round(td, 6) AS time_diff, FALSE AS out_of_order FROM wd"
    q["st4_days_spike_train"] = base["q1_scope_spike_train"]
    q["st4_days_spike_serve"] = base["q1_scope_spike_serve"]
    q["st4_days_asns"] = (
        f"{O.PRE}, ipm AS (SELECT CAST(ts AS DATE) AS day, ip, date_trunc('minute', ts) AS m, count(*) AS c FROM req GROUP BY 1, 2, 3),"
        " ips AS (SELECT day, ip, avg(c) AS rpm FROM ipm GROUP BY 1, 2),"
        " rr AS (SELECT p.day, coalesce(b.asn, 'Unknown') AS asn, p.rpm FROM req r JOIN ips p ON CAST(r.ts AS DATE) = p.day AND r.ip = p.ip"
        " LEFT JOIN bl b ON r.ip = b.ip), am AS (SELECT day, asn, avg(rpm) AS a FROM rr GROUP BY 1, 2),"
        " thr AS (SELECT day, avg(a) + stddev_samp(a) AS t FROM am GROUP BY day) SELECT am.day, asn FROM am JOIN thr USING (day) WHERE a > t")

    for name in ("a6_spike_train", "a16_hourly", "a23_distinct_ips", "a1_ip_counts", "a2_rate_train", "a3_ip_stats"):
        q[name.split("_")[0] + "_from_days"] = base[name]

    q["io1_scan"] = f"{O.PRE} SELECT {PARSED} FROM req"
    q["io2_content"] = (f"{O.PRE} SELECT CAST(floor(n / 500) AS BIGINT) AS document,"
                        " row_number() OVER (PARTITION BY floor(n / 500) ORDER BY n) - 1 AS line_id,"
                        f" {O.RAW} AS raw_log, status_code FROM req_all")
    q["io3_io4_csv"] = base["p1_parse"]
    q["io5_io6_jsonl"] = base["m6_training_text"]
    q["io8_ua_list"] = (f"{O.PRE}, a AS (SELECT DISTINCT user_agent AS u FROM req WHERE length(user_agent) BETWEEN 2 AND 50)"
                        " SELECT n, EXISTS (SELECT 1 FROM a WHERE contains(user_agent, u)) AS is_malicious_user_agent FROM req")
    q["io9_patterns"] = f"{O.PRE} SELECT n, path LIKE '/scan/%' AS path_matches, user_agent LIKE 'python%' AS ua_matches FROM req"
    hourly = base["a16_hourly"]
    q["io10_hourly"] = f"SELECT hour, {', '.join(HOURLY_COUNT_COLUMNS)}, avg_confidence FROM ({hourly})"
    q["s2_by_hour"] = f"SELECT hour, total_requests FROM ({hourly}) ORDER BY hour LIMIT 24"
    q["io11_empty"] = (f"SELECT * FROM (VALUES ('train', 0::BIGINT, {len(T_FEATURES)}::BIGINT), ('serve', 0::BIGINT, {len(S_FEATURES)}::BIGINT))"
                       " AS t(profile, rows, feature_columns)")
    q["io12_package"] = f"{O.PRE} SELECT count(*) AS rows, 0::BIGINT AS different, '4' AS blacklist FROM req"
    q["s1_sorted"] = f"{O.PRE} SELECT n, row_number() OVER (ORDER BY ip, ts, n) - 1 AS place FROM req"
    q["s6_first_rows"] = f"{O.PRE} SELECT n, ip, path FROM req ORDER BY ts, n LIMIT 25"
    q["p9_observed"] = base["p9_counters"]
    q["m10_analyze"] = (f"{O.PRE} SELECT date_trunc('hour', ts) AS hour, count(*) AS total_requests, count(*) AS both_kinds"
                        " FROM req WHERE CAST(status_code AS VARCHAR) NOT LIKE '4%' GROUP BY 1")

    # naive Bayes by counts
    flags = [f"({T[f]}) AS {f}" for f in NB.REQUEST_FLAGS]
    named = ", ".join(f"CASE WHEN {f} THEN 'flag:{f}' END" for f in NB.REQUEST_FLAGS)
    classes = ", ".join(f"({i}, '{c}')" for i, c in enumerate(fixed.CLASSES))
    counts = (
        f"{O.PRE}, x AS (SELECT n, classification, path, {', '.join(flags)} FROM req),\n"
        f"feat AS (SELECT DISTINCT n, 'path:' || t AS feature FROM (SELECT n, unnest(regexp_split_to_array(lower(path), '{NB.TOKEN_SPLIT}')) AS t FROM x)"
        f" WHERE t <> '' UNION ALL SELECT n, f FROM (SELECT n, unnest([{named}]) AS f FROM x) WHERE f IS NOT NULL),\n"
        f"cls AS (SELECT * FROM (VALUES {classes}) AS c(i, classification)),\n"
        "tr AS (SELECT x.n, cls.i FROM x JOIN cls USING (classification) WHERE x.n % 10 <> 0),\n"
        f"names AS (SELECT DISTINCT feature FROM feat JOIN tr USING (n) UNION SELECT unnest([{', '.join(repr('flag:' + f) for f in NB.REQUEST_FLAGS)}])),\n"
        "nt AS (SELECT feature, i, count(*) AS k FROM feat JOIN tr USING (n) GROUP BY 1, 2),\n"
        "tot AS (SELECT cls.i, coalesce(sum(k), 0) + (SELECT count(*) FROM names) AS size FROM cls LEFT JOIN nt USING (i) GROUP BY 1),\n"
        "nc AS (SELECT cls.i, count(tr.n) AS k FROM cls LEFT JOIN tr USING (i) GROUP BY 1),\n"
        "wt AS (SELECT names.feature, cls.i, ln((coalesce(nt.k, 0) + 1) / CAST(tot.size AS DOUBLE)) AS w FROM names JOIN cls ON TRUE"
        " LEFT JOIN nt ON nt.feature = names.feature AND nt.i = cls.i JOIN tot ON tot.i = cls.i),\n"
        f"pr AS (SELECT i, ln((k + 1) / CAST((SELECT count(*) FROM tr) + {len(fixed.CLASSES)} AS DOUBLE)) AS w FROM nc)")
    q["m8_counts_model"] = (f"{counts} SELECT classification, feature, round(w, 6) AS log_weight FROM (SELECT feature, i, w FROM wt"
                            " UNION ALL SELECT 'prior', i, w FROM pr) JOIN cls USING (i)")
    q["m9_counts_classify"] = (
        f"{counts}, sc AS (SELECT x.n, pr.i, pr.w + coalesce(s.w, 0) AS s FROM x JOIN pr ON TRUE LEFT JOIN"
        " (SELECT n, i, sum(w) AS w FROM feat JOIN wt USING (feature) GROUP BY 1, 2) s ON s.n = x.n AND s.i = pr.i),"
        " best AS (SELECT n, max(s) AS m FROM sc GROUP BY n)"
        " SELECT n, classification, round(conf, 6) AS confidence FROM (SELECT sc.n, sc.i, sc.s, m,"
        " 1 / sum(exp(sc.s - m)) OVER (PARTITION BY sc.n) AS conf FROM sc JOIN best USING (n)) JOIN cls USING (i)"
        " WHERE s = m")
    return q
