"""DuckDB oracle SQL for the registered queries (correctness gate, not library code).

Each string runs on DuckDB with the driver's views (``events`` ...).  The
fixture log is derived with the same SQL text as the Spark side; the operator
itself is written independently here (windows, GROUP BY, regexp_matches).
Regex lists are generated from the same fixed lists (RE2 syntax is compatible
for them).
"""

from __future__ import annotations

from ..functions import fixed
from ..functions import labels as L
from ..functions.features import MATCH_FLAGS, T_FAMILY_FLAGS
from ..functions.regex import duck_matches_any, duck_regex
from ..schemas import HOURLY_PCT_COLUMNS
from ..sources import fixtures as fx
from ..sources.threat_patterns import DEFAULT_LIBRARY

REDIRECTS = ", ".join(str(c) for c in fixed.REDIRECT_STATUS_CODES)

PRE = (
    f"WITH req_all AS ({fx.REQ_ALL_SQL.format(events='events')}),\n"
    f"req AS (SELECT * FROM req_all WHERE status_code NOT IN ({REDIRECTS})),\n"
    f"bl AS {fx.duck_blocklist_sql()}"
)

RAW = ("ip || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] \"' || method || ' ' || path || ' ' "
       "|| protocol || '\" ' || CAST(status_code AS VARCHAR) || ' ' || CASE WHEN status_code = 404 THEN '-' "
       "ELSE CAST(response_size AS VARCHAR) END || ' \"' || referer || '\" \"' || user_agent || '\"'")

SECONDS = "CAST(epoch_us({a}) - epoch_us({b}) AS DOUBLE) / 1e6"

# Lag over (ip) ordered by (ts, n).
W1 = (", w AS (SELECT *, lag(ts) OVER (PARTITION BY ip ORDER BY ts, n) AS prev_ts FROM req),\n"
      f"wd AS (SELECT *, {SECONDS.format(a='ts', b='prev_ts')} AS td FROM w)")

# A2/A3/A4/A5 per-IP (profile T).
IPT = (", ipt AS (SELECT ip, count(*) AS nrows, count(ts) AS nts, min(ts) AS first_seen, max(ts) AS last_seen,"
       " count(DISTINCT path) AS upaths FROM req GROUP BY ip),\n"
       f"ipt2 AS (SELECT *, ({SECONDS.format(a='last_seen', b='first_seen')}) / 60 AS span FROM ipt)")

# A9 per-IP rate (profile S).
IPS = (", ipm AS (SELECT ip, date_trunc('minute', ts) AS m, count(*) AS c FROM req GROUP BY 1, 2),\n"
       "ips AS (SELECT ip, avg(c) AS rpm FROM ipm GROUP BY ip)")

REP = (", asnrep AS (SELECT asn, CAST(count(*) AS DOUBLE) / max(count(*)) OVER () * 100 AS score FROM bl GROUP BY asn),\n"
       "rep AS (SELECT d.ip, coalesce(b.country, 'Unknown') AS country, coalesce(b.asn, 'Unknown') AS asn,"
       " coalesce(b.organization, 'Unknown') AS organization,"
       " CASE WHEN b.ip IS NULL THEN 0.0 ELSE 100.0 END AS ip_score, b.ip IS NOT NULL AS known_bad,"
       " CASE WHEN b.ip IS NULL THEN 0.0 ELSE 100.0 END AS asn_score_t,"
       " CASE WHEN b.ip IS NULL THEN 0.0 ELSE coalesce(a.score, 0.0) END AS asn_score_s"
       " FROM (SELECT DISTINCT ip FROM req) d LEFT JOIN bl b ON d.ip = b.ip LEFT JOIN asnrep a ON b.asn = a.asn)")

BP = "split_part(path, '?', 1)"
QS = "CASE WHEN strpos(path, '?') > 0 THEN substr(path, strpos(path, '?') + 1) ELSE '' END"
UA = "coalesce(user_agent, '')"
RF = "coalesce(referer, '')"


def m(expr: str, pats, ci: bool = True) -> str:
    return duck_matches_any(expr, pats, ci)


def contains_any(expr: str, needles) -> str:
    return "(" + " OR ".join(f"coalesce(strpos({expr}, '{n}') > 0, FALSE)" for n in needles) + ")"


# ---- profile T row flags ---------------------------------------------------
def t_flags() -> dict[str, str]:
    has = "coalesce(user_agent <> '-', TRUE)"
    bot = m("user_agent", [fixed.T_KNOWN_BOT_REGEX])
    old = m("user_agent", [fixed.T_OLD_BROWSER_REGEX])
    mal = contains_any("user_agent", fixed.FALLBACK_MALICIOUS_USER_AGENTS)
    lib = DEFAULT_LIBRARY
    f = {
        "is_error": "status_code >= 400",
        "is_server_error": "status_code >= 500",
        "path_length": "CAST(length(path) AS INTEGER)",
        "has_query_params": "coalesce(strpos(path, '?') > 0, FALSE)",
        "has_suspicious_patterns": m("path", [fixed.T_SUSPICIOUS_PATH_REGEX]),
        "has_user_agent": has,
        "is_known_bot": bot,
        "is_common_browser": m("user_agent", [fixed.T_COMMON_BROWSER_REGEX]),
        "is_old_browser": old,
        "is_malicious_user_agent": mal,
        "is_suspicious_user_agent": f"((NOT {has}) OR {bot} OR ({old} AND NOT {bot}) OR {mal})",
        "path_matches": m("path", lib["request_uri"]),
        "query_matches": f"CASE WHEN strpos(path, '?') > 0 THEN {m(QS, lib['query_string'])} ELSE FALSE END",
        "ua_matches": m("user_agent", lib["user_agent"]),
        "referrer_matches": f"CASE WHEN referer <> '-' THEN {m('referer', lib['referrer'])} ELSE FALSE END",
    }
    for flag, cat in T_FAMILY_FLAGS.items():
        f[flag] = m("path", lib[cat])
    f["has_malicious_pattern"] = "(" + " OR ".join(f[k] for k in MATCH_FLAGS) + ")"
    f["likely_malicious_human"] = (f"({f['has_malicious_pattern']} AND NOT {bot} AND "
                                   f"({f['is_suspicious_user_agent']} OR {mal}))")
    f["ua_category"] = (f"CASE WHEN NOT {has} THEN 'No user agent' WHEN {old} THEN 'Old browser' "
                        f"WHEN {bot} THEN 'Known bot' ELSE 'Modern browser' END")
    return f


# ---- profile S row flags ---------------------------------------------------
def _fam_field(field: str, pats) -> str:
    return f"({field} <> '' AND {m(field, pats)})"


def s_flags() -> dict[str, str]:
    ua = "user_agent"
    f = {
        "has_suspicious_patterns": m("path", fixed.S_SUSPICIOUS_PATH_PATTERNS),
        "has_user_agent": f"coalesce({ua} IS NOT NULL AND {ua} <> '-' AND {ua} <> '', FALSE)",
        "is_old_browser": m(ua, fixed.S_OLD_BROWSER_PATTERNS, ci=False),
        "is_known_bot": m(ua, fixed.S_KNOWN_BOT_PATTERNS),
        "is_suspicious_user_agent": m(ua, fixed.S_SUSPICIOUS_UA_PATTERNS),
        "is_malicious_user_agent": m(ua, [_re_escape(e) for e in fixed.FALLBACK_MALICIOUS_USER_AGENTS]),
    }
    fams = fixed.S_FAMILIES
    for fam, pats in fams.items():
        f[fam] = "(" + " OR ".join(_fam_field(x, pats) for x in (BP, QS, UA, RF)) + ")"
    allp = [p for pats in fams.values() for p in pats]
    f["path_matches"] = _fam_field(BP, allp)
    f["query_matches"] = _fam_field(QS, allp)
    f["ua_matches"] = _fam_field(UA, allp)
    f["referrer_matches"] = _fam_field(RF, allp)
    f["has_malicious_pattern"] = "(" + " OR ".join(f[k] for k in fams) + ")"
    return f


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def sel(cols: dict[str, str], names: list[str]) -> str:
    return ", ".join(f"{cols[n]} AS {n}" for n in names)


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

def build() -> dict[str, str]:
    T = t_flags()
    S = s_flags()
    q: dict[str, str] = {}

    parsed_cols = ("n, ip, ts AS \"timestamp\", method, path, protocol, status_code, response_size, referer, "
                   f"user_agent, {RAW} AS raw_log")
    q["p1_parse"] = f"{PRE} SELECT {parsed_cols} FROM req"
    q["p1_odd_lines"] = (f"{PRE} SELECT n, CASE WHEN n % 5 = 1 THEN NULL ELSE status_code END AS status_code,"
                         " CAST(length(user_agent) + CASE WHEN n % 5 = 2 THEN 2 ELSE 0 END AS BIGINT) AS ua_chars"
                         f" FROM req_all WHERE n % 5 <> 0 AND (n % 5 = 1 OR status_code NOT IN ({REDIRECTS}))")
    q["p7_rejects"] = f"{PRE} SELECT n, '::ffff:' || {RAW} AS stripped_line FROM req_all WHERE n % 5 = 0"
    q["p8_redirect_filter"] = f"{PRE} SELECT status_code, count(*) AS count FROM req GROUP BY status_code"
    q["p9_counters"] = (f"{PRE} SELECT count(*) AS total_lines,"
                        f" count(*) FILTER (WHERE n % 5 <> 0 AND (n % 5 = 1 OR status_code NOT IN ({REDIRECTS}))) AS parsed,"
                        f" count(*) FILTER (WHERE n % 5 > 1 AND status_code IN ({REDIRECTS})) AS skipped_redirects,"
                        " count(*) FILTER (WHERE n % 5 = 0) AS unparsed FROM req_all")
    q["p10_whitelist"] = (f"{PRE} SELECT n, status_code FROM req"
                          " WHERE regexp_matches(CAST(status_code AS VARCHAR), '^(?:50[0-9])')")
    q["p10_blacklist"] = (f"{PRE} SELECT n, status_code FROM req"
                          " WHERE NOT regexp_matches(CAST(status_code AS VARCHAR), '^(?:4)')")
    q["u1_union"] = f"{PRE} SELECT n, status_code FROM req_all"

    q["w1_time_diff"] = f"{PRE}{W1} SELECT n, prev_ts AS prev_timestamp, round(td, 6) AS time_diff FROM wd"
    q["a1_ip_counts"] = f"{PRE} SELECT ip, count(*) AS request_count FROM req GROUP BY ip"
    q["a2_rate_train"] = (f"{PRE}{IPT} SELECT ip, nrows AS request_count_per_ip, round(CASE WHEN nrows > 1 THEN"
                          " CASE WHEN span > 0 THEN nrows / span ELSE CAST(nrows AS DOUBLE) END ELSE 1.0 END, 6)"
                          " AS requests_per_minute FROM ipt2")
    dur = f"(({SECONDS.format(a='max(ts)', b='min(ts)')}) / 60)"
    q["a3_ip_stats"] = (
        f"{PRE}{W1} SELECT ip, min(ts) AS first_seen, max(ts) AS last_seen, count(ts) AS request_count,"
        " round(avg(td), 6) AS avg_time_between_requests, round(min(td), 6) AS min_time_between_requests,"
        " round(stddev_samp(td), 6) AS std_time_between_requests,"
        " round(avg(CASE WHEN status_code >= 400 THEN 1.0 ELSE 0.0 END), 6) AS error_rate,"
        " round(avg(CASE WHEN status_code >= 500 THEN 1.0 ELSE 0.0 END), 6) AS server_error_rate,"
        f" count(DISTINCT path) AS unique_paths, round({dur}, 6) AS duration_minutes,"
        f" round(CASE WHEN {dur} > 0 THEN count(ts) / {dur} ELSE CAST(count(ts) AS DOUBLE) END, 6)"
        " AS requests_per_minute FROM wd GROUP BY ip")
    q["a4_dos_train"] = (
        f"{PRE}{W1} SELECT ip FROM wd GROUP BY ip HAVING"
        f" (CASE WHEN {dur} > 0 THEN count(ts) / {dur} ELSE count(ts) END) > 30"
        " AND avg(td) < 1.0 AND count(ts) > 50")
    q["a5_scanner_train"] = (f"{PRE} SELECT ip FROM req GROUP BY ip"
                             " HAVING count(DISTINCT path) > 20 AND count(ts) > 30")
    q["a6_spike_train"] = (
        f"{PRE}, pm AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS c FROM req GROUP BY 1),"
        " st AS (SELECT avg(c) AS mu, stddev_samp(c) AS sd FROM pm)"
        " SELECT minute FROM pm, st WHERE sd > 0 AND (c - mu) / sd > 3")
    q["a7_asn_train"] = (
        f"{PRE}, ipc AS (SELECT r.ip, coalesce(b.asn, 'Unknown') AS asn, count(*) AS c"
        " FROM req r LEFT JOIN bl b ON r.ip = b.ip GROUP BY 1, 2)"
        " SELECT asn FROM ipc GROUP BY asn HAVING sum(c) > 100 AND count(*) > 5"
        " AND stddev_samp(c) / avg(c) < 0.5")
    q["a8_error_path_train"] = (f"{PRE} SELECT path FROM req WHERE status_code >= 500 GROUP BY path"
                                " HAVING count(*) > 5")
    q["a9_rate_serve"] = f"{PRE}{IPS} SELECT ip, round(rpm, 6) AS requests_per_minute FROM ips"
    q["a10_spike_serve"] = (
        f"{PRE}{IPS}, rr AS (SELECT p.rpm FROM req r JOIN ips p ON r.ip = p.ip),"
        " thr AS (SELECT avg(rpm) + 2 * stddev_samp(rpm) AS t FROM rr)"
        " SELECT ip, coalesce(rpm > t, FALSE) AS during_traffic_spike FROM ips, thr")
    q["a11_asn_serve"] = (
        f"{PRE}{IPS}, rr AS (SELECT coalesce(b.asn, 'Unknown') AS asn, p.rpm FROM req r JOIN ips p ON r.ip = p.ip"
        " LEFT JOIN bl b ON r.ip = b.ip), am AS (SELECT asn, avg(rpm) AS a FROM rr GROUP BY asn),"
        " thr AS (SELECT avg(a) + stddev_samp(a) AS t FROM am) SELECT asn FROM am, thr WHERE a > t")
    day = "coalesce(CAST(ts AS DATE), DATE '1970-01-01')"
    q["q1_scope_time_diff"] = (
        f"{PRE}, w AS (SELECT n, {day} AS day, ts, lag(ts) OVER (PARTITION BY {day}, ip ORDER BY ts, n) AS prev_ts"
        f" FROM req) SELECT n, day, round({SECONDS.format(a='ts', b='prev_ts')}, 6) AS time_diff FROM w")
    q["q1_scope_spike_train"] = (
        f"{PRE}, pm AS (SELECT {day} AS day, date_trunc('minute', ts) AS minute, count(*) AS c FROM req"
        " WHERE ts IS NOT NULL GROUP BY 1, 2),"
        " st AS (SELECT day, avg(c) AS mu, stddev_samp(c) AS sd FROM pm GROUP BY day)"
        " SELECT pm.day, minute FROM pm JOIN st ON pm.day = st.day WHERE sd > 0 AND (c - mu) / sd > 3")
    q["q1_scope_spike_serve"] = (
        f"{PRE}, ipm AS (SELECT {day} AS day, ip, date_trunc('minute', ts) AS m, count(*) AS c FROM req"
        " GROUP BY 1, 2, 3), ips AS (SELECT day, ip, avg(c) AS rpm FROM ipm GROUP BY 1, 2),"
        f" rr AS (SELECT p.day, p.rpm FROM req r JOIN ips p ON {day} = p.day AND r.ip = p.ip),"
        " thr AS (SELECT day, avg(rpm) + 2 * stddev_samp(rpm) AS t FROM rr GROUP BY day)"
        " SELECT ips.day, ip, coalesce(rpm > t, FALSE) AS during_traffic_spike FROM ips"
        " LEFT JOIN thr ON ips.day = thr.day")
    q["a12_dos_serve"] = (f"{PRE}{W1}{IPS} SELECT n, coalesce(p.rpm > 30 AND td < 1, FALSE) AS potential_dos"
                          " FROM wd JOIN ips p ON wd.ip = p.ip")
    q["a13_scanner_serve"] = (f"{PRE}{IPS} SELECT n, coalesce(p.rpm > 10 AND status_code >= 400"
                              " AND status_code < 500, FALSE) AS potential_scanner FROM req r JOIN ips p"
                              " ON r.ip = p.ip")
    q["a14_error_path_serve"] = (f"{PRE} SELECT path FROM req WHERE status_code >= 400 GROUP BY path"
                                 " HAVING count(*) > 5")
    q["a15_asn_reputation"] = (
        f"{PRE}{REP}, a AS (SELECT asn, count(*) AS count, min(country) AS country,"
        " min(organization) AS organization FROM bl GROUP BY asn),"
        " rq AS (SELECT rep.asn, count(*) AS requests FROM req JOIN rep ON req.ip = rep.ip GROUP BY 1)"
        " SELECT a.asn, a.count, a.country, a.organization, round(asnrep.score, 6) AS reputation_score,"
        " coalesce(rq.requests, 0) AS requests FROM a JOIN asnrep ON a.asn = asnrep.asn"
        " LEFT JOIN rq ON a.asn = rq.asn")

    rep_cols = ("ip, country, asn, organization, round(ip_score, 6) AS ip_reputation_score,"
                " known_bad AS ip_is_known_bad, round({s}, 6) AS asn_reputation_score")
    q["j1_reputation_train"] = f"{PRE}{REP} SELECT {rep_cols.format(s='asn_score_t')} FROM rep"
    q["j1_reputation_serve"] = f"{PRE}{REP} SELECT {rep_cols.format(s='asn_score_s')} FROM rep"

    q["x1_x3_basic"] = f"{PRE} SELECT n, {sel(T, ['is_error', 'is_server_error', 'path_length', 'has_query_params'])} FROM req"
    q["x4_x10_ua_train"] = (f"{PRE} SELECT n, {sel(T, ['has_suspicious_patterns', 'has_user_agent', 'is_known_bot', 'is_common_browser', 'is_old_browser', 'is_suspicious_user_agent', 'is_malicious_user_agent'])} FROM req")
    q["x4_x10_ua_serve"] = (f"{PRE} SELECT n, {sel(S, ['has_suspicious_patterns', 'has_user_agent', 'is_old_browser', 'is_known_bot', 'is_suspicious_user_agent', 'is_malicious_user_agent'])} FROM req")
    pf = MATCH_FLAGS + ["has_malicious_pattern"]
    q["x11_x13_patterns_train"] = f"{PRE} SELECT n, {sel(T, pf)} FROM req"
    q["x11_x13_patterns_serve"] = f"{PRE} SELECT n, {sel(S, pf)} FROM req"
    q["x14_likely_train"] = f"{PRE} SELECT n, {T['likely_malicious_human']} AS likely_malicious_human FROM req"
    s_likely = (f"({S['has_malicious_pattern']} AND NOT {S['is_known_bot']} AND coalesce(p.rpm < 30, FALSE) AND "
                f"({S['sql_injection_matches']} OR {S['xss_matches']} OR {S['cmd_injection_matches']} OR "
                f"{S['file_inclusion_matches']} OR {S['shell_upload_matches']}))")
    q["x14_likely_serve"] = (f"{PRE}{IPS} SELECT n, {s_likely} AS likely_malicious_human FROM req r"
                             " LEFT JOIN ips p ON r.ip = p.ip")
    q["x16_x18_risk"] = (
        f"{PRE}{REP} SELECT ip, coalesce(strpos(asn, '{fixed.T_FLAGGED_ASN}') > 0, FALSE) AS is_hostroyale_asn,"
        f" country IN ({', '.join(repr(c) for c in fixed.T_HIGH_RISK_COUNTRIES)}) AS is_high_risk_country,"
        " asn_score_t > 50 AS is_high_risk_asn,"
        " round(ip_score * 0.7 + asn_score_t * 0.3, 6) AS combined_reputation_score FROM rep")
    q["x16_x18_risk_serve"] = (
        f"{PRE}{REP} SELECT ip,"
        f" country IN ({', '.join(repr(c) for c in fixed.S_HIGH_RISK_COUNTRIES)}) AS is_high_risk_country,"
        " asn_score_s > 50 AS is_high_risk_asn,"
        " round(ip_score * 0.7 + asn_score_s * 0.3, 6) AS combined_reputation_score FROM rep")
    q["x20_calendar"] = (f"{PRE} SELECT n, CAST(hour(ts) AS INTEGER) AS hour_of_day,"
                         " CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,"
                         " CASE WHEN isodow(ts) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,"
                         " CASE WHEN hour(ts) BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours FROM req")
    q["x21_path_split"] = f"{PRE} SELECT n, {BP} AS base_path, {QS} AS query_string FROM req"
    presets = fixed.OLD_BROWSER_PRESETS
    q["x8_old_browser_presets"] = (
        f"{PRE} SELECT n, "
        + ", ".join(f"{m('user_agent', presets[prof][preset], ci=(prof == 'train'))} AS old_{prof}_{preset}"
                    for prof in ("train", "serve") for preset in ("reference", "corrected"))
        + " FROM req")
    # M3: the four answer shapes of the catalog query, parsed back.
    nl = "chr(10)"
    # shapes 3 (prose), 5 (a broken fence) and 7 (two objects) are unknown; 4 lacks only the class
    q["m3_answer_parse"] = (
        f"{PRE} SELECT n, CASE WHEN n % 8 IN (3, 4, 5, 7) THEN 'unknown' ELSE classification END AS classification,"
        " CASE WHEN n % 8 IN (3, 5, 7) THEN 0.0 ELSE confidence END AS confidence,"
        " CASE WHEN n % 8 IN (3, 5, 7) THEN '' WHEN n % 8 = 2 THEN 'No reasoning provided'"
        " WHEN n % 8 = 6 THEN 'a {b} c' ELSE 'path ' || path END AS reasoning FROM req")
    flags = "".join(f", '{name}:'" + "".join(f", '- {f}: {'0' if f.endswith('_score') else 'false'}'" for f in fields)
                    for name, fields in L.SERVING_PROMPT_SECTIONS.items())
    q["m7_prompt"] = (
        f"{PRE}{W1} SELECT n, concat_ws(chr(10), 'Classify this web request.', 'client: ' || ip || ' (Unknown, Unknown)',"
        " 'request: ' || method || ' ' || path || ' ' || protocol, 'user agent: ' || user_agent,"
        " 'status: ' || CAST(status_code AS VARCHAR), 'rate: 0.00 per minute',"
        f" 'seconds since previous request: ' || coalesce(CAST(td AS VARCHAR), 'N/A'){flags}) AS prompt FROM wd")
    key = f"{RAW} || '|' || CAST(n AS VARCHAR) || '|'"
    q["s5_sample"] = (f"{PRE} SELECT n, ip, ts AS \"timestamp\", path, status_code FROM req"
                      f" ORDER BY md5({key} || '42'), {RAW}, n LIMIT 1000")
    q["s7_split"] = (f"{PRE} SELECT n, CASE WHEN md5({key} || '7') < '{int(0.1 * (1 << 60)):015x}'"
                     " THEN 'validation' ELSE 'train' END AS split FROM req")
    # M4: generated answers, parsed back.
    q["m4_answer_parse"] = (
        f"{PRE}, t AS (SELECT n, 'Classification: ' || classification || {nl} || 'Confidence: '"
        f" || CAST(confidence AS VARCHAR) || {nl} || 'Reasoning: request to ' || path || {nl} || {nl}"
        " || 'trailing text' AS text FROM req),"
        " x AS (SELECT n, regexp_extract(text, 'Classification:\\s*(\\w+)', 1) AS cr,"
        " regexp_extract(text, 'Confidence:\\s*([0-9.]+)', 1) AS ct,"
        " regexp_extract(text, '(?s)Reasoning:\\s*(.+?)(\\n\\n|$)', 1) AS rs FROM t),"
        " y AS (SELECT *, TRY_CAST(ct AS DOUBLE) AS cf, ct <> '' AND TRY_CAST(ct AS DOUBLE) IS NULL AS bad FROM x),"
        " z AS (SELECT n, bad, CASE WHEN bad THEN 'unknown' WHEN cr <> '' THEN cr ELSE 'unknown' END AS cls,"
        " CASE WHEN bad THEN 0.0 ELSE coalesce(cf, 0.0) END AS confidence,"
        " CASE WHEN bad THEN 'Error parsing model output' WHEN rs <> '' THEN trim(rs)"
        " ELSE 'No reasoning provided' END AS reasoning FROM y)"
        " SELECT n, cls AS classification, confidence, reasoning,"
        " NOT bad AND starts_with(lower(cls), 'legitimate') AS is_legitimate,"
        " NOT bad AND contains(lower(cls), 'human') AS is_human FROM z")
    q["x22_traversal"] = f"{PRE} SELECT n, {m('path', [fixed.PATH_TRAVERSAL_REGEX])} AS path_traversal FROM req"
    q["x23_ua_category"] = f"{PRE} SELECT n, {T['ua_category']} AS ua_category FROM req"

    legit = "lower(classification) LIKE 'legitimate%'"
    human = "lower(classification) LIKE '%human%'"
    q["m5_flags"] = f"{PRE} SELECT n, classification, {legit} AS is_legitimate, {human} AS is_human FROM req"
    q["q2_compat_flags"] = (f"{PRE} SELECT n, lower(classification) LIKE '%legitimate%' AS is_legitimate FROM req")

    hourly_counts = (
        "date_trunc('hour', ts) AS hour, count(ip) AS total_requests,"
        f" count(*) FILTER (WHERE {legit}) AS legitimate_requests,"
        f" count(*) FILTER (WHERE NOT ({legit})) AS illegitimate_requests,"
        f" count(*) FILTER (WHERE {human}) AS human_requests,"
        f" count(*) FILTER (WHERE NOT ({human})) AS bot_requests,"
        + ", ".join(f"count(*) FILTER (WHERE classification = '{c}') AS {c}_requests" for c in fixed.CLASSES)
        + ", avg(confidence) AS avg_confidence")
    H = f", h AS (SELECT {hourly_counts} FROM req WHERE ts IS NOT NULL GROUP BY 1)"

    def r2(num: str) -> str:
        x = f"(CAST({num} AS DOUBLE) * 100.0 / total_requests)"
        return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 12)), 2) AS DOUBLE)"

    pct_cols = ", ".join(f"{r2(p.replace('_pct', '_requests'))} AS {p}" for p in HOURLY_PCT_COLUMNS)
    HP = f", hp AS (SELECT *, {pct_cols} FROM h)"
    counts = ", ".join(["total_requests", "legitimate_requests", "illegitimate_requests", "human_requests",
                        "bot_requests"] + [f"{c}_requests" for c in fixed.CLASSES])
    q["a16_hourly"] = f"{PRE}{H} SELECT hour, {counts}, round(avg_confidence, 6) AS avg_confidence FROM h"
    q["a17_hourly_pct"] = f"{PRE}{H}{HP} SELECT hour, {', '.join(HOURLY_PCT_COLUMNS)} FROM hp"
    q["a18_hourly_alt"] = (
        f"{PRE}, h2 AS (SELECT date_trunc('hour', ts) AS hour, count(classification) AS total_requests,"
        f" count(*) FILTER (WHERE {legit}) AS legitimate_requests,"
        f" count(*) FILTER (WHERE {human}) AS human_requests FROM req WHERE ts IS NOT NULL GROUP BY 1)"
        " SELECT hour, total_requests, legitimate_requests, human_requests,"
        " round(CAST(legitimate_requests AS DOUBLE) * 100.0 / total_requests, 6) AS legitimate_pct,"
        " round(CAST(human_requests AS DOUBLE) * 100.0 / total_requests, 6) AS human_pct,"
        " round(100.0 - CAST(human_requests AS DOUBLE) * 100.0 / total_requests, 6) AS bot_pct,"
        " round(100.0 - CAST(legitimate_requests AS DOUBLE) * 100.0 / total_requests, 6) AS illegitimate_pct,"
        " total_requests - legitimate_requests AS illegitimate_requests,"
        " total_requests - human_requests AS bot_requests FROM h2")
    classes_vals = ", ".join(f"('{c}')" for c in fixed.CLASSES + [fixed.UNKNOWN_CLASS])
    q["a19_class_breakdown"] = (
        f"{PRE}, c AS (SELECT * FROM (VALUES {classes_vals}) t(classification)),"
        " cnt AS (SELECT classification, count(*) AS k FROM req GROUP BY 1), tot AS (SELECT count(*) AS t FROM req)"
        " SELECT c.classification, coalesce(cnt.k, 0) AS count,"
        " round(CASE WHEN tot.t > 0 THEN CAST(coalesce(cnt.k, 0) AS DOUBLE) * 100.0 / tot.t ELSE 0.0 END, 6) AS pct"
        " FROM c LEFT JOIN cnt ON c.classification = cnt.classification, tot")
    q["a20_time_range"] = f"{PRE} SELECT min(ts) AS start_time, max(ts) AS end_time FROM req"

    att = (f"FROM req WHERE classification IN ('illegitimate_human', 'illegitimate_bot')"
           f" AND {S['has_malicious_pattern']}")
    trav = m("path", [fixed.PATH_TRAVERSAL_REGEX])
    att_cols = {
        "potential_attacks": "count(*)",
        "sql_injection": f"count(*) FILTER (WHERE {S['sql_injection_matches']})",
        "xss": f"count(*) FILTER (WHERE {S['xss_matches']})",
        "command_injection": f"count(*) FILTER (WHERE {S['cmd_injection_matches']})",
        "file_inclusion": f"count(*) FILTER (WHERE {S['file_inclusion_matches']})",
        "path_traversal": f"count(*) FILTER (WHERE {trav})",
        "wordpress": f"count(*) FILTER (WHERE {S['wordpress_matches']})",
        "shell_upload": f"count(*) FILTER (WHERE {S['shell_upload_matches']})",
    }
    ATT = ", att AS (SELECT " + ", ".join(f"{v} AS {k}" for k, v in att_cols.items()) + f" {att})"
    q["a21_attacks"] = (f"{PRE}{ATT} SELECT *, file_inclusion + path_traversal AS file_inclusion_or_traversal"
                        " FROM att")
    q["a22_report_totals"] = (
        f"{PRE}{H}{HP} SELECT CAST(sum(total_requests) AS BIGINT) AS total_requests,"
        " CAST(sum(legitimate_requests) AS BIGINT) AS legitimate_requests,"
        " CAST(sum(illegitimate_requests) AS BIGINT) AS illegitimate_requests,"
        " CAST(sum(human_requests) AS BIGINT) AS human_requests,"
        " CAST(sum(bot_requests) AS BIGINT) AS bot_requests,"
        " round(avg(avg_confidence), 6) AS avg_model_confidence,"
        + ", ".join(f"round(CAST(sum({k}_requests) AS DOUBLE) * 100.0 / sum(total_requests), 6) AS {k}_pct"
                    for k in ("legitimate", "illegitimate", "human", "bot"))
        + " FROM hp")
    q["a23_distinct_ips"] = f"{PRE} SELECT DISTINCT ip FROM req"

    illeg = "classification IN ('illegitimate_human', 'illegitimate_bot')"

    def top(key: str, k: int, src: str = "req") -> str:
        return (f"SELECT {key}, count(*) AS count FROM {src} WHERE {illeg} GROUP BY {key}"
                f" ORDER BY count DESC, {key} ASC LIMIT {k}")

    RREP = f"{REP}, rr AS (SELECT req.*, rep.asn, rep.country FROM req JOIN rep ON req.ip = rep.ip)"
    q["s3_top_ips"] = f"{PRE} {top('ip', 10)}"
    q["s3_top_asns"] = f"{PRE}{RREP} {top('asn', 5, 'rr')}"
    q["s3_top_countries"] = f"{PRE}{RREP} {top('country', 5, 'rr')}"
    q["s3_top_paths"] = f"{PRE} {top('path', 10)}"
    EX = (f", ex AS (SELECT classification, {RAW} AS example, row_number() OVER (PARTITION BY classification"
          f" ORDER BY ip, ts, {RAW}) AS rn FROM req)")
    q["s4_examples"] = f"{PRE}{EX} SELECT classification, example FROM ex WHERE rn = 1"

    # One union of sections (section, rank, key, count, pct).
    def sect(section, key, count, pct="CAST(NULL AS DOUBLE)", rank="0", src=""):
        return (f"SELECT '{section}' AS section, CAST({rank} AS INTEGER) AS rank, CAST({key} AS VARCHAR) AS key,"
                f" CAST({count} AS BIGINT) AS count, round(CAST({pct} AS DOUBLE), 6) AS pct {src}")

    def ranked(section, key, k, src):
        return (f"SELECT '{section}' AS section, CAST(row_number() OVER (ORDER BY count DESC, {key}) AS INTEGER)"
                f" AS rank, CAST({key} AS VARCHAR) AS key, CAST(count AS BIGINT) AS count,"
                f" CAST(NULL AS DOUBLE) AS pct FROM ({top(key, k, src)}) t")
    att_names = ["potential_attacks", "sql_injection", "xss", "command_injection", "file_inclusion",
                 "path_traversal", "file_inclusion_or_traversal", "wordpress", "shell_upload"]
    parts = [
        sect("overview", "'total_requests'", "count(*)", src="FROM req"),
        sect("overview", "'start_time=' || CAST(min(ts) AS VARCHAR)", "NULL", rank="1", src="FROM req"),
        sect("overview", "'end_time=' || CAST(max(ts) AS VARCHAR)", "NULL", rank="2", src="FROM req"),
        ("SELECT 'classes' AS section, 0 AS rank, c.classification AS key, coalesce(cnt.k, 0) AS count,"
         " round(CASE WHEN tot.t > 0 THEN CAST(coalesce(cnt.k, 0) AS DOUBLE) * 100.0 / tot.t ELSE 0.0 END, 6)"
         " AS pct FROM c LEFT JOIN cnt ON c.classification = cnt.classification, tot"),
    ]
    for a in att_names:
        expr = "file_inclusion + path_traversal" if a == "file_inclusion_or_traversal" else a
        parts.append(sect("attacks", f"'{a}'", expr, src="FROM att"))
    parts += [ranked("top_ips", "ip", 10, "req"), ranked("top_asns", "asn", 5, "rr"),
              ranked("top_countries", "country", 5, "rr"), ranked("top_paths", "path", 10, "req")]
    parts.append("SELECT 'examples' AS section, 0 AS rank, classification || ': ' || example AS key,"
                 " CAST(NULL AS BIGINT) AS count, CAST(NULL AS DOUBLE) AS pct FROM ex WHERE rn = 1")
    q["r1_summary"] = (
        f"{PRE}{RREP}{ATT}{EX}, c AS (SELECT * FROM (VALUES {classes_vals}) t(classification)),"
        " cnt AS (SELECT classification, count(*) AS k FROM req GROUP BY 1), tot AS (SELECT count(*) AS t FROM req) "
        + " UNION ALL ".join(f"({p})" for p in parts))

    comp = ["legitimate_human_pct", "legitimate_bot_pct", "illegitimate_human_pct", "illegitimate_bot_pct"]
    series = ([("composition", c) for c in comp] + [("volume", "total_requests")]
              + [("stacked", c) for c in comp] + [("confidence", "avg_confidence")])
    q["r2_chart_series"] = (f"{PRE}{H}{HP} " + " UNION ALL ".join(
        f"SELECT '{ch}' AS chart, hour, '{s}' AS series, round(CAST({s} AS DOUBLE), 6) AS value FROM hp"
        for ch, s in series))
    ua_ser = [("modern_browser", "legitimate_human_pct"), ("known_bot", "legitimate_bot_pct"),
              ("old_browser", "illegitimate_human_pct * 0.7"), ("no_user_agent", "illegitimate_bot_pct * 0.3")]
    q["r3_ua_series"] = (f"{PRE}{H}{HP} " + " UNION ALL ".join(
        f"SELECT 'ua_composition' AS chart, hour, '{s}' AS series, round(CAST({e} AS DOUBLE), 6) AS value FROM hp"
        for s, e in ua_ser))
    q["r3_ua_series_measured"] = (
        f"{PRE}, u AS (SELECT date_trunc('hour', ts) AS hour, {T['ua_category']} AS series FROM req"
        " WHERE ts IS NOT NULL), g AS (SELECT hour, series, count(*) AS c FROM u GROUP BY 1, 2),"
        " t AS (SELECT hour, count(*) AS k FROM u GROUP BY 1)"
        " SELECT 'ua_composition_measured' AS chart, g.hour, series,"
        " round(CAST(c AS DOUBLE) * 100.0 / k, 6) AS value FROM g JOIN t ON g.hour = t.hour")

    # M6: request facts of profile T + label text.
    def fmt2(x: str) -> str:
        return f"printf('%.2f', CAST(round(CAST(CAST({x} AS DOUBLE) AS VARCHAR)::DECIMAL(38, 12), 2) AS DOUBLE))"
    rpm_t = ("CASE WHEN ipt2.nrows > 1 THEN CASE WHEN ipt2.span > 0 THEN ipt2.nrows / ipt2.span"
             " ELSE CAST(ipt2.nrows AS DOUBLE) END ELSE 1.0 END")
    facts = ("'Classify this web request.' || chr(10) || 'client: ' || wd.ip || ' (' || rep.country || ', '"
             " || rep.asn || ')' || chr(10) || 'request: ' || method || ' ' || path || ' ' || protocol || chr(10)"
             " || 'user agent: ' || user_agent || chr(10) || 'status: ' || CAST(status_code AS VARCHAR) || chr(10)"
             f" || 'rate: ' || {fmt2(rpm_t)} || ' per minute' || chr(10) || 'seconds since previous request: '"
             " || coalesce(CAST(td AS VARCHAR), 'N/A') || chr(10) || 'user agent kind: ' || "
             + T["ua_category"])
    label_txt = ("'Classification: ' || classification || chr(10) || 'Confidence: ' || "
                 f"{fmt2('confidence')} || chr(10) || 'Reasoning: '")
    # M1: labelling prompts over the whole enriched-T row (features composed from the pieces above).
    from ..functions.labels import LABEL_PROMPT_FIELDS, LABEL_PROMPT_HEADER
    rpm_t = "CASE WHEN nrows > 1 THEN CASE WHEN span > 0 THEN nrows / span ELSE CAST(nrows AS DOUBLE) END ELSE 1.0 END"
    feat = {
        "ip": "wd.ip", "timestamp": "ts", "method": "method", "path": "wd.path", "protocol": "protocol",
        "status_code": "status_code", "user_agent": "user_agent", "country": "rep.country", "asn": "rep.asn",
        "organization": "rep.organization", "ip_reputation_score": "rep.ip_score",
        "asn_reputation_score": "rep.asn_score_t",
        "combined_reputation_score": "CAST(rep.ip_score AS DOUBLE) * 0.7 + CAST(rep.asn_score_t AS DOUBLE) * 0.3",
        "ip_is_known_bad": "rep.known_bad",
        "is_high_risk_country": f"rep.country IN ({', '.join(repr(c) for c in fixed.T_HIGH_RISK_COUNTRIES)})",
        "is_high_risk_asn": "rep.asn_score_t > 50",
        "potential_dos": "dos.d_ip IS NOT NULL", "potential_scanner": "scan.s_ip IS NOT NULL",
        "during_traffic_spike": "spk.s_min IS NOT NULL", "from_coordinated_asn": "coord.c_asn IS NOT NULL",
        "to_high_error_path": "hep.h_path IS NOT NULL",
    }
    feat.update({f: T[f] for f in LABEL_PROMPT_FIELDS if f not in feat})
    # Java's %.2f rounds the shortest decimal form half-up; DECIMAL round does the same.
    rpm2 = (f"CASE WHEN abs({rpm_t}) < 0.001 THEN printf('%.2f', {rpm_t})"
            f" ELSE printf('%.2f', round(CAST(CAST({rpm_t} AS VARCHAR) AS DECIMAL(38, 12)), 2)) END")
    parts = [f"'{LABEL_PROMPT_HEADER}'", "'Facts:'"]
    parts += [f"'- {f}: ' || coalesce(CAST({feat[f]} AS VARCHAR), 'null')" for f in LABEL_PROMPT_FIELDS]
    parts += [f"'- requests_per_minute: ' || {rpm2}",
              "'- time_diff: ' || coalesce(CAST(td AS VARCHAR), 'N/A')"]
    enriched_ctes = (
        f"{PRE}{W1}{IPT}{REP},"
        f" dos AS (SELECT ip AS d_ip FROM wd GROUP BY ip HAVING (CASE WHEN {dur} > 0 THEN count(ts) / {dur}"
        " ELSE count(ts) END) > 30 AND avg(td) < 1.0 AND count(ts) > 50),"
        " scan AS (SELECT ip AS s_ip FROM req GROUP BY ip HAVING count(DISTINCT path) > 20 AND count(ts) > 30),"
        " pm AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS c FROM req WHERE ts IS NOT NULL GROUP BY 1),"
        " st AS (SELECT avg(c) AS mu, stddev_samp(c) AS sd FROM pm),"
        " spk AS (SELECT minute AS s_min FROM pm, st WHERE sd > 0 AND (c - mu) / sd > 3),"
        " ipc AS (SELECT r.ip, coalesce(b.asn, 'Unknown') AS asn, count(*) AS c FROM req r LEFT JOIN bl b"
        " ON r.ip = b.ip GROUP BY 1, 2),"
        " coord AS (SELECT asn AS c_asn FROM ipc GROUP BY asn HAVING sum(c) > 100 AND count(*) > 5"
        " AND stddev_samp(c) / avg(c) < 0.5),"
        " hep AS (SELECT path AS h_path FROM req WHERE status_code >= 500 GROUP BY path HAVING count(*) > 5)")
    enriched_from = (
        " FROM wd JOIN ipt2 ON wd.ip = ipt2.ip JOIN rep ON wd.ip = rep.ip"
        " LEFT JOIN dos ON wd.ip = dos.d_ip LEFT JOIN scan ON wd.ip = scan.s_ip"
        " LEFT JOIN spk ON date_trunc('minute', wd.ts) = spk.s_min LEFT JOIN coord ON rep.asn = coord.c_asn"
        " LEFT JOIN hep ON wd.path = hep.h_path")
    q["m1_prompts"] = f"{enriched_ctes} SELECT n, concat_ws(chr(10), {', '.join(parts)}) AS prompt{enriched_from}"
    # M2: the sampled rows with the labels of the default rules.
    from .label import BAD_SIGNALS, BOT_SIGNALS
    f = {k: f"coalesce({v}, FALSE)" for k, v in feat.items()}
    no_ua = f"(NOT {f['has_user_agent']})"
    signals = list(dict.fromkeys(BOT_SIGNALS + BAD_SIGNALS))
    bot = "(" + " OR ".join([f[k] for k in BOT_SIGNALS] + [no_ua]) + ")"
    bad = "(" + " OR ".join([f[k] for k in BAD_SIGNALS] + [f"({no_ua} AND coalesce(status_code >= 400, FALSE))"]) + ")"
    fired = [f"CASE WHEN {f[k]} THEN '{k}' END" for k in signals] + [f"CASE WHEN {no_ua} THEN 'no_user_agent' END"]
    n_fired = " + ".join([f"CAST({f[k]} AS INT)" for k in signals] + [f"CAST({no_ua} AS INT)"])
    q["m2_label"] = (
        f"{enriched_ctes} SELECT n, CASE WHEN {bad} AND {bot} THEN 'illegitimate_bot' WHEN {bad} THEN 'illegitimate_human'"
        f" WHEN {bot} THEN 'legitimate_bot' ELSE 'legitimate_human' END AS classification,"
        f" least(CAST(0.95 AS DOUBLE), CAST(0.6 AS DOUBLE) + CAST(0.1 AS DOUBLE) * ({n_fired})) AS confidence,"
        f" coalesce(nullif(concat_ws('; ', {', '.join(fired)}), ''), 'no risk indicator') AS reasoning"
        f" FROM (SELECT * FROM wd ORDER BY md5({key} || '42'), {RAW}, n LIMIT 1000) wd {enriched_from.replace('FROM wd', '', 1).lstrip()}")
    # M8/M9: what holds for any trained model.
    labelled = f"classification IN ({', '.join(repr(c) for c in fixed.CLASSES)})"
    q["m8_invariants"] = f"{PRE} SELECT count(*) FILTER (WHERE {labelled}) AS rows_used, TRUE AS finite_loss, TRUE AS accuracy_in_range FROM req"
    q["m9_invariants"] = f"{PRE} SELECT count(*) AS rows, TRUE AS known_classes, TRUE AS confidence_in_range, TRUE AS flags_follow FROM req"
    q["m6_training_text"] = (f"{PRE}{W1}{IPT}{REP} SELECT {facts} AS input, {label_txt} AS output"
                             " FROM wd JOIN ipt2 ON wd.ip = ipt2.ip JOIN rep ON wd.ip = rep.ip")

    # Streaming jobs: same results as their batch counterparts once all input is processed.
    q["st1_stream_parse"] = (
        f"{PRE} SELECT n, ip, ts AS \"timestamp\", path, status_code,"
        " coalesce(strpos(path, '?') > 0, FALSE) AS has_query_params, status_code >= 400 AS is_error FROM req")
    q["st2_stream_hourly"] = q["a16_hourly"]
    q["st3_stream_rate_alert"] = (f"{PRE} SELECT ip, date_trunc('minute', ts) AS minute, count(*) AS requests"
                                  " FROM req GROUP BY 1, 2 HAVING count(*) > 30")
    return q
