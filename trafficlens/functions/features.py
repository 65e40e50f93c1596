"""Row-local feature expressions (X1-X23) for the two enrichment profiles.

``T`` = training profile, ``S`` = serving profile.  Both produce columns of
the same names with different formulas; see the per-function docstrings.
Every flag is non-null (null inputs give false) except where noted.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .regex import contains_any, matches_any


def c(name: str) -> Column:
    return F.col(name)


# ---------------------------------------------------------------------------
# Request and time
# ---------------------------------------------------------------------------

def is_error() -> Column:
    return c("status_code") >= 400


def is_server_error() -> Column:
    return c("status_code") >= 500


def path_length() -> Column:
    return F.length("path")


def has_query_params() -> Column:
    return F.coalesce(c("path").contains("?"), F.lit(False))


def base_path(path: str = "path") -> Column:
    """Text before the first ``?``."""
    return F.coalesce(F.split(F.coalesce(c(path), F.lit("")), r"\?", 2)[0], F.lit(""))


def query_string(path: str = "path") -> Column:
    """Text after the first ``?`` ('' when none)."""
    return F.coalesce(F.try_element_at(F.split(F.coalesce(c(path), F.lit("")), r"\?", 2), F.lit(2)),
                      F.lit(""))


def calendar_columns(ts: str = "timestamp") -> dict[str, Column]:
    """Hour, weekday (Mon=0), weekend and business-hour flags as 0/1 ints."""
    h = F.hour(ts)
    dow = F.weekday(ts)
    return {
        "hour_of_day": h,
        "day_of_week": dow,
        "is_weekend": F.when(dow >= 5, 1).otherwise(0),
        "is_business_hours": F.when((h >= 9) & (h <= 17), 1).otherwise(0),
    }


def path_traversal(path: str = "path") -> Column:
    """``..``, ``%2e%2e``, ``/etc/``, ``/var/``, ``/bin/`` (case-insensitive)."""
    return matches_any(c(path), [fixed.PATH_TRAVERSAL_REGEX], ignore_case=True)


# ---------------------------------------------------------------------------
# Path and user-agent flags
# ---------------------------------------------------------------------------

def suspicious_path_T() -> Column:
    return matches_any(c("path"), [fixed.T_SUSPICIOUS_PATH_REGEX])


def suspicious_path_S() -> Column:
    return matches_any(c("path"), fixed.S_SUSPICIOUS_PATH_PATTERNS)


def has_user_agent_T() -> Column:
    """T: anything but ``-`` counts as present (null and '' too)."""
    return F.coalesce(c("user_agent") != "-", F.lit(True))


def has_user_agent_S() -> Column:
    ua = c("user_agent")
    return F.coalesce(ua.isNotNull() & (ua != "-") & (ua != ""), F.lit(False))


def ua_pattern_regex(entry: str) -> str:
    """A malicious-UA list entry as a regex: ``*`` is a wildcard, other text literal."""
    import re
    return ".*".join(re.escape(p) for p in entry.split("*"))


def malicious_ua_T(entries: Iterable[str], compat: bool = False) -> Column:
    """T: case-sensitive test of each list entry.  ``compat`` reproduces the
    reference's plain substring test of the entry with ``*`` turned into ``.*``
    (wildcard entries then never match)."""
    entries = list(entries)
    if compat:
        return contains_any(c("user_agent"), [e.replace("*", ".*") for e in entries])
    return matches_any(c("user_agent"), [ua_pattern_regex(e) for e in entries], ignore_case=False)


def malicious_ua_S(entries: Iterable[str]) -> Column:
    """S: case-insensitive search of each entry (``*`` wildcard)."""
    return matches_any(c("user_agent"), [ua_pattern_regex(e) for e in entries], ignore_case=True)


def old_browser_patterns(profile: str, preset: str = "reference") -> list[str]:
    """X8 pattern list: ``reference`` (as the reference, over-matching, Q9) or ``corrected``."""
    try:
        return fixed.OLD_BROWSER_PRESETS[profile][preset]
    except KeyError:
        raise ValueError(f"unknown old-browser preset {preset!r} for profile {profile!r}") from None


def ua_flags_T(malicious_entries: Iterable[str], compat: bool = False,
               old_browser: str = "reference") -> dict[str, Column]:
    ua = c("user_agent")
    has = has_user_agent_T()
    bot = matches_any(ua, [fixed.T_KNOWN_BOT_REGEX])
    common = matches_any(ua, [fixed.T_COMMON_BROWSER_REGEX])
    old = matches_any(ua, old_browser_patterns("train", old_browser))
    mal = malicious_ua_T(malicious_entries, compat)
    susp = (~has) | bot | (old & ~bot) | mal
    return {
        "has_user_agent": has,
        "is_known_bot": bot,
        "is_common_browser": common,
        "is_old_browser": old,
        "is_suspicious_user_agent": susp,
        "is_malicious_user_agent": mal,
    }


def ua_flags_S(malicious_entries: Iterable[str], old_browser: str = "reference") -> dict[str, Column]:
    ua = c("user_agent")
    return {
        "has_user_agent": has_user_agent_S(),
        "is_old_browser": matches_any(ua, old_browser_patterns("serve", old_browser), ignore_case=False),
        "is_known_bot": matches_any(ua, fixed.S_KNOWN_BOT_PATTERNS),
        "is_suspicious_user_agent": matches_any(ua, fixed.S_SUSPICIOUS_UA_PATTERNS),
        "is_malicious_user_agent": malicious_ua_S(malicious_entries),
    }


def ua_category(has: str = "has_user_agent", old: str = "is_old_browser",
                bot: str = "is_known_bot") -> Column:
    """X23: 'No user agent' > 'Old browser' > 'Known bot' > 'Modern browser'."""
    return (F.when(~c(has), "No user agent").when(c(old), "Old browser")
             .when(c(bot), "Known bot").otherwise("Modern browser"))


# ---------------------------------------------------------------------------
# Threat-pattern flags
# ---------------------------------------------------------------------------

T_FIELD_FLAGS = ["path_matches", "query_matches", "ua_matches", "referrer_matches"]
T_FAMILY_FLAGS = {
    "sql_injection_matches": "sql_injection",
    "xss_matches": "xss",
    "cmd_injection_matches": "command_injection",
    "file_inclusion_matches": "file_inclusion",
    "wordpress_matches": "wordpress",
    "shell_upload_matches": "shell_upload",
    "malicious_ext_matches": "malicious_file_ext",
}
MATCH_FLAGS = T_FIELD_FLAGS + list(T_FAMILY_FLAGS)


def path_pattern_flags_T(lib: Mapping[str, list[str]]) -> dict[str, Column]:
    """T flags that depend on the path only (computed once per distinct path)."""
    path = c("path")
    out = {
        "path_matches": matches_any(path, lib.get("request_uri", [])),
        "query_matches": F.when(has_query_params(),
                                matches_any(query_string(), lib.get("query_string", [])))
                          .otherwise(F.lit(False)),
    }
    for flag, cat in T_FAMILY_FLAGS.items():
        out[flag] = matches_any(path, lib.get(cat, []))
    return out


def path_pattern_texts_T(lib: Mapping[str, list[str]]) -> dict[str, tuple[Column, list[str]]]:
    """The same flags as (text, patterns), for an index over a large library."""
    path = c("path")
    return {"path_matches": (path, lib.get("request_uri", [])),
            "query_matches": (F.when(has_query_params(), query_string()), lib.get("query_string", [])),
            **{flag: (path, lib.get(cat, [])) for flag, cat in T_FAMILY_FLAGS.items()}}


def ua_pattern_flags_T(lib: Mapping[str, list[str]]) -> dict[str, Column]:
    return {"ua_matches": matches_any(c("user_agent"), lib.get("user_agent", []))}


def referer_pattern_flags_T(lib: Mapping[str, list[str]]) -> dict[str, Column]:
    ref = c("referer")
    return {"referrer_matches": F.when(ref != "-", matches_any(ref, lib.get("referrer", [])))
                                 .otherwise(F.lit(False))}


def any_of(cols: Iterable[str]) -> Column:
    e = None
    for n in cols:
        e = c(n) if e is None else (e | c(n))
    return e if e is not None else F.lit(False)


def family_hits_S(field: Column, families: Mapping[str, list[str]] | None = None) -> dict[str, Column]:
    """S: one boolean per family for one field ('' never matches anything here)."""
    families = families or fixed.S_FAMILIES
    nonempty = F.coalesce(field != "", F.lit(False))
    return {fam: nonempty & matches_any(field, pats) for fam, pats in families.items()}


def likely_malicious_human_T() -> Column:
    return c("has_malicious_pattern") & ~c("is_known_bot") & (
        c("is_suspicious_user_agent") | c("is_malicious_user_agent"))


def likely_malicious_human_S() -> Column:
    return (c("has_malicious_pattern") & ~c("is_known_bot")
            & F.coalesce(c("requests_per_minute") < 30, F.lit(False))
            & (c("sql_injection_matches") | c("xss_matches") | c("cmd_injection_matches")
               | c("file_inclusion_matches") | c("shell_upload_matches")))


# ---------------------------------------------------------------------------
# Reputation-derived
# ---------------------------------------------------------------------------

def reputation_flags(countries: list[str], flagged_asn: str | None) -> dict[str, Column]:
    out = {}
    if flagged_asn is not None:
        out["is_hostroyale_asn"] = F.coalesce(c("asn").contains(flagged_asn), F.lit(False))
    out["is_high_risk_country"] = F.coalesce(c("country").isin(countries), F.lit(False))
    out["is_high_risk_asn"] = F.coalesce(c("asn_reputation_score") > 50, F.lit(False))
    out["combined_reputation_score"] = (
        (c("ip_reputation_score") * fixed.IP_REPUTATION_WEIGHT) + (c("asn_reputation_score") * fixed.ASN_REPUTATION_WEIGHT))
    return out
