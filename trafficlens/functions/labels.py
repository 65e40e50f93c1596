"""Class-text flags (M5), answer parsing (M3, M4) and prompt / training text (M1, M6, M7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed
from .fixed import UNKNOWN_CLASS


def is_legitimate(cls: str = "classification", compat: bool = False) -> Column:
    """M5.  Default: the class starts with 'legitimate' (case-insensitive).
    ``compat``: the reference's substring test, true for all four classes (Q2)."""
    c = F.lower(F.col(cls))
    e = c.contains("legitimate") if compat else c.startswith("legitimate")
    return F.coalesce(e, F.lit(False))


def is_human(cls: str = "classification") -> Column:
    return F.coalesce(F.lower(F.col(cls)).contains("human"), F.lit(False))


LABEL_SCHEMA = T.StructType([
    T.StructField("classification", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("reasoning", T.StringType()),
])


def parse_label_answer(text: Column) -> Column:
    """M3: free-text answer of a labeller -> struct(classification, confidence, reasoning).

    Order: a fenced ```json {...}``` block (up to the first ``}`` before the
    fence's end), else the span from the first ``{`` to the last ``}``, else the
    three quoted fields (classification and confidence required), else unknown /
    0.0 / ''.  Once a block is found nothing else is tried: one that is not a
    JSON object is unknown, and a field that it lacks takes its default.
    """
    fenced = F.regexp_extract(text, fixed.LABEL_FENCE_REGEX, 1)
    braces = F.regexp_extract(text, fixed.LABEL_BRACES_REGEX, 1)
    block = F.when(fenced != "", fenced).when(braces != "", braces)
    # inside an array, what follows a first object is an error, too
    found = F.from_json(F.concat(F.lit("["), block, F.lit("]")), T.ArrayType(LABEL_SCHEMA))
    js = F.when(F.size(found) == 1, F.get(found, F.lit(0)))
    cls = F.regexp_extract(text, fixed.LABEL_CLASSIFICATION_REGEX, 1)
    conf = F.regexp_extract(text, fixed.LABEL_CONFIDENCE_REGEX, 1).try_cast("double")
    rsn = F.regexp_extract(text, fixed.LABEL_REASONING_REGEX, 1)
    loose = F.when((cls != "") & conf.isNotNull(), F.struct(
        cls.alias("classification"), conf.alias("confidence"),
        F.when(rsn != "", rsn).otherwise(F.lit(fixed.NO_REASONING)).alias("reasoning")))

    def field(name, default):
        return F.coalesce(F.when(block.isNotNull(), js[name]).otherwise(loose[name]), F.lit(default)).alias(name)

    return F.struct(field("classification", UNKNOWN_CLASS), field("confidence", 0.0), field("reasoning", ""))


def parse_generated_answer(text: Column) -> Column:
    """M4: ``Classification: x / Confidence: n / Reasoning: ...`` -> struct with flags.

    Missing fields default to unknown / 0.0 / 'No reasoning provided'; a
    confidence that is not a number gives the error defaults.
    """
    cls_raw = F.regexp_extract(text, fixed.ANSWER_CLASSIFICATION_REGEX, 1)
    conf_txt = F.regexp_extract(text, fixed.ANSWER_CONFIDENCE_REGEX, 1)
    conf = conf_txt.try_cast("double")
    rsn = F.regexp_extract(text, fixed.ANSWER_REASONING_REGEX, 1)
    bad = (conf_txt != "") & conf.isNull()
    cls = F.when(bad, F.lit(UNKNOWN_CLASS)).when(cls_raw != "", cls_raw).otherwise(F.lit(UNKNOWN_CLASS))
    confidence = F.when(bad, F.lit(0.0)).otherwise(F.coalesce(conf, F.lit(0.0)))
    reasoning = (F.when(bad, F.lit(fixed.ANSWER_ERROR))
                  .when(rsn != "", F.trim(rsn)).otherwise(F.lit(fixed.NO_REASONING)))
    lc = F.lower(cls)
    return F.struct(
        cls.alias("classification"), confidence.alias("confidence"), reasoning.alias("reasoning"),
        (~bad & lc.startswith("legitimate")).alias("is_legitimate"),
        (~bad & lc.contains("human")).alias("is_human"),
    )


def _num_or_na(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("N/A"))


def _text(c: str, default: str = "Unknown") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(default))


def request_facts(ua_cat: Column) -> Column:
    """M6/M7 short form: the request facts a classifier sees, one per line (absent values print a default)."""
    return F.concat_ws(
        "\n",
        F.lit("Classify this web request."),
        F.concat(F.lit("client: "), _text("ip"), F.lit(" ("), _text("country"), F.lit(", "), _text("asn"), F.lit(")")),
        F.concat(F.lit("request: "), _text("method"), F.lit(" "), _text("path"), F.lit(" "), _text("protocol")),
        F.concat(F.lit("user agent: "), _text("user_agent")),
        F.concat(F.lit("status: "), _text("status_code")),
        F.concat(F.lit("rate: "), F.format_string("%.2f", F.coalesce("requests_per_minute", F.lit(0.0))), F.lit(" per minute")),
        F.concat(F.lit("seconds since previous request: "), _num_or_na("time_diff")),
        F.concat(F.lit("user agent kind: "), F.coalesce(ua_cat, F.lit("No user agent"))),
    )


SERVING_PROMPT_SECTIONS = {
    "reputation": ["ip_reputation_score", "asn_reputation_score", "ip_is_known_bad", "is_high_risk_country", "is_high_risk_asn"],
    "user agent": ["has_user_agent", "is_known_bot", "is_old_browser", "is_suspicious_user_agent", "is_malicious_user_agent"],
    "attack signs": ["has_malicious_pattern", "sql_injection_matches", "xss_matches", "cmd_injection_matches",
                     "file_inclusion_matches", "wordpress_matches", "shell_upload_matches"],
    "traffic": ["potential_dos", "potential_scanner", "during_traffic_spike", "from_coordinated_asn"],
}


def serving_prompt(columns: list[str]) -> Column:
    """M7 full form over a table with ``columns``: the request, then every indicator by section.

    Absent columns and null values print a default: ``Unknown`` for texts, 0 for
    scores and the rate, ``N/A`` for the gap, ``false`` for flags.
    """
    have = set(columns)
    text = lambda c: _text(c) if c in have else F.lit("Unknown")
    rate = F.coalesce(F.col("requests_per_minute"), F.lit(0.0)) if "requests_per_minute" in have else F.lit(0.0)
    parts = [
        F.lit("Classify this web request."),
        F.concat(F.lit("client: "), text("ip"), F.lit(" ("), text("country"), F.lit(", "), text("asn"), F.lit(")")),
        F.concat(F.lit("request: "), text("method"), F.lit(" "), text("path"), F.lit(" "), text("protocol")),
        F.concat(F.lit("user agent: "), text("user_agent")),
        F.concat(F.lit("status: "), text("status_code")),
        F.concat(F.lit("rate: "), F.format_string("%.2f", rate), F.lit(" per minute")),
        F.concat(F.lit("seconds since previous request: "), _num_or_na("time_diff") if "time_diff" in have else F.lit("N/A")),
    ]
    for section, fields in SERVING_PROMPT_SECTIONS.items():
        parts.append(F.lit(f"{section}:"))
        for f in fields:
            default = "0" if f.endswith("_score") else "false"
            parts.append(F.concat(F.lit(f"- {f}: "), _text(f, default) if f in have else F.lit(default)))
    return F.concat_ws("\n", *parts)


def label_text(cls: str = "classification", conf: str = "confidence", rsn: str = "reasoning") -> Column:
    """M6 output side: class, confidence with two decimals, reasoning."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Classification: "), F.col(cls)),
        F.concat(F.lit("Confidence: "), F.format_string("%.2f", F.col(conf))),
        F.concat(F.lit("Reasoning: "), F.coalesce(F.col(rsn), F.lit(""))),
    )


LABEL_PROMPT_FIELDS = [
    "ip", "timestamp", "method", "path", "protocol", "status_code", "user_agent", "country", "asn",
    "organization", "ip_reputation_score", "asn_reputation_score", "combined_reputation_score",
    "ip_is_known_bad", "is_high_risk_country", "is_high_risk_asn", "potential_dos", "potential_scanner",
    "during_traffic_spike", "from_coordinated_asn", "to_high_error_path", "has_suspicious_patterns",
    "has_user_agent", "is_known_bot", "is_old_browser", "is_suspicious_user_agent",
    "is_malicious_user_agent", "has_malicious_pattern", "path_matches", "query_matches", "ua_matches",
    "referrer_matches", "sql_injection_matches", "xss_matches", "cmd_injection_matches",
    "file_inclusion_matches", "wordpress_matches", "shell_upload_matches", "malicious_ext_matches",
    "likely_malicious_human",
]


LABEL_PROMPT_HEADER = ("Label this web server request as one of legitimate_human, legitimate_bot, "
                       "illegitimate_human, illegitimate_bot. Answer with JSON "
                       '{"classification": ..., "confidence": 0.0-1.0, "reasoning": ...}.')


def labelling_prompt(fields: list[str] | None = None) -> Column:
    """M1: a labelling prompt per row (own wording), listing every enriched field.

    ``time_diff`` prints 'N/A' when null; the rate prints with two decimals.
    """
    fields = fields or LABEL_PROMPT_FIELDS
    parts = [F.lit(LABEL_PROMPT_HEADER), F.lit("Facts:")]
    for f in fields:
        parts.append(F.concat(F.lit(f"- {f}: "), F.coalesce(F.col(f).cast("string"), F.lit("null"))))
    parts.append(F.concat(F.lit("- requests_per_minute: "), F.format_string("%.2f", F.col("requests_per_minute"))))
    parts.append(F.concat(F.lit("- time_diff: "), _num_or_na("time_diff")))
    return F.concat_ws("\n", *parts)
