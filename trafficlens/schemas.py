"""Explicit schemas of the stage tables (no inference between stages)."""

from pyspark.sql import types as T

PARSED = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("method", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("response_size", T.LongType()),
    T.StructField("referer", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("raw_log", T.StringType()),
])
PARSED_COLUMNS = [f.name for f in PARSED.fields]

# Columns of the log reader that together give file order (Q18): the file, the
# start of its split, the position within the split.  Requests with equal
# (ip, timestamp) keep this order in the lag.
FILE_ORDER = ["source_file", "block_start", "line_id"]

TRAINING_EXAMPLE = T.StructType([
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
])

HOURLY_COUNT_COLUMNS = [
    "total_requests", "legitimate_requests", "illegitimate_requests", "human_requests",
    "bot_requests", "legitimate_human_requests", "legitimate_bot_requests",
    "illegitimate_human_requests", "illegitimate_bot_requests",
]
HOURLY_PCT_COLUMNS = [
    "legitimate_pct", "illegitimate_pct", "human_pct", "bot_pct",
    "legitimate_human_pct", "legitimate_bot_pct", "illegitimate_human_pct", "illegitimate_bot_pct",
]
HOURLY = T.StructType(
    [T.StructField("hour", T.TimestampType())]
    + [T.StructField(c, T.LongType()) for c in HOURLY_COUNT_COLUMNS]
    + [T.StructField("avg_confidence", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in HOURLY_PCT_COLUMNS]
)
