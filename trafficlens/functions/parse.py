"""Column expressions for parsing combined-format access-log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import ACCESS_LOG_REGEX, ACCESS_LOG_TIME_FORMAT


def strip_ws(c: Column) -> Column:
    """Strip leading/trailing whitespace of any kind (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


# One regex pass per line: a matching line (leading whitespace allowed, any
# trailing text) is rewritten to its 7 groups in an order in which each is ended
# by a character that it cannot hold (ip, status, size: a space; time: ']';
# request, referer: a quote), then cut.  A line that does not match is returned
# unchanged, and no match is (its second word would be '-').
_BODY = ACCESS_LOG_REGEX[1:]  # drop the leading '^'
_RECORD_REGEX = "(?s)^\\s*" + _BODY + ".*$"
_RECORD = '$1 $4 $5 $2]$3"$6"$7'


def log_record(value: Column) -> Column:
    """The rewritten line, or the line itself when it does not match."""
    return F.regexp_replace(value, F.lit(_RECORD_REGEX), F.lit(_RECORD))


def record_ok(value: Column, record: Column) -> Column:
    return F.coalesce(record != value, F.lit(False))


def log_fields(record: Column) -> dict[str, Column]:
    """The 7 log fields of a rewritten line (null on a line that did not match)."""
    head = F.split(record, " ", 4)
    tail = F.split(F.try_element_at(head, F.lit(4)), "]", 2)
    text = F.split(F.try_element_at(tail, F.lit(2)), '"', 3)
    get = lambda a, k: F.try_element_at(a, F.lit(k))
    return {"ip": get(head, 1), "status": get(head, 2), "size": get(head, 3), "time": get(tail, 1),
            "request": get(text, 1), "referer": get(text, 2), "user_agent": get(text, 3)}


def request_part(request: Column, i: int) -> Column:
    """i-th whitespace-separated part of the request line (1-based); missing -> ''."""
    parts = F.split(strip_ws(request), r"\s+")
    return F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))


def log_timestamp(text: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss Z`` -> TIMESTAMP (UTC instant); unparseable -> NULL."""
    return F.try_to_timestamp(text, F.lit(ACCESS_LOG_TIME_FORMAT))


def response_size(text: Column) -> Column:
    """Integer size; ``-`` or anything non-numeric -> 0."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))
