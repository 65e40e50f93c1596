"""Parse, reject, count and filter access-log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import parse as pf
from ..functions.fixed import REDIRECT_STATUS_CODES
from ..functions.once import with_once


def _split(lines: DataFrame, value_col: str) -> DataFrame:
    v = F.col(value_col)
    d = with_once(lines, _f=pf.log_record(v))
    return d.withColumn("_ok", pf.record_ok(v, F.col("_f")))


def _is_redirect(status):
    # a status beyond the integer range is null and no redirect
    return F.coalesce(status.isin(REDIRECT_STATUS_CODES), F.lit(False))


def _counters() -> list:
    """The aggregates of P9 over split lines."""
    redirect = F.col("_ok") & _is_redirect(pf.log_fields(F.col("_f"))["status"].try_cast("int"))
    return [
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(F.col("_ok") & ~redirect).alias("parsed"),
        F.count_if(redirect).alias("skipped_redirects"),
        F.count_if(~F.col("_ok")).alias("unparsed"),
    ]


def parse_access_log(lines: DataFrame, value_col: str = "value", drop_redirects: bool = True,
                     observation: Observation | None = None) -> DataFrame:
    """Lines -> parsed table (10 typed columns + pass-through columns of ``lines``).

    Unmatched lines are dropped (see :func:`parse_rejects`); every matching line is
    kept, whatever characters it holds (a status beyond the integer range is
    null).  ``drop_redirects``
    removes 301-308 as the file route of the reference does; log content given
    as a string keeps them (``drop_redirects=False``).  ``observation`` receives the
    P9 counters of the action that first runs the result.
    """
    d = _split(lines, value_col)
    if observation is not None:
        d = d.observe(observation, *_counters())
    d = d.where("_ok")
    f = pf.log_fields(F.col("_f"))
    request = f["request"]
    parsed = {
        "ip": f["ip"],
        "timestamp": pf.log_timestamp(f["time"]),
        "method": pf.request_part(request, 1),
        "path": pf.request_part(request, 2),
        "protocol": pf.request_part(request, 3),
        "status_code": f["status"].try_cast("int"),
        "response_size": pf.response_size(f["size"]),
        "referer": f["referer"],
        "user_agent": f["user_agent"],
        "raw_log": pf.strip_ws(F.col(value_col)),
    }
    passthrough = [c for c in lines.columns if c != value_col and c not in parsed]
    out = d.select(*[v.alias(k) for k, v in parsed.items()], *passthrough)
    if drop_redirects:
        out = out.where(~_is_redirect(F.col("status_code")))
    return out


def parse_rejects(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines the log regex does not match (P7), with their pass-through columns."""
    d = _split(lines, value_col).where(~F.col("_ok"))
    return d.drop("_ok", "_f").withColumn("stripped_line", pf.strip_ws(F.col(value_col)))


def parse_counters(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row: total lines, parsed rows kept, redirects skipped, unparseable."""
    return _split(lines, value_col).agg(*_counters())


def drop_redirects(df: DataFrame) -> DataFrame:
    """P8 as a stand-alone filter."""
    return df.where(~_is_redirect(F.col("status_code")))


def filter_status(df: DataFrame, whitelist: str | None = None, blacklist: str | None = None) -> DataFrame:
    """P10: keep status codes whose text starts with a match of ``whitelist``, or drop
    those matching ``blacklist``.  The whitelist wins when both are given."""
    s = F.col("status_code").cast("string")
    if whitelist:
        return df.where(F.coalesce(s.rlike(f"^(?:{whitelist})"), F.lit(False)))
    if blacklist:
        return df.where(~F.coalesce(s.rlike(f"^(?:{blacklist})"), F.lit(False)))
    return df
