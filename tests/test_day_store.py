"""Per-day partials: combined results, replacement of single days, mergeable moments."""

import os
import random
import statistics

from pyspark.sql import functions as F

from trafficlens.operators import moments as MO
from trafficlens.operators import summary as SM
from trafficlens.operators import traffic as TR
from trafficlens.operators.parse import parse_access_log
from trafficlens.plans import catalog as C
from trafficlens.plans import catalog_state as CS
from trafficlens.plans import day_store as DS

from conftest import SF_SMALL, rows
from test_event_time import log_lines


def test_merged_moments(spark):
    rng = random.Random(2)
    data = [(g, p, rng.gauss(1e6 * g, 3)) for g in range(4) for p in range(6) for _ in range(rng.randrange(1, 9))] + [(9, 0, None), (8, 0, 5.0)]
    df = spark.createDataFrame(data, "g int, p int, x double")
    parts = MO.moments(df, ["g", "p"], "x")
    got = parts.groupBy("g").agg(MO.merged().alias("m")).select("g", "m.*").withColumn("sd", MO.std_samp())
    for r in got.collect():
        x = [v for g, _, v in data if g == r.g and v is not None]
        assert r.n == len(x) and (r.mean is None) == (not x)
        if len(x) > 1:
            assert abs(r.mean - statistics.fmean(x)) < 1e-6 and abs(r.sd - statistics.stdev(x)) < 1e-6
        else:
            assert r.sd is None


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all((p is None and q is None) or p == q or (isinstance(p, float) and abs(p - q) <= 1e-6 * max(1, abs(q))) for p, q in zip(x, y)), (x, y)


def test_combined_days_equal_the_whole_input(spark):
    base, p = CS.day_store(spark, SF_SMALL), C.parsed(spark, SF_SMALL)
    close(rows(DS.ip_counts(spark, base), "ip", "request_count"), rows(TR.ip_counts(p), "ip", "request_count"))
    want = TR.ip_stats_full(TR.add_time_diff(p, tiebreak=C.TIE))
    close(rows(DS.ip_stats(spark, base), *want.columns), rows(want, *want.columns))
    close(rows(DS.spike_minutes(spark, base)), rows(TR.spike_minutes_train(p)))
    hourly = SM.hourly_counts(C.classified(spark, SF_SMALL))
    close(rows(DS.hourly_counts(spark, base), *hourly.columns), rows(hourly, *hourly.columns))
    close(rows(DS.distinct_ips(spark, base)), rows(SM.distinct_ips(p)))


def test_rows_without_a_time_and_clients_of_one_row(spark, tmp_path):
    t = lambda d, s: f"{d:02d}/Jan/2024:12:00:{s:02d} +0000"
    data = [(1, "10.0.0.1", t(3, 1)), (2, "10.0.0.1", "none"), (3, "10.0.0.1", t(5, 4)), (4, "10.0.0.1", t(5, 4)), (5, "10.0.0.1", t(9, 0)),
            (6, "10.0.0.2", "none"), (7, "10.0.0.3", t(4, 4))]
    p = parse_access_log(log_lines(spark, data))
    DS.write_days(p, str(tmp_path / "s"), tiebreak=["n"])
    want = TR.ip_stats_full(TR.add_time_diff(p, tiebreak=["n"]))
    close(rows(DS.ip_stats(spark, str(tmp_path / "s")), *want.columns), rows(want, *want.columns))
    want = TR.ip_stats_train(p).select("ip", "request_count_per_ip", "requests_per_minute")
    close(rows(DS.rate_train(spark, str(tmp_path / "s"))), rows(want))


def test_a_day_written_again_changes_that_day_only(spark, tmp_path):
    base = str(tmp_path / "s")
    p = C.parsed(spark, SF_SMALL)
    DS.write_days(p, base, tiebreak=C.TIE)
    files = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")}
    before = files()
    one = p.where("to_date(timestamp) = date'2024-01-20'")
    DS.write_days(one.where("n % 2 = 0"), base, tiebreak=C.TIE)  # a correction: half of the rows
    after = files()
    changed = {f for f in before | after if before.get(f) != after.get(f)}
    assert changed and all("day=2024-01-20" in f for f in changed)
    rest = p.where(F.coalesce(F.to_date("timestamp") != F.lit("2024-01-20"), F.lit(True)) | (F.col("n") % 2 == 0))
    assert rows(DS.ip_counts(spark, base), "ip", "request_count") == rows(TR.ip_counts(rest), "ip", "request_count")
