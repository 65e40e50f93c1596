"""W1 and per-IP / global detectors on small frames, plus partition invariance."""

from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from trafficlens.operators import traffic as TR

T0 = datetime(2024, 1, 15, 12, 0, 0)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "n bigint, ip string, timestamp timestamp, path string, status_code int")


def _plain_lag(df):
    w = Window.partitionBy("ip").orderBy(F.col("timestamp").asc_nulls_last(), "n")
    return df.withColumn("prev_timestamp", F.lag("timestamp").over(w))


def test_time_diff_cases(spark):
    rows = [
        (1, "a", T0, "/", 200),                            # only row of a -> null
        (2, "b", T0, "/", 200),
        (3, "b", T0, "/", 200),                            # equal timestamps -> 0.0
        (4, "b", T0 + timedelta(seconds=90), "/", 200),    # next minute bucket: stitched
        (5, "b", None, "/", 200),                          # null ts -> null diff
        (6, "b", T0 + timedelta(hours=3), "/", 200),       # empty buckets in between
    ]
    got = {r.n: r for r in TR.add_time_diff(_frame(spark, rows), tiebreak=["n"]).collect()}
    assert got[1].time_diff is None and got[1].prev_timestamp is None
    assert got[2].time_diff is None
    assert got[3].time_diff == 0.0
    assert got[4].time_diff == 90.0
    assert got[6].time_diff == 3 * 3600 - 90.0
    assert got[5].time_diff is None
    # lag of a null-ts row (sorted last) is the IP's last timestamp
    assert got[5].prev_timestamp == T0 + timedelta(hours=3)


def test_time_diff_equals_plain_lag_on_hot_ip(spark):
    # one hot IP holding most rows, spread over many minute buckets, plus cold IPs
    rows = [(i, "hot" if i % 3 else f"c{i % 7}", T0 + timedelta(seconds=(i * 17) % 5000), "/", 200)
            for i in range(3000)]
    df = _frame(spark, rows)
    b = {r.n: r.prev_timestamp for r in _plain_lag(df).collect()}
    for bucket in ("second", "minute", "hour"):
        a = {r.n: r.prev_timestamp for r in TR.add_time_diff(df, tiebreak=["n"], bucket=bucket).collect()}
        assert a == b, bucket


def test_rate_train_cases(spark):
    rows = [(1, "one", T0, "/", 200),
            (2, "same", T0, "/", 200), (3, "same", T0, "/", 200),
            (4, "span", T0, "/", 200), (5, "span", T0 + timedelta(minutes=2), "/", 200),
            (6, "span", T0 + timedelta(minutes=4), "/", 200)]
    got = {r.ip: r.requests_per_minute for r in TR.ip_stats_train(_frame(spark, rows)).collect()}
    assert got == {"one": 1.0, "same": 2.0, "span": 0.75}


def test_spike_minutes_train(spark):
    # 30 quiet minutes with 1 request, one minute with 40: z > 3 only there
    rows = [(i, "x", T0 + timedelta(minutes=i), "/", 200) for i in range(30)]
    rows += [(100 + i, "y", T0 + timedelta(minutes=50, seconds=i), "/", 200) for i in range(40)]
    got = [r.minute for r in TR.spike_minutes_train(_frame(spark, rows)).collect()]
    assert got == [T0 + timedelta(minutes=50)]
    # a single active minute: std undefined -> no spike
    one = _frame(spark, [(1, "x", T0, "/", 200), (2, "x", T0, "/", 200)])
    assert TR.spike_minutes_train(one).count() == 0


def test_high_error_paths(spark):
    rows = [(i, "x", T0, "/bad", 500) for i in range(6)] + [(10 + i, "x", T0, "/ok", 503) for i in range(5)] \
        + [(20 + i, "x", T0, "/nf", 404) for i in range(6)]
    df = _frame(spark, rows)
    assert [r.path for r in TR.high_error_paths(df, 500).collect()] == ["/bad"]
    assert sorted(r.path for r in TR.high_error_paths(df, 400).collect()) == ["/bad", "/nf"]  # /ok has exactly 5, not more


def test_serve_rate_and_threshold(spark):
    # ip p: 3 requests in one minute and 1 in another -> mean 2.0; ip q: 1 request -> 1.0
    rows = [(1, "p", T0, "/", 200), (2, "p", T0, "/", 200), (3, "p", T0, "/", 200),
            (4, "p", T0 + timedelta(minutes=5), "/", 200), (5, "q", T0, "/", 200)]
    rate = TR.ip_rate_serve(_frame(spark, rows))
    got = {r.ip: (r.requests_per_minute, r.ip_rows) for r in rate.collect()}
    assert got == {"p": (2.0, 4), "q": (1.0, 1)}
    # over rows: values 2,2,2,2,1 -> mean 1.8, std_samp sqrt(0.2)
    thr = rate.select(TR.spike_threshold_serve(rate).alias("t")).first().t
    assert abs(thr - (1.8 + 2 * 0.2 ** 0.5)) < 1e-12


def test_partition_invariance(spark):
    rows = [(i, f"ip{i % 11}", T0 + timedelta(seconds=(i * 7) % 900), f"/p{i % 5}", 200 + (i % 4) * 100)
            for i in range(500)]
    df = _frame(spark, rows)

    def run(d):
        out = TR.add_time_diff(d, tiebreak=["n"])
        return sorted((r.n, r.time_diff) for r in out.collect()), \
            sorted(tuple(r) for r in TR.ip_stats_train(d).collect())

    assert run(df.repartition(1)) == run(df.repartition(16))


def test_enrichment_partition_invariance(spark):
    from trafficlens.plans import catalog as C
    from trafficlens.plans import enrich as EN
    from conftest import SF_SMALL

    parsed = C.parsed(spark, SF_SMALL)
    bl = C.blocklist(spark)
    for fn, cols in ((EN.enrich_train, EN.T_FEATURES), (EN.enrich_serve, EN.S_FEATURES)):
        def run(d):
            out = fn(d, bl, tiebreak=C.TIE).select("n", *cols)
            return sorted(tuple(r) for r in out.collect())
        assert run(parsed.repartition(1)) == run(parsed.repartition(16))


def test_enrichment_large_key_fallback(spark):
    """With no broadcast allowed, key features run inline / as shuffle joins: same rows."""
    from trafficlens.plans import catalog as C
    from trafficlens.plans import enrich as EN
    from conftest import SF_SMALL

    parsed = C.parsed(spark, SF_SMALL)
    bl = C.blocklist(spark)
    for fn, cols in ((EN.enrich_train, EN.T_FEATURES), (EN.enrich_serve, EN.S_FEATURES)):
        def run(**kw):
            out = fn(parsed, bl, tiebreak=C.TIE, **kw).select("n", *cols)
            return sorted(tuple(r) for r in out.collect())
        base = run()
        assert base == run(max_broadcast_rows=0)
        assert base == run(lag_bucket="second")


def test_enrichment_scope_equals_per_scope_runs(spark):
    """Q1 scope: statistics bounded by a day column equal enriching each day on its own."""
    from trafficlens.plans import catalog as C
    from trafficlens.plans import enrich as EN
    from conftest import SF_MID

    days = ["2024-01-14", "2024-01-15", "2024-01-16"]   # 2024-01-15 holds the DoS client
    parsed = C.parsed(spark, SF_MID).withColumn("day", F.to_date("timestamp").cast("string"))
    parsed = parsed.where(F.col("day").isin(days)).cache()
    bl = C.blocklist(spark)

    def norm(df, cols):
        out = df.select("n", *cols)
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in out.collect())

    for fn, cols in ((EN.enrich_train, EN.T_FEATURES), (EN.enrich_serve, EN.S_FEATURES)):
        want = []
        for d in days:
            want += norm(fn(parsed.where(F.col("day") == d), bl, tiebreak=C.TIE), cols)
        want.sort()
        assert norm(fn(parsed, bl, tiebreak=C.TIE, scope=["day"]), cols) == want
        assert norm(fn(parsed, bl, tiebreak=C.TIE, scope=["day"], max_broadcast_rows=0), cols) == want
        # Whole-input statistics differ from per-day ones on this input.
        assert norm(fn(parsed, bl, tiebreak=C.TIE), cols) != want


def test_referer_flags_per_key_table(spark):
    """Referer flags come from the per-referer table (broadcast) or inline (no broadcast): same flags."""
    from trafficlens.operators.parse import parse_access_log
    from trafficlens.plans import enrich as EN
    from trafficlens.sources.access_log import lines_from_text
    from trafficlens.sources.reputation_lists import blocklist_from_lines

    def line(i, ref):
        return f'10.0.0.{i} - - [15/Jan/2024:12:00:0{i} +0000] "GET /p HTTP/1.1" 200 10 "{ref}" "Mozilla/5.0"'

    refs = ["-", "http://semalt.com/x", "http://ok.example/<script>alert(1)</script>", "http://ok.example/"]
    parsed = parse_access_log(lines_from_text(spark, "\n".join(line(i, r) for i, r in enumerate(refs))))
    bl = blocklist_from_lines(spark.createDataFrame([], "value string, line_no bigint"))
    for mb in (2_000_000, 0):
        t = {r.referer: r for r in EN.enrich_train(parsed, bl, max_broadcast_rows=mb).collect()}
        assert [t[r].referrer_matches for r in refs] == [False, True, False, False]
        s = {r.referer: r for r in EN.enrich_serve(parsed, bl, max_broadcast_rows=mb).collect()}
        assert [s[r].referrer_matches for r in refs] == [False, False, True, False]
        assert [s[r].xss_matches for r in refs] == [False, False, True, False]
