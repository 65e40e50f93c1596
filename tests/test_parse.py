"""P1-P10, IO1, IO2: hand-written log lines with the expected rows stated here."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from trafficlens.operators import parse as PO
from trafficlens.sources.access_log import lines_from_text, read_access_logs

UA = "Mozilla/5.0 (X11; Linux x86_64)"
LINES = [
    # 0 good, with leading whitespace (stripped like Python's str.strip)
    f'  1.2.3.4 - - [15/Jan/2024:12:00:00 +0000] "GET /index.html HTTP/1.1" 200 512 "-" "{UA}"',
    # 1 size '-' -> 0
    '1.2.3.4 - - [15/Jan/2024:12:00:05 +0000] "GET /missing HTTP/1.1" 404 - "-" "curl/8.0"',
    # 2 ident not '-' -> reject
    '1.2.3.4 alice - [15/Jan/2024:12:00:06 +0000] "GET / HTTP/1.1" 200 1 "-" "x"',
    # 3 IPv6 -> reject
    '::1 - - [15/Jan/2024:12:00:07 +0000] "GET / HTTP/1.1" 200 1 "-" "x"',
    # 4 bad date -> null timestamp, row kept
    '5.6.7.8 - - [99/Foo/2024:12:00:00 +0000] "GET /a HTTP/1.1" 200 10 "-" "x"',
    # 5 request with the method only -> path and protocol ''
    '5.6.7.8 - - [15/Jan/2024:12:01:00 +0000] "GET" 400 0 "-" "x"',
    # 6 empty user agent
    '5.6.7.8 - - [15/Jan/2024:12:02:00 +0000] "POST /login HTTP/1.1" 200 20 "https://a.example/" ""',
    # 7 trailing text after the user agent (match is start-anchored only)
    '9.9.9.9 - - [15/Jan/2024:12:03:00 +0000] "GET /b HTTP/1.0" 500 30 "-" "y" extra tail',
    # 8 redirect
    '9.9.9.9 - - [15/Jan/2024:12:04:00 +0000] "GET /old HTTP/1.1" 302 0 "-" "y"',
    # 9 offset +0200 -> stored as the UTC instant
    '9.9.9.9 - - [15/Jan/2024:14:05:00 +0200] "GET /c HTTP/1.1" 200 40 "-" "y"',
]


def _lines(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(LINES)], "n bigint, value string")


def utc(*a):
    return datetime(*a, tzinfo=timezone.utc).replace(tzinfo=None)


def test_parse_fields(spark):
    got = {r["n"]: r for r in PO.parse_access_log(_lines(spark)).collect()}
    assert sorted(got) == [0, 1, 4, 5, 6, 7, 9]
    r = got[0]
    assert (r.ip, r.method, r.path, r.protocol, r.status_code, r.response_size, r.referer, r.user_agent) == \
        ("1.2.3.4", "GET", "/index.html", "HTTP/1.1", 200, 512, "-", UA)
    assert r.timestamp == utc(2024, 1, 15, 12, 0, 0)
    assert r.raw_log == LINES[0].strip()
    assert got[1].response_size == 0
    assert got[4].timestamp is None
    assert (got[5].method, got[5].path, got[5].protocol) == ("GET", "", "")
    assert got[6].user_agent == ""
    assert got[7].user_agent == "y"
    assert got[9].timestamp == utc(2024, 1, 15, 12, 5, 0)


def test_rejects_and_counters(spark):
    rej = PO.parse_rejects(_lines(spark))
    assert sorted(r["n"] for r in rej.collect()) == [2, 3]
    c = PO.parse_counters(_lines(spark)).collect()[0]
    assert (c.total_lines, c.parsed, c.skipped_redirects, c.unparsed) == (10, 7, 1, 2)


def test_content_keeps_redirects(spark):
    text = "\n".join(v.strip() for v in LINES)
    df = PO.parse_access_log(lines_from_text(spark, text), drop_redirects=False)
    assert df.count() == 8
    assert df.where("status_code = 302").count() == 1


def test_status_filters(spark):
    codes = [200, 302, 403, 404, 500, 503]
    df = spark.createDataFrame([(c,) for c in codes], "status_code int")

    def run(**kw):
        return sorted(r[0] for r in PO.filter_status(df, **kw).collect())

    assert run(whitelist="50[0-9]") == [500, 503]
    assert run(whitelist="4") == [403, 404]
    assert run(blacklist="403|404") == [200, 302, 500, 503]
    # whitelist wins when both are given
    assert run(whitelist="2", blacklist="2") == [200]
    assert run() == codes


def test_directory_source(spark, tmp_path):
    d = tmp_path / "logs"
    d.mkdir()
    (d / "a.log").write_text("\n".join(LINES[:5]) + "\n")
    (d / "b.log").write_text("\n".join(LINES[5:]) + "\n")
    (d / "notes.txt").write_text(LINES[0] + "\n")  # not *.log: not read from a directory
    extra = tmp_path / "single.txt"
    extra.write_text(LINES[0] + "\n")  # an explicit file is read whatever its name
    df = read_access_logs(spark, [str(d), str(extra), str(tmp_path / "missing")])
    assert df.count() == 11
    assert df.select(F.countDistinct("source_file")).first()[0] == 3
    parsed = PO.parse_access_log(df)
    assert parsed.count() == 8


def _log_line(i: int, path: str, ts: str = "15/Jan/2024:12:00:00 +0000") -> str:
    return f'10.0.0.{i % 3 + 1} - - [{ts}] "GET {path} HTTP/1.1" 200 {100 + i} "-" "agent-{i}"'


def test_file_order_columns_across_splits(spark, tmp_path):
    """Q18: FILE_ORDER sorts lines as in their files, also when a file is read in many splits."""
    from trafficlens.schemas import FILE_ORDER

    files = {}
    for name in ("a.log", "b.log"):
        lines = [_log_line(i, f"/{name}/{i:03d}") for i in range(60)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        files[str(tmp_path / name)] = lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        df = read_access_logs(spark, [str(tmp_path)])
        splits = df.select("source_file", "block_start").distinct().count()
        got = df.orderBy(*FILE_ORDER).select("source_file", "value").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert splits > 4
    for path, lines in files.items():
        assert [r.value for r in got if r.source_file.endswith(path)] == lines


def test_equal_timestamps_keep_file_order(spark, tmp_path):
    """W1 ties on (ip, timestamp): the first request in file order gets the gap."""
    from trafficlens.operators.traffic import add_time_diff

    lines = [_log_line(0, "/start", "15/Jan/2024:11:59:50 +0000")]
    lines += [_log_line(3 * k, p) for k, p in enumerate(["/z", "/m", "/a"])]   # same ip, same second
    (tmp_path / "t.log").write_text("\n".join(lines) + "\n")
    parsed = PO.parse_access_log(read_access_logs(spark, [str(tmp_path / "t.log")]))
    got = {r.path: r.time_diff for r in add_time_diff(parsed).collect()}
    assert got == {"/start": None, "/z": 10.0, "/m": 0.0, "/a": 0.0}


def test_every_matching_line_is_kept_and_counted(spark):
    odd = [
        '1.2.3.4 - - [15/Jan/2024:12:00:00 +0000] "GET /a\x00b HTTP/1.1" 200 5 "-" "x\x00y"',
        '1.2.3.4 - - [15/Jan/2024:12:00:00 +0000] "GET /a HTTP/1.1" 99999999999 5 "-" "ua"',
        '1.2.3.4 - - [a "quoted" time] "GET /a HTTP/1.1" 200 "5" "r" "u" and more "text"',
        '1.2.3.4 - - [15/Jan/2024:12:00:00 +0000] "GET /a HTTP/1.1" 302 5 "-" "ua"',
        'a 1 2 b]c"d"e', "", None, '1.2.3.4 200 5 time]GET / HTTP/1.1"-"ua',
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "n int, value string")
    got = {r.n: r for r in PO.parse_access_log(df).collect()}
    assert sorted(got) == [0, 1, 2]
    assert (got[0].path, got[0].user_agent, got[1].status_code) == ("/a\x00b", "x\x00y", None)
    assert (got[2].timestamp, got[2].response_size, got[2].referer, got[2].user_agent) == (None, 0, "r", "u")
    assert sorted(r.n for r in PO.parse_rejects(df).collect()) == [4, 5, 6, 7]
    c = PO.parse_counters(df).first()
    assert (c.total_lines, c.parsed, c.skipped_redirects, c.unparsed) == (8, 3, 1, 4)
    assert PO.drop_redirects(spark.createDataFrame([(None,), (302,), (200,)], "status_code int")).count() == 2
