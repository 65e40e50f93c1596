"""S5, S7 and the threat-pattern loader (IO9)."""

from pyspark.sql import functions as F

from trafficlens.operators.sampling import draw, sample_exact, train_validation_split
from trafficlens.sources.threat_patterns import library, patterns_from_lines

from conftest import SF_MID


def test_sample_exact(spark):
    df = spark.range(100).withColumn("raw_log", F.concat(F.lit("line "), F.col("id").cast("string")))
    for n, want in [(10, 10), (100, 100), (200, 100), (0, 100)]:
        assert sample_exact(df, n).count() == want
    a = sorted(r.id for r in sample_exact(df.repartition(7), 10).collect())
    b = sorted(r.id for r in sample_exact(df.repartition(1), 10).collect())
    assert a == b and len(set(a)) == 10
    ordered = [r.id for r in sample_exact(df, 10, order_cols=["id"]).collect()]
    assert ordered == sorted(ordered)


def test_sample_exact_matches_brute_force(spark):
    # The thresholded candidate filter returns exactly the global top-n by hash,
    # also when the first threshold passes too few rows (negative oversampling
    # forces the widening loop).
    df = spark.range(20_000).withColumn("raw_log", F.concat(F.lit("req "), F.col("id").cast("string")))
    df = df.repartition(9)
    for n, seed, sig in [(1, 1, 8.0), (50, 42, 8.0), (400, 7, 8.0), (400, 7, -20.0), (5000, 3, 8.0)]:
        h = draw(["raw_log"], seed)
        want = [r.id for r in df.withColumn("_h", h).orderBy("_h", "raw_log").limit(n).collect()]
        got = sample_exact(df, n, seed=seed, oversample_sigmas=sig).collect()
        assert len(got) == n
        assert sorted(r.id for r in got) == sorted(want)


def test_split_reproducible(spark):
    df = spark.range(2000).withColumn("raw_log", F.col("id").cast("string"))
    tr, va = train_validation_split(df, ["raw_log"], 0.1)
    assert tr.count() + va.count() == 2000
    assert 120 < va.count() < 280
    _, va2 = train_validation_split(df.repartition(5), ["raw_log"], 0.1)
    assert sorted(r.id for r in va.collect()) == sorted(r.id for r in va2.collect())


PATTERN_FILE = [
    "# SQL INJECTION PATTERNS",
    r"(union\s+select)",
    r"(a)(b)",
    "",
    "# XSS PATTERNS",
    r"<script",
    "# WORDPRESS SPECIFIC",
    r"wp-login\.php",
    "# COMMON MALICIOUS FILE EXTENSIONS",
    r"\.php5$",
    "# COMMAND INJECTION PATTERNS",
    "(a",
    "a|",
    "[",
]


def _lines(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(PATTERN_FILE)], "line_no bigint, value string")


def test_pattern_routing_default(spark):
    lib = library(patterns_from_lines(_lines(spark)))
    assert lib["sql_injection"] == [r"union\s+select", r"(a)(b)"]   # only a matching outer pair is stripped
    assert lib["xss"] == ["<script"]
    assert lib["wordpress"] == [r"wp-login\.php"]
    assert lib["malicious_file_ext"] == [r"\.php5$"]
    # '(a' and '[' do not compile -> literals; 'a|' compiles
    assert lib["command_injection"] == [r"\(a", "a|", r"\["]


def test_pattern_routing_compat(spark):
    lib = library(patterns_from_lines(_lines(spark), compat=True))
    # Q5: headers that are not '<category> PATTERNS' do not switch the category
    assert lib["xss"] == ["<script", r"wp-login\.php", r"\.php5$"]
    assert lib["wordpress"] == [] and lib["malicious_file_ext"] == []
    # Q5c: '(a)(b)' loses its outer parentheses, fails to compile, becomes a literal
    assert lib["sql_injection"] == [r"union\s+select", r"a\)\(b"]


def test_read_pattern_file(spark, tmp_path):
    f = tmp_path / "patterns.txt"
    f.write_text("\n".join(["# leading comment", "orphan line before any header"] + PATTERN_FILE
                           + ["# END OF PATTERNS", "after the end"]) + "\n")
    from trafficlens.sources.threat_patterns import read_patterns
    pats = read_patterns(spark, str(f))
    lib = library(pats)
    assert lib["xss"] == ["<script"]
    assert lib["command_injection"] == [r"\(a", "a|", r"\["]
    assert pats.count() == 8   # 2+1+1+1+3 pattern lines; orphan line (no header yet) and lines after END are dropped
    assert {r.status for r in pats.collect()} == {"ok", "escaped"}


def test_patterns_that_only_java_rejects_are_literals(spark, tmp_path):
    """A bare '{text}' compiles in Python only; a library with one must still run through enrichment."""
    from trafficlens.plans import catalog as C
    from trafficlens.plans import enrich as EN
    from trafficlens.sources.reputation_lists import read_ua_list
    from trafficlens.sources.threat_patterns import library_status, read_patterns
    many = "\n".join(f"needle{i}" for i in range(1200))
    (tmp_path / "a.txt").write_text("# QUERY STRING PATTERNS\nid={text}\nor\\+1=1\n(a\n" + many + "\n")
    (tmp_path / "b.txt").write_text("# REQUEST URI PATTERNS\n/etc/passwd\n")
    (tmp_path / "ua.csv").write_text("pattern,source\npython-requests*,x\n")
    pats = read_patterns(spark, str(tmp_path) + "/*.txt")
    status = {p: s for _, p, s in library_status(pats)}
    assert status["id=\\{text\\}"] == "escaped_java" and status["\\(a"] == "escaped" and status["or\\+1=1"] == "ok"
    e = EN.enrich_train(C.parsed_stage(spark, SF_MID), C.blocklist(spark), read_ua_list(spark, str(tmp_path / "ua.csv")), pats, tiebreak=C.TIE)
    got = e.agg(F.count_if("query_matches").alias("q"), F.count_if("path_matches").alias("p"), F.count_if("is_malicious_user_agent").alias("u"),
                F.count_if(F.col("path").contains("or+1=1")).alias("wq"), F.count_if(F.col("path").contains("/etc/passwd")).alias("wp"),
                F.count_if(F.col("user_agent").startswith("python-requests")).alias("wu")).first()
    assert (got.q, got.p, got.u) == (got.wq, got.wp, got.wu) and got.q and got.p and got.u


def test_draw_splits_evenly(spark):
    from trafficlens.operators.sampling import train_validation_split
    tr, va = train_validation_split(spark.range(20_000).withColumn("raw_log", F.col("id").cast("string")), ["raw_log"], 0.1)
    assert tr.count() + va.count() == 20_000 and 1800 < va.count() < 2200
