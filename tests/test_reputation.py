"""IO7, A15, J1 with the blocklist fixture of FIXTURES §3."""

from trafficlens.operators.reputation import asn_reputation
from trafficlens.sources.reputation_lists import blocklist_by_ip, blocklist_from_lines, ua_list_from_lines

TEXT = [
    "# blocklist, generated",
    "198.51.100.7 # CN AS9009 Example Hosting A",
    *[f"203.0.113.{k} # RU AS64500 Example Hosting B" for k in range(1, 9)],
    "",
    "not a blocklist line",
    "192.0.2.55 # US AS64501 Example Hosting C",
    "192.0.2.55 # DE AS64501 Example Hosting C2",  # duplicate ip: last line wins
]


def _lines(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(TEXT)], "line_no bigint, value string")


def test_blocklist_parse_and_dedup(spark):
    bl = blocklist_from_lines(_lines(spark))
    assert bl.count() == 11
    by_ip = {r.ip: (r.country, r.asn, r.organization) for r in blocklist_by_ip(bl).collect()}
    assert len(by_ip) == 10
    assert by_ip["192.0.2.55"] == ("DE", "AS64501", "Example Hosting C2")
    assert by_ip["198.51.100.7"] == ("CN", "AS9009", "Example Hosting A")


def test_asn_scores(spark):
    bl = blocklist_from_lines(_lines(spark))
    got = {r.asn: r for r in asn_reputation(bl).collect()}
    assert got["AS64500"].reputation_score == 100.0
    assert got["AS9009"].reputation_score == 12.5
    # two lines for AS64501 (lines are counted, not IPs); country = first line
    assert got["AS64501"].reputation_score == 25.0
    assert got["AS64501"].country == "US"


def test_ua_list(spark):
    lines = spark.createDataFrame([(0, "pattern,comment"), (1, "sqlmap*, scanner"), (2, ""), (3, " nikto ,x")],
                                  "line_no bigint, value string")
    assert sorted(r.pattern for r in ua_list_from_lines(lines).collect()) == ["nikto", "sqlmap*"]


def test_missing_blocklist_is_empty_list(spark, tmp_path):
    """Q11: an unavailable blocklist gives an empty list; every IP is unlisted."""
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from trafficlens.plans import catalog as C
    from trafficlens.plans import enrich as EN
    from trafficlens.sources.reputation_lists import read_blocklist

    for path in (None, str(tmp_path / "no-such-list.txt")):
        bl = read_blocklist(spark, path)
        assert bl.count() == 0
        out = EN.enrich_serve(C.parsed(spark, SF_SMALL), bl, tiebreak=C.TIE)
        agg = out.agg(F.count(F.lit(1)).alias("n"), F.count_if("ip_is_known_bad").alias("bad"),
                      F.count_if(F.col("asn") != "Unknown").alias("known"),
                      F.max("combined_reputation_score").alias("score")).first()
        assert agg.n > 0 and agg.bad == 0 and agg.known == 0 and agg.score == 0.0


def test_list_line_order_across_files_and_splits(spark, tmp_path):
    """Q10 over a directory of lists: line order is file order, also when Spark packs the
    larger file first or reads a file in many splits; the last line for an IP wins."""
    from trafficlens.sources.reputation_lists import blocklist_by_ip, read_blocklist, read_ordered_lines

    d = tmp_path / "lists"
    d.mkdir()
    a = ["192.0.2.9 # AA AS1 First Org"]
    b = [f"198.51.100.{k} # RU AS64500 Filler {k}" for k in range(1, 40)] + ["192.0.2.9 # BB AS2 Later Org"]
    (d / "a.txt").write_text("\n".join(a) + "\n")
    (d / "b.txt").write_text("\n".join(b) + "\n")   # larger: packed before a.txt by Spark
    by_ip = {r.ip: r.country for r in blocklist_by_ip(read_blocklist(spark, str(d))).collect()}
    assert by_ip["192.0.2.9"] == "BB"

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        got = [r.value for r in read_ordered_lines(spark, str(d)).orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == a + b
