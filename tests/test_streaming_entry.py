"""Batch = stream (ST1, ST2), summary invariants, and the driver contract."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from trafficlens.operators import parse as PO
from trafficlens.operators.summary import hourly_counts, hourly_summary
from trafficlens.plans import catalog as C
from trafficlens.streaming import jobs as ST

from conftest import SF_SMALL, rows
from test_parse import LINES


def test_stream_parse_equals_batch(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.log").write_text("\n".join(LINES[:6]) + "\n")
    (d / "b.log").write_text("\n".join(LINES[6:]) + "\n")
    (d / "skip.txt").write_text(LINES[0] + "\n")
    streamed = ST.run_to_table(spark, ST.log_text_stream(spark, str(d)), ST.parse_stream)
    batch = ST.parse_stream(spark.read.text(str(d / "*.log")))
    cols = ["ip", "timestamp", "path", "status_code", "is_error", "is_known_bot", "raw_log"]
    assert rows(streamed, *cols) == rows(batch, *cols)
    assert streamed.count() == 7


def test_stream_hourly_equals_batch(spark):
    out = C.st2_stream_hourly(spark, SF_SMALL).drop("avg_confidence")
    batch = hourly_counts(C.classified(spark, SF_SMALL)).drop("avg_confidence")
    cols = sorted(out.columns)
    assert cols == sorted(batch.columns)
    assert rows(out, *cols) == rows(batch, *cols)


def test_hourly_invariants(spark):
    cls = C.classified(spark, SF_SMALL)
    h = hourly_summary(cls)
    t = h.agg(F.sum("total_requests").alias("t"), F.sum("legitimate_requests").alias("l"),
              F.sum("illegitimate_requests").alias("i"), F.sum("human_requests").alias("hu"),
              F.sum("bot_requests").alias("b"),
              F.sum(F.col("legitimate_human_requests") + F.col("legitimate_bot_requests")
                    + F.col("illegitimate_human_requests") + F.col("illegitimate_bot_requests"))
              .alias("four")).first()
    n = cls.where(F.col("timestamp").isNotNull()).count()
    unknown = cls.where(~F.col("classification").isin(
        "legitimate_human", "legitimate_bot", "illegitimate_human", "illegitimate_bot")).count()
    assert t.t == n
    assert t.l + t.i == n and t.hu + t.b == n
    assert t.four + unknown == n
    assert h.where("legitimate_pct + illegitimate_pct > 100.011").count() == 0


def test_enrichment_flags_never_null(spark):
    for df in (C.enriched_train(spark, SF_SMALL), C.enriched_serve(spark, SF_SMALL)):
        flags = [f.name for f in df.schema.fields if f.dataType.typeName() == "boolean"]
        assert flags
        nulls = df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in flags]).first().asDict()
        assert all(v == 0 for v in nulls.values()), nulls
        assert df.count() == PO.parse_access_log(C.lines(spark, SF_SMALL)).count()


def test_driver_contract(spark):
    df = E.entry(spark)
    assert "total_requests" in df.columns and df.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
    for name in ("p1_parse", "a16_hourly", "s3_top_ips"):
        assert qs[name](spark, SF_SMALL).count() > 0


def test_late_rows_over_many_batches_are_merged(spark, tmp_path):
    """Files out of time order, one micro-batch each: the totals equal the batch result."""
    lines = C.lines(spark, SF_SMALL)
    for k in (5, 1, 4, 0, 3, 2):  # hours are scattered over all files
        lines.where(F.pmod(F.col("n"), F.lit(6)) == k).coalesce(1).write.mode("append").parquet(str(tmp_path))
    source = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    hourly = ST.run_merged(spark, source, ST.hourly_partial, ST.hourly_total)
    want = ST.hourly_total(ST.hourly_partial(lines))
    cols = [c for c in want.columns if c != "avg_confidence"]
    assert rows(hourly, *cols) == rows(want, *cols)
    source = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    alerts = ST.run_merged(spark, source, ST.rate_partial, lambda d: ST.rate_alerts(d, 2))
    assert rows(alerts) == rows(ST.rate_alerts(ST.rate_partial(lines), 2)) and alerts.count() > 0
