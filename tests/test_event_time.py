"""Streams with event-time state: late rows, alerts, gaps across batches, closed days, and their tables."""

import pytest
from pyspark.sql import functions as F

from trafficlens.operators import summary as SM
from trafficlens.operators import traffic as TR
from trafficlens.operators.parse import parse_access_log
from trafficlens.plans import catalog as C
from trafficlens.sources import fixtures as fx
from trafficlens.streaming import event_time as ET
from trafficlens.streaming import tables as TB
from trafficlens.streaming.tables import BatchTables

from conftest import SF_SMALL, rows

DAY = 86_400


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x bigint")


def test_appended_parts_are_merged_by_levels(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TB, "FAN", 3)
    t = BatchTables(spark, str(tmp_path))
    assert t.rows("a") is None
    for b in range(11):
        t.append("a", b, numbers(spark, b))
    assert rows(t.rows("a")) == [(b,) for b in sorted(range(11), key=lambda v: repr((v,)))]
    assert t.part_count("a") <= 5  # one of 9 batches and two single ones
    t.append("a", 10, numbers(spark, 10))  # the batch runs again
    assert t.rows("a").count() == 11
    assert t.append("a", 11, numbers(spark)) is False and t.rows("a").count() == 11
    # a merge that stopped before it removed its parts
    t.rows("a").coalesce(1).write.parquet(str(tmp_path / "a" / "part-3-0-10"))
    assert t.rows("a").count() == 11 and t.rows("a", 5) is None


def test_snapshots_keep_the_version_of_a_repetition(spark, tmp_path):
    t = BatchTables(spark, str(tmp_path))
    for b in range(4):
        t.write_snapshot("s", b, numbers(spark, b))
    assert rows(t.snapshot("s")) == [(3,)] and rows(t.snapshot("s", 3)) == [(2,)]
    assert t.snapshot("s", 2) is None  # older versions are gone
    (tmp_path / "s" / "v9").mkdir()  # an unfinished one does not count
    assert rows(t.snapshot("s")) == [(3,)]


def stream_of(spark, path, file_of=fx.FILE_OF_SQL):
    schema = fx.write_log_files(spark, SF_SMALL, str(path), file_of).schema
    return lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


HOURLY = ["hour", "total_requests", "legitimate_requests", "human_requests", "legitimate_bot_requests"]


def test_hourly_on_time_and_late_rows_are_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TB, "FAN", 4)
    source = stream_of(spark, tmp_path / "in")
    job = ET.run_hourly(spark, source(), delay=DAY, name=f"h-{tmp_path.name}")
    batch = SM.hourly_counts(C.classified(spark, SF_SMALL))
    assert rows(ET.hourly_result(job, with_late=True), *HOURLY) == rows(batch, *HOURLY)
    on_time = ET.hourly_result(job).agg(F.sum("total_requests")).first()[0]
    late = job.tables.rows("late").count()
    assert late > 0 and on_time + late == batch.agg(F.sum("total_requests")).first()[0]
    closed = job.tables.rows("hours")
    assert closed.count() == closed.select("hour").distinct().count() > 0  # each hour is emitted once
    assert job.tables.part_count("hours") <= 5  # of 8 batches


def test_hourly_after_a_failed_batch(spark, tmp_path, monkeypatch):
    """A batch that fails after part of its writes, run again, leaves the same tables."""
    source = stream_of(spark, tmp_path / "in")
    want = ET.run_hourly(spark, source(), delay=DAY, name=f"w-{tmp_path.name}")
    write, failed = BatchTables.write_snapshot, []

    def once(self, table, batch, df):
        if table == "open" and batch == 5 and not failed:
            failed.append(1)
            raise RuntimeError("lost")
        write(self, table, batch, df)

    monkeypatch.setattr(BatchTables, "write_snapshot", once)
    with pytest.raises(Exception, match="lost"):
        ET.run_hourly(spark, source(), delay=DAY, name=f"f-{tmp_path.name}")
    job = ET.run_hourly(spark, source(), delay=DAY, name=f"f-{tmp_path.name}")
    assert failed and rows(ET.hourly_result(job), *HOURLY) == rows(ET.hourly_result(want), *HOURLY)
    assert rows(job.tables.rows("late"), "n") == rows(want.tables.rows("late"), "n")


def test_alerts_once_and_none_missed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TB, "FAN", 3)
    source = stream_of(spark, tmp_path / "in")
    counts = (parse_access_log(C.lines(spark, SF_SMALL)).groupBy("ip", TR.minute_of().alias("minute")).agg(F.count(F.lit(1)).alias("k")))
    want = rows(counts.where("k > 1"), "ip", "minute")
    write, failed = BatchTables.append, []

    def once(self, table, batch, df):
        out = write(self, table, batch, df)
        if batch == 6 and not failed:
            failed.append(1)
            raise RuntimeError("lost")  # after the alerts were written, before the batch is committed
        return out

    monkeypatch.setattr(BatchTables, "append", once)
    with pytest.raises(Exception, match="lost"):
        ET.run_alerts(spark, source(), threshold=1, delay="40 days", name=f"a-{tmp_path.name}")
    early = BatchTables(spark, f"{ET._base(spark, f'a-{tmp_path.name}')}/tables").rows("alerts")
    assert early.count() > 0  # alerts leave while the stream runs
    job = ET.run_alerts(spark, source(), threshold=1, delay="40 days", name=f"a-{tmp_path.name}")
    assert rows(job.tables.rows("alerts"), "ip", "minute") == want and want


LINE = '{ip} - - [{time}] "GET /a HTTP/1.1" 200 5 "-" "ua"'


def log_lines(spark, data):
    made = [(n, LINE.format(ip=ip, time=time)) for n, ip, time in data]
    return spark.createDataFrame(made, "n bigint, value string").coalesce(1)


def test_gaps_across_files_equal_the_batch(spark, tmp_path):
    """Ties at a file's end, rows without a time, clients that pause for some files."""
    t = lambda s: f"15/Jan/2024:12:{s // 60:02d}:{s % 60:02d} +0000"
    files = [[(1, "10.0.0.1", t(0)), (2, "10.0.0.2", t(5)), (3, "10.0.0.1", "no time"), (4, "10.0.0.1", t(9)), (5, "10.0.0.1", t(9))],
             [(6, "10.0.0.1", t(9)), (7, "10.0.0.1", t(9)), (8, "10.0.0.3", "no time"), (9, "10.0.0.4", t(70))],
             [(10, "10.0.0.2", t(200)), (11, "10.0.0.1", t(200)), (12, "10.0.0.1", "no time"), (13, "10.0.0.4", t(200)), (14, "10.0.0.4", t(201))]]
    path = str(tmp_path / "in")
    for f in files:
        log_lines(spark, f).write.mode("append").parquet(path)
    source = spark.readStream.schema("n bigint, value string").option("maxFilesPerTrigger", 1).parquet(path)
    got = ET.run_lag(spark, source, tiebreak=["n"], name=f"g-{tmp_path.name}").tables.rows("rows")
    want = TR.add_time_diff(parse_access_log(log_lines(spark, sum(files, []))), tiebreak=["n"])
    assert rows(got, "n", "time_diff") == rows(want, "n", "time_diff")
    assert got.where("out_of_order").count() == 0


def test_gaps_of_late_rows_and_forgotten_clients(spark, tmp_path):
    t = lambda h: f"15/Jan/2024:{h:02d}:00:00 +0000"
    path = str(tmp_path / "in")
    for f in ([(1, "10.0.0.1", t(9)), (2, "10.0.0.2", t(1))], [(3, "10.0.0.1", t(8))], [(4, "10.0.0.1", t(10)), (5, "10.0.0.2", t(10))]):
        log_lines(spark, f).write.mode("append").parquet(path)
    source = spark.readStream.schema("n bigint, value string").option("maxFilesPerTrigger", 1).parquet(path)
    got = ET.run_lag(spark, source, expiry=4 * 3600, tiebreak=["n"], name=f"l-{tmp_path.name}").tables.rows("rows")
    assert {r.n: (r.time_diff, r.out_of_order) for r in got.collect()} == {
        1: (None, False), 2: (None, False), 3: (None, True), 4: (3600.0, False), 5: (None, False)}


def test_closed_days_equal_the_scoped_batch_and_late_days_reopen(spark, tmp_path):
    source = stream_of(spark, tmp_path / "in")
    job = ET.run_days(spark, source(), C.blocklist(spark), delay=3600, finish=False, name=f"d-{tmp_path.name}")
    spikes = ET.day_results(spark, job, "spikes")
    want = C.q1_scope_spike_serve(spark, SF_SMALL)
    closed = [r.day for r in spikes.select("day").distinct().collect()]
    assert 0 < len(closed) < want.select("day").distinct().count()  # the last days are open
    # late rows came in after these days were closed first, and are in their results
    assert rows(spikes, "day", "ip", "during_traffic_spike") == rows(want.where(F.col("day").isin(closed)), "day", "ip", "during_traffic_spike")
    minutes = ET.day_results(spark, job, "spike_minutes").where("is_spike")
    scoped = C.q1_scope_spike_train(spark, SF_SMALL).where(F.col("day").isin(closed))
    assert rows(minutes, "day", "minute") == rows(scoped, "day", "minute")


def test_a_log_file_in_parts_is_one_batch(spark, tmp_path, monkeypatch):
    """Files of more rows than a part holds are dealt out, and each micro-batch still is one file, also an almost empty one."""
    monkeypatch.setattr(fx, "ROWS_PER_PART", 50)
    days = [2] * 300 + [10, 20] + [29] * 40  # most requests in the first file, none in some
    events = spark.createDataFrame([(10 * n + 3, f"2024-01-{d:02d} 10:00:00", n, "view", 1.0) for n, d in enumerate(days)],
                                   "event_id bigint, ts string, user_id bigint, event_type string, value double")
    events.coalesce(2).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    path = str(tmp_path / "in")
    schema = fx.write_log_files(spark, str(tmp_path / "sf"), path, fx.FILE_IN_ORDER_SQL).schema
    assert fx.parts_per_file(spark, path) == 6
    written = spark.read.parquet(path).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert written <= 60
    batches = []
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", fx.parts_per_file(spark, path)).parquet(path)
    ET._run(spark, source, str(tmp_path / "run"), lambda batch, _: batches.append(sorted(r["n"] for r in batch.select("n").collect())))
    want = {}
    for n, d in enumerate(days):
        want.setdefault((d - 1) * fx.LOG_FILES // 31, []).append(10 * n + 3)
    assert batches == [want.get(k, []) for k in range(fx.LOG_FILES)]
