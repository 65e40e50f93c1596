"""Registered queries of jobs that keep files or state: event-time streams, the day store, files read back.

As in :mod:`.catalog`, the rows come from the fixture log; each query writes them
to a fresh folder in the shape the job reads (files of lines, lists, tables) and
runs the job on that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import parse as PO
from ..operators import summary as SM
from ..operators import traffic as TR
from ..operators.dims import join_dim
from ..schemas import HOURLY_COUNT_COLUMNS, PARSED_COLUMNS
from ..session import stage_path
from ..sources import access_log as AL
from ..sources import fixtures as fx
from ..sources import stage_io as IO
from ..sources import threat_patterns as TP
from ..sources.reputation_lists import read_ua_list
from ..streaming import event_time as ET
from ..streaming import jobs as ST
from . import analyze as AN
from . import bayes as NB
from . import catalog as C
from . import day_store as DS
from . import enrich as EN
from . import label as LB
from . import model as MD

r6 = C.r6
DAY_SECONDS = 86_400


def folder(spark: SparkSession, name: str) -> str:
    return stage_path(spark, f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------------------
# streams with event-time state
# ---------------------------------------------------------------------------

def _file_stream(spark: SparkSession, sf: str, file_of: str = fx.FILE_OF_SQL) -> DataFrame:
    """The fixture's lines as a stream of many files, one (in all its parts) per micro-batch."""
    path = folder(spark, "log-files")
    schema = fx.write_log_files(spark, sf, path, file_of).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", fx.parts_per_file(spark, path)).parquet(path)


def st1_stream_reputation(spark, sf):
    """ST1 with its static side: the blocklist lookup of J1."""
    out = ST.run_to_table(spark, _file_stream(spark, sf), lambda lines: ST.parse_stream(lines, C.blocklist(spark)))
    return out.select("n", "ip_is_known_bad", "country", "asn", "is_known_bot")


def st2_event_time(spark, sf):
    """ST2: closed and open hours without their late rows, and the late rows counted."""
    job = ET.run_hourly(spark, _file_stream(spark, sf), delay=DAY_SECONDS)
    hours = ET.hourly_result(job).select("hour", "total_requests", "illegitimate_requests", r6("avg_confidence").alias("avg_confidence"))
    late = ET.late_per_hour(job)
    return hours.join(late, "hour", "full").na.fill(0, ["total_requests", "illegitimate_requests", "late_requests"])


def st2_event_time_all(spark, sf):
    """ST2: on-time and late rows together are the batch table."""
    job = ET.run_hourly(spark, _file_stream(spark, sf), delay=DAY_SECONDS)
    return ET.hourly_result(job, with_late=True).withColumn("avg_confidence", r6("avg_confidence"))


def st3_event_time(spark, sf):
    """ST3: every (ip, minute) above the threshold, each emitted once."""
    job = ET.run_alerts(spark, _file_stream(spark, sf), delay="20 days")
    return job.tables.rows("alerts").select("ip", "minute")


def st1_time_diff(spark, sf):
    """W1 over files fed one by one in time order."""
    job = ET.run_lag(spark, _file_stream(spark, sf, fx.FILE_IN_ORDER_SQL), tiebreak=C.TIE)
    return job.tables.rows("rows").select("n", r6("time_diff").alias("time_diff"), "out_of_order")


def _days(spark, sf, table):
    job = ET.run_days(spark, _file_stream(spark, sf), C.blocklist(spark), delay=DAY_SECONDS, only=(table,))
    return ET.day_results(spark, job, table)


def st4_days_spike_train(spark, sf):
    return _days(spark, sf, "spike_minutes").where("is_spike").select("day", "minute")


def st4_days_spike_serve(spark, sf):
    return _days(spark, sf, "spikes").select("day", "ip", "during_traffic_spike")


def st4_days_asns(spark, sf):
    return _days(spark, sf, "asns").where("is_coordinated").select("day", "asn")


# ---------------------------------------------------------------------------
# the store of day partials
# ---------------------------------------------------------------------------

def day_store(spark, sf) -> str:
    """The fixture's days written in two runs that overlap by some days."""
    base = folder(spark, "days")
    rows = DS.with_day(C.parsed_stage(spark, sf)).withColumns({"part": F.dayofmonth("day")})
    for part in ("part <= 17", "part >= 14"):
        DS.write_days(rows.where(part).drop("day", "part"), base, tiebreak=C.TIE)
    return base


def a1_from_days(spark, sf):
    return DS.ip_counts(spark, day_store(spark, sf))


def a2_from_days(spark, sf):
    return DS.rate_train(spark, day_store(spark, sf)).withColumn("requests_per_minute", r6("requests_per_minute"))


def a3_from_days(spark, sf):
    s = DS.ip_stats(spark, day_store(spark, sf))
    dbl = ["avg_time_between_requests", "min_time_between_requests", "std_time_between_requests",
           "error_rate", "server_error_rate", "duration_minutes", "requests_per_minute"]
    return s.withColumns({c: r6(c) for c in dbl})


def a6_from_days(spark, sf):
    return DS.spike_minutes(spark, day_store(spark, sf))


def a16_from_days(spark, sf):
    return DS.hourly_counts(spark, day_store(spark, sf)).withColumn("avg_confidence", r6("avg_confidence"))


def a23_from_days(spark, sf):
    return DS.distinct_ips(spark, day_store(spark, sf))


# ---------------------------------------------------------------------------
# joins beyond the broadcast bound, pattern libraries through their index
# ---------------------------------------------------------------------------

def j3_weighted_join(spark, sf):
    """J3 with heavy clients dealt out: each row with its client's count and rate."""
    rows = C.parsed_stage(spark, sf)
    ip = TR.ip_stats_train(rows).select("ip", "request_count_per_ip", "requests_per_minute")
    d = join_dim(rows, ip, "ip", small=False, weight="request_count_per_ip")
    return d.select("n", "request_count_per_ip", r6("requests_per_minute").alias("requests_per_minute"))


def x11_x13_patterns_indexed(spark, sf):
    e = EN.enrich_train(C.parsed_stage(spark, sf), C.blocklist(spark), tiebreak=C.TIE, indexed=True)
    return e.select("n", *C.PATTERN_FLAGS)


# ---------------------------------------------------------------------------
# files written and read back
# ---------------------------------------------------------------------------

def _text_files(df: DataFrame, path: str, extension: str = ".log") -> None:
    """Text files of a column ``value`` with an extension of the caller's choice."""
    df.select("value").write.option("extension", extension).text(path)
    jvm, spark = df.sparkSession._jvm, df.sparkSession
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("part-") and not name.endswith(extension):
            fs.rename(s.getPath(), jvm.org.apache.hadoop.fs.Path(path, name.removesuffix(".txt") + extension))


def io1_scan(spark, sf):
    """IO1: a folder of ``*.log`` files with others among them, a file by name, and a missing path."""
    base, lines = folder(spark, "logs"), C.lines(spark, sf)
    _text_files(lines.where("n % 3 <> 0"), f"{base}/daily")
    lines.where("n % 3 = 1").select("value").write.mode("append").text(f"{base}/daily")  # *.txt: not read
    _text_files(lines.where("n % 3 = 1"), f"{base}/daily/nested")  # a folder below: not read
    lines.where("n % 3 = 0").coalesce(1).select("value").write.text(f"{base}/single")
    single = [f for f in spark.read.text(f"{base}/single").inputFiles()]
    found = AL.read_access_logs(spark, [f"{base}/daily", *single, f"{base}/missing"])
    return PO.parse_access_log(found).select(*PARSED_COLUMNS)


def io2_content(spark, sf):
    """IO2: the log as one string per 500 requests, split again in the tasks."""
    rows = C.lines(spark, sf).withColumn("document", F.floor(F.col("n") / 500))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("n", "value"))), lambda x: x["value"])
    documents = rows.groupBy("document").agg(F.concat(F.lit("\n"), F.array_join(ordered, "\n"), F.lit("\n\n")).alias("content"))
    lines = AL.lines_from_documents(documents)
    return PO.parse_access_log(lines, drop_redirects=False).select("document", "line_id", "raw_log", "status_code")


def io3_io4_csv(spark, sf):
    path = folder(spark, "csv")
    parsed = C.parsed(spark, sf).select("n", *PARSED_COLUMNS)
    IO.write_stage_csv(parsed.where("n % 2 = 0"), path)
    IO.write_stage_csv(parsed.where("n % 2 <> 0"), path, mode="append")
    return IO.read_stage_csv(spark, path, parsed.schema)


def io5_io6_jsonl(spark, sf):
    path = folder(spark, "jsonl")
    examples = LB.training_examples(C.enriched_train(spark, sf).withColumn("reasoning", F.lit("")))
    IO.write_training_jsonl(examples, path)
    return IO.read_training_jsonl(spark, path)


def io8_ua_list(spark, sf):
    """IO8: a list file made of the log's short user agents, applied by the enrichment."""
    path = folder(spark, "ua-list")
    agents = C.parsed(spark, sf).where("length(user_agent) between 2 and 50").select("user_agent").distinct()
    head = spark.createDataFrame([(0, "pattern,comment")], "part int, value string")
    rows = agents.select(F.lit(1).alias("part"), F.concat(F.col("user_agent"), F.lit(",from the log")).alias("value"))
    head.unionByName(rows).orderBy("part", "value").coalesce(1).select("value").write.text(path)
    e = EN.enrich_train(C.parsed_stage(spark, sf), C.blocklist(spark), malicious_user_agents=read_ua_list(spark, path), tiebreak=C.TIE)
    return e.select("n", "is_malicious_user_agent")


def io9_patterns(spark, sf):
    """IO9: a pattern file made of the log's scanned paths and clients' agents, read and applied to the log."""
    path = folder(spark, "patterns")
    quoted = lambda c: F.regexp_replace(c, r"([.?*+^$(){}|\[\]\\])", r"\\$1")
    parsed = C.parsed(spark, sf)
    paths = parsed.where("path like '/scan/%'").select("path").distinct()
    lines = (spark.createDataFrame([(0, "", "# REQUEST URI PATTERNS"), (2, "", "# USER AGENT PATTERNS")], "part int, key string, value string")
             .unionByName(paths.select(F.lit(1).alias("part"), F.col("path").alias("key"), F.concat(F.lit("("), quoted(F.col("path")), F.lit("$)")).alias("value")))
             .unionByName(parsed.where("user_agent like 'python%'").select("user_agent").distinct()
                          .select(F.lit(3).alias("part"), F.col("user_agent").alias("key"), quoted(F.col("user_agent")).alias("value"))))
    lines.orderBy("part", "key").coalesce(1).select("value").write.text(path)
    e = EN.enrich_train(C.parsed_stage(spark, sf), C.blocklist(spark), patterns=TP.read_patterns(spark, path), tiebreak=C.TIE)
    return e.select("n", "path_matches", "ua_matches")


def _hourly_csv(spark, sf) -> str:
    path = folder(spark, "hourly")
    IO.write_stage_csv(SM.hourly_summary(C.classified(spark, sf)).repartition(5), path)
    return path


def io10_hourly(spark, sf):
    h = IO.read_hourly_csv(spark, _hourly_csv(spark, sf))
    return h.select("hour", *HOURLY_COUNT_COLUMNS, r6("avg_confidence").alias("avg_confidence"))


def s2_by_hour(spark, sf):
    """The first day of the hourly table, which is sorted by hour when read."""
    return IO.read_hourly_csv(spark, _hourly_csv(spark, sf)).limit(24).select("hour", "total_requests")


def io11_empty(spark, sf):
    """IO11: without lines both enrichments keep their columns and have no rows."""
    none = C.lines(spark, sf).where("n < 0")
    parsed = PO.parse_access_log(none)
    out = None
    for profile, e, names in (("train", EN.enrich_train(parsed, C.blocklist(spark), tiebreak=C.TIE), EN.T_FEATURES),
                              ("serve", EN.enrich_serve(parsed, C.blocklist(spark), tiebreak=C.TIE), EN.S_FEATURES)):
        row = e.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(profile).alias("profile"), "rows",
                                                            F.lit(len(set(names) & set(e.columns))).cast("bigint").alias("feature_columns"))
        out = row if out is None else out.unionByName(row)
    return out


def s1_sorted(spark, sf):
    """Rows in the order of the written files, with their places."""
    path = folder(spark, "sorted")
    IO.write_stage(C.parsed(spark, sf).select("n", "ip", "timestamp"), path, order_by=["ip", "timestamp", "n"])
    t = spark.read.parquet(path).select("n", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    files = t.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))  # one row per file
    before = files.alias("f").join(files.alias("g"), F.col("g.file") < F.col("f.file"), "left").groupBy("f.file").agg(
        F.coalesce(F.sum("g.rows"), F.lit(0)).alias("before"))
    return t.join(before, "file").select("n", (F.col("before") + F.col("at")).alias("place"))


def s6_first_rows(spark, sf):
    return IO.first_rows(C.parsed(spark, sf), 25, order_by=["timestamp", "n"]).select("n", "ip", "path")


def p9_observed(spark, sf):
    """The counters of the table as it was written."""
    path = folder(spark, "parsed")
    counters = IO.write_parsed(C.odd_lines(spark, sf), path)
    written = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("parsed"))
    return written.select(*[F.lit(counters[c]).cast("bigint").alias(c) for c in ("total_lines", "skipped_redirects", "unparsed")], "parsed")


def io12_package(spark, sf):
    """IO12: a saved package classifies as the model in memory does."""
    (model, _), e = C._train(spark, sf)
    path = folder(spark, "package")
    MD.save(model, path, {"profile": "serve", "blacklist": "4"})
    loaded, config = MD.load(spark, path)
    rows = e.drop("classification", "confidence")
    a = MD.classify(model, rows).select("n", "classification", F.col("confidence").alias("p"))
    b = MD.classify(loaded, rows).select("n", F.col("classification").alias("other"), F.col("confidence").alias("q"))
    same = (F.col("classification") == F.col("other")) & (F.abs(F.col("p") - F.col("q")) < 1e-9)
    return a.join(b, "n").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("different")).withColumn("blacklist", F.lit(config["blacklist"]))


def m10_analyze(spark, sf):
    """The hourly totals of the analysis of a saved package, with its own status filter."""
    path, parsed = folder(spark, "package"), C.parsed_stage(spark, sf)
    model, _ = C._fit(EN.enrich_train(parsed, C.blocklist(spark), tiebreak=C.TIE))
    MD.save(model, path, {"profile": "serve", "blacklist": "4"})
    _, hourly, _ = AN.analyze_packaged(spark, path, parsed.drop("classification", "confidence"), C.blocklist(spark), tiebreak=C.TIE)
    return hourly.select("hour", "total_requests", (F.col("legitimate_requests") + F.col("illegitimate_requests")).alias("both_kinds"))


# ---------------------------------------------------------------------------
# the count-based classifier
# ---------------------------------------------------------------------------

def _counts_model(spark, sf):
    e = C.materialize(C.enriched_train(spark, sf))
    split = e.withColumn("held_out", F.col("n") % 10 == 0)
    return NB.fit(split.where(~F.col("held_out"))), split


def m8_counts_model(spark, sf):
    """M8: log-odds of every feature of the count-based model."""
    model, _ = _counts_model(spark, sf)
    return model.tables().withColumn("log_weight", r6("log_weight"))


def m9_counts_classify(spark, sf):
    """M9: class and confidence of every row by the count-based model."""
    model, rows = _counts_model(spark, sf)
    return model.classify(rows.drop("classification", "confidence")).select("n", "classification", r6("confidence").alias("confidence"))


NAMES = [
    "st1_time_diff", "st1_stream_reputation", "j3_weighted_join", "x11_x13_patterns_indexed", "st2_event_time", "st2_event_time_all", "st3_event_time", "st4_days_spike_train", "st4_days_spike_serve", "st4_days_asns",
    "a1_from_days", "a2_from_days", "a3_from_days", "a6_from_days", "a16_from_days", "a23_from_days",
    "io1_scan", "io2_content", "io3_io4_csv", "io5_io6_jsonl", "io8_ua_list", "io9_patterns", "io10_hourly", "io11_empty", "io12_package",
    "s1_sorted", "s2_by_hour", "s6_first_rows", "p9_observed", "m10_analyze", "m8_counts_model", "m9_counts_classify",
]

QUERIES = {name: globals()[name] for name in NAMES}
