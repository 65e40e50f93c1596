"""Access-log fixture derived from the driver's ``events`` table.

The driver's tables hold no web logs, so a log is derived from ``events`` by
one SQL text that runs unchanged in Spark and DuckDB (``{events}`` is the
Spark DataFrame parameter / the DuckDB view).  Its work grows with ``events``.
``n`` (the event id) is the unique tie-break for rows with equal (ip, ts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import REDIRECT_STATUS_CODES
from .spread import spread

REQ_ALL_SQL = """
SELECT n, ip, ts, method, path, 'HTTP/1.1' AS protocol, status_code,
       CASE WHEN status_code = 404 THEN 0 ELSE response_size END AS response_size,
       referer, user_agent,
       CASE WHEN n % 97 = 0 THEN 'unknown' WHEN k <= 2 THEN 'illegitimate_bot'
            WHEN user_id % 5 = 3 THEN 'legitimate_bot' WHEN path NOT LIKE '/p/%' THEN 'illegitimate_human'
            ELSE 'legitimate_human' END AS classification,
       CASE WHEN n % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(50 + n % 50 AS DOUBLE) / 100 END AS confidence
FROM (
  SELECT n, k, user_id,
    CASE WHEN k = 0 THEN '198.51.100.7'
         WHEN k <= 2 THEN concat('203.0.113.', CAST(g % 8 + 1 AS VARCHAR(9)))
         ELSE concat('10.0.', CAST(CAST(floor(user_id / 256) AS BIGINT) % 256 AS VARCHAR(9)), '.', CAST(user_id % 256 AS VARCHAR(9))) END AS ip,
    CASE WHEN k = 0 THEN TIMESTAMP '2024-01-15 12:00:00' + CAST(floor(n / 40) AS INT) * INTERVAL '1' SECOND
         ELSE date_trunc('second', ts) END AS ts,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
    CASE WHEN k = 0 THEN '/api/checkout'
         WHEN k <= 2 THEN concat('/scan/', CAST(CAST(floor(n / 80) AS BIGINT) % 40 AS VARCHAR(9)), '.php')
         WHEN n % 50 = 3 THEN '/search?q=<script>alert(1)</script>'
         WHEN n % 50 = 4 THEN '/item?id=1%27+or+1=1--'
         WHEN n % 50 = 5 THEN '/../../etc/passwd'
         WHEN n % 50 = 6 THEN '/wp-login.php'
         WHEN n % 50 = 7 THEN '/shell.php'
         WHEN n % 50 = 8 THEN '/x.php5?cmd=;cat+/etc/hosts'
         ELSE concat('/p/', CAST(user_id % 30 AS VARCHAR(9))) END AS path,
    CASE WHEN k = 0 THEN CASE WHEN g % 3 = 0 THEN 503 WHEN g % 3 = 1 THEN 429 ELSE 200 END
         WHEN k <= 2 THEN 404 WHEN event_type = 'error' THEN 500
         WHEN event_type = 'signup' THEN 302 ELSE 200 END AS status_code,
    CAST(floor(value * 100) AS BIGINT) AS response_size,
    CASE WHEN user_id % 3 = 0 THEN '-' ELSE 'https://example.com/' END AS referer,
    CASE WHEN k = 0 THEN '-' WHEN k <= 2 THEN 'python-requests/2.31'
         WHEN user_id % 5 = 0 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36'
         WHEN user_id % 5 = 1 THEN 'Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0'
         WHEN user_id % 5 = 2 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.0 Safari/605.1.15'
         WHEN user_id % 5 = 3 THEN 'Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)'
         ELSE 'Mozilla/4.0 (compatible; MSIE 6.0; Windows NT 5.1)' END AS user_agent
  FROM (SELECT event_id AS n, event_id % 10 AS k, CAST(floor(event_id / 10) AS BIGINT) AS g, user_id, event_type, value, ts FROM {events}) e
) r
"""

REDIRECT_LIST_SQL = ", ".join(str(c) for c in REDIRECT_STATUS_CODES)

# Fixture blocklist (FIXTURES.md §3): 10 rows (ip, country, asn, organization).
BLOCKLIST_ROWS = (
    [("198.51.100.7", "CN", "AS9009", "Example Hosting A")]
    + [(f"203.0.113.{k}", "RU", "AS64500", "Example Hosting B") for k in range(1, 9)]
    + [("192.0.2.55", "US", "AS64501", "Example Hosting C")]
)


def duck_req_all_sql() -> str:
    return REQ_ALL_SQL.format(events="events")


def duck_req_sql() -> str:
    return f"(SELECT * FROM ({duck_req_all_sql()}) q WHERE status_code NOT IN ({REDIRECT_LIST_SQL}))"


def duck_blocklist_sql() -> str:
    vals = ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in BLOCKLIST_ROWS)
    return f"(SELECT * FROM (VALUES {vals}) AS t(ip, country, asn, organization))"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    ev = spread(ev, unsplittable=True)  # a Parquet file of one row group
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def req_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived request table, all status codes (FIXTURES.md §2)."""
    return spark.sql(REQ_ALL_SQL, events=events(spark, sf_dir))


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw combined-format lines of the fixture, one per event.

    Columns ``value`` (the line) plus pass-through ``n``, ``classification``
    and ``confidence`` (the fixture's labels; a real log has none).
    """
    return lines_from_requests(req_all(spark, sf_dir))


def lines_from_requests(r: DataFrame) -> DataFrame:
    """Render request rows (``req_all`` shape) as combined-format lines."""
    size = F.when(F.col("status_code") == 404, F.lit("-")).otherwise(F.col("response_size").cast("string"))
    line = F.concat(
        F.col("ip"), F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss Z"), F.lit('] "'),
        F.col("method"), F.lit(" "), F.col("path"), F.lit(" "), F.col("protocol"), F.lit('" '),
        F.col("status_code").cast("string"), F.lit(" "), size, F.lit(' "'), F.col("referer"),
        F.lit('" "'), F.col("user_agent"), F.lit('"'),
    )
    return r.select("n", line.alias("value"), "classification", "confidence")


#: Files of :func:`write_log_files`, and the requests whose lines arrive two files late.
LOG_FILES, LATE_EVERY = 8, 11

#: File of a request: by its time, with every LATE_EVERY-th request two files later (Spark and DuckDB).
FILE_OF_SQL = f"least({LOG_FILES - 1}, CAST(floor((extract(DAY FROM ts) - 1) * {LOG_FILES} / 31) AS INT) + CASE WHEN n % {LATE_EVERY} = 0 THEN 2 ELSE 0 END)"
FILE_IN_ORDER_SQL = f"CAST(floor((extract(DAY FROM ts) - 1) * {LOG_FILES} / 31) AS INT)"


#: Rows of one Parquet file of :func:`write_log_files`; a larger file of the log is written as several.
ROWS_PER_PART = 50_000


def write_log_files(spark: SparkSession, sf_dir: str, folder: str, file_of: str = FILE_OF_SQL) -> DataFrame:
    """The fixture's lines as ``LOG_FILES`` files, written one after the other; returns an empty frame of their schema.

    A file of the log is a number of Parquet files, the same for each (:func:`parts_per_file`), so that
    no task writes or reads a whole one.
    """
    requests = req_all(spark, sf_dir).withColumn("file", F.expr(file_of)).persist()
    largest = requests.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    parts = -(-largest // ROWS_PER_PART) or 1
    for k in range(LOG_FILES):
        lines_from_requests(requests.where(F.col("file") == k).repartition(parts)).write.mode("append").parquet(folder)
        _fill_up(spark, folder, (k + 1) * parts)
    requests.unpersist()
    return spark.read.parquet(folder).limit(0)


def parts_per_file(spark: SparkSession, folder: str) -> int:
    """Parquet files of each of the ``LOG_FILES`` files in ``folder``; a stream that takes so many at once reads file by file."""
    return len(_part_names(spark, folder)) // LOG_FILES


def _part_names(spark: SparkSession, folder: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith("part-")]


def _fill_up(spark: SparkSession, folder: str, files: int) -> None:
    """Add files without rows until ``folder`` holds ``files``: an empty task writes none."""
    missing = files - len(_part_names(spark, folder))
    if missing <= 0:
        return
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path(folder).getFileSystem(conf)
    spark.read.parquet(folder).limit(0).coalesce(1).write.mode("append").parquet(folder)
    empty = max((s for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("part-")),
                key=lambda s: s.getModificationTime()).getPath()
    for i in range(missing - 1):
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, empty, fs, path(folder, f"part-empty-{files}-{i}.parquet"), False, conf)


def blocklist_lines(spark: SparkSession, duplicate: bool = False) -> DataFrame:
    """Blocklist in its text form (IO7 input): rows plus a comment, a blank and a
    malformed line; ``duplicate`` appends a second line for an existing IP."""
    lines = ["# fixture blocklist"]
    lines += [f"{ip} # {cc} {asn} {org}" for ip, cc, asn, org in BLOCKLIST_ROWS]
    lines += ["", "not a blocklist line"]
    if duplicate:
        lines.append(f"{BLOCKLIST_ROWS[1][0]} # KR AS64500 Example Hosting B2")
    return spark.createDataFrame([(ln,) for ln in lines], "value string")
