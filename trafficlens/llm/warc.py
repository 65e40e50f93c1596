"""WARC archives: writing, and a salvage reader that survives damage.

Writing: each row becomes one WARC/1.1 record; Spark's text writer ends every
record with the two line ends of the format, so a lost task is rerun by the
usual commit protocol.  Payloads equal in length and SHA-1 are stored once, as
the response with the smallest id; later ones are revisit records.

Reading: an archive is read record by record and each record is checked (version
line, headers, length, ending, digest; of a revisit also that it names a
payload).  Where a check fails, the reader looks
for the next place that can start a record - a gzip member or a version line -
goes on from the first that passes the checks, and logs the bytes between as a
quarantined gap.  Plain and per-record gzip archives are read alike.

Defined cases: a null payload is empty; a null id gives a record without one;
rows with the same smallest id and equal payloads are all responses; an empty
table gives no records; an empty archive neither records nor gaps.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_side, stage_path

VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")
GZIP = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
BASE32_SHA1 = re.compile(r"sha1:[A-Z2-7]{32}", re.I)
FILE_BYTES, HEADER_BYTES = 64 << 20, 500  # of an archive, about; of a record's headers
DATE = "2024-01-01T00:00:00Z"
PAGE = "urn:page:"

RECORDS = ("archive string, at bigint, record_id string, record_type string, refers_to string, target_uri string, "
           "payload_digest string, payload_bytes bigint, payload binary, gap_start bigint, gap_end bigint, reason string")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, from 5 hex digits at a time."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def prepare(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, refers_to`` for every row.

    ``refers_to`` is the smallest id with an equal payload of at least
    ``least_bytes`` bytes where that is another row's, else null.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("payload"),
                        F.octet_length(body).cast("bigint").alias("payload_bytes"),
                        base32_sha1(body.cast("binary")).alias("payload_digest"))
    same = (rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
            .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) & F.col("first").isNotNull()).drop("n"))
    n = same.count()  # of payloads that occur more than once
    joined = rows.join(small_side(same, n, 80), ["payload_digest", "payload_bytes"], "left")
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def record_text(rows: DataFrame) -> DataFrame:
    """One column ``value``: the record without its ending."""
    revisit = F.col("refers_to").isNotNull()
    field = lambda name, value: F.coalesce(F.concat(F.lit(name + ": "), value, F.lit("\r\n")), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    uri = F.regexp_replace("url", r"[\r\n]+", " ")
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", F.concat(F.lit(f"<{PAGE}"), F.col("page_id").cast("string"), F.lit(">"))),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", uri),
        field("WARC-Refers-To", F.concat(F.lit(f"<{PAGE}"), F.col("refers_to").cast("string"), F.lit(">"))),
        field("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block).alias("value"))


def write(rows: DataFrame, path: str, records_per_file: int | None = None) -> None:
    """Write prepared rows as plain WARC archives below ``path``.

    By default a file takes as many records as make ``FILE_BYTES`` at the mean
    size of all records, so it can be read whole by one task.
    """
    if records_per_file is None:
        mean = rows.agg(F.avg(F.octet_length("payload"))).first()[0] or 0
        records_per_file = max(1, int(FILE_BYTES // (mean + HEADER_BYTES)))
    (record_text(rows).write.option("lineSep", END.decode()).option("maxRecordsPerFile", records_per_file).text(path))


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.split(b"\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().decode("latin-1").lower(), value.strip().decode("utf-8", "replace"))
    return out


def parse_record(data, at: int, ending: bool = True):
    """(record, end) of the record at ``at``, or the reason why there is none."""
    start = VERSION.match(data, at)
    if not start:
        return "no version line"
    cut = re.compile(rb"\r?\n\r?\n").search(data, at)
    if not cut:
        return "headers do not end"
    head = _headers(bytes(data[at:cut.start()]))
    length = head.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length) or "warc-type" not in head:
        return "a required header is missing"
    end = cut.end() + int(length)
    if end > len(data):
        return "record is cut off"
    if ending and data[end:end + 4] != END:
        return "record does not end where it should"
    block = bytes(data[cut.end():end])
    payload = block
    if "application/http" in head.get("content-type", ""):
        http = re.search(rb"\r?\n\r?\n", block)
        payload = block[http.end():] if http else b""
        told = _headers(block[:http.start()] if http else block).get("content-length", "")
    else:
        told = ""
    digest = hashlib.sha1(payload).digest()
    claimed = head.get("warc-payload-digest", "")
    if head["warc-type"] == "revisit" and not (BASE32_SHA1.fullmatch(claimed) and head.get("warc-refers-to", "").strip("<>")):
        return "revisit names no payload"
    if head["warc-type"] != "revisit" and claimed.startswith("sha1:") \
            and claimed[5:].upper() != base64.b32encode(digest).decode():
        return "payload digest differs"
    bare = lambda v: v.strip("<>") if v is not None else None
    return {"record_id": bare(head.get("warc-record-id")), "record_type": head["warc-type"],
            "refers_to": bare(head.get("warc-refers-to")), "target_uri": head.get("warc-target-uri"),
            "payload_digest": claimed[5:] if claimed.startswith("sha1:") else base64.b32encode(digest).decode(),
            "payload_bytes": int(told) if head["warc-type"] == "revisit" and told.isdigit() else len(payload),
            "payload": payload}, end + (4 if ending else 0)


def inflate(data, at: int):
    """(bytes, end) of the gzip member at ``at``, or the reason why it cannot be read."""
    d = zlib.decompressobj(31)
    out, i = [], at
    try:
        while not d.eof and i < len(data):
            piece = bytes(data[i:i + (1 << 16)])
            out.append(d.decompress(piece))
            i += len(piece)
    except zlib.error as e:
        return f"gzip member: {e}"
    if not d.eof:
        return "gzip member is cut off"
    return b"".join(out), i - len(d.unused_data)


def record_at(data, at: int):
    if data[at:at + 3] == GZIP:
        found = inflate(data, at)
        if isinstance(found, str):
            return found
        inner = parse_record(found[0], 0)
        return inner if isinstance(inner, str) else (inner[0], found[1])
    return parse_record(data, at)


def salvage(data: bytes):
    """Yield ("record", at, record) and ("gap", start, end, reason) for the whole archive."""
    at = 0
    start_of = re.compile(re.escape(GZIP) + rb"|" + VERSION.pattern)
    while at < len(data):
        found = record_at(data, at)
        if not isinstance(found, str):
            yield "record", at, found[0]
            at = found[1]
            continue
        reason, begin = found, at
        for m in start_of.finditer(data, at + 1):
            if not isinstance(record_at(data, m.start()), str):
                at = m.start()
                break
        else:
            at = len(data)
        yield "gap", begin, at, reason


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Every record and every gap of the archives below ``path`` (columns ``RECORDS``).

    Archives are dealt out as whole files; a gap has ``gap_start``, ``gap_end``
    and ``reason`` and null record columns.
    """
    names = [x.rpartition(" ")[0] for x in RECORDS.split(", ")]
    types = [{"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[x.rpartition(" ")[2]] for x in RECORDS.split(", ")]

    def run(batches):
        def pack(rows):
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names=names)

        for b in batches:
            for name, data in zip(b.column("path"), b.column("content")):
                data, rows, held = data.as_py(), [], 0
                for kind, at, *rest in salvage(data):
                    if kind == "record":
                        row = {"archive": name.as_py(), "at": at} | rest[0]
                        if not payload:
                            row["payload"] = None
                    else:
                        row = {"archive": name.as_py(), "gap_start": at, "gap_end": rest[0], "reason": rest[1]}
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, RECORDS)


def unresolved(records: DataFrame) -> DataFrame:
    """The revisit records of :func:`read` whose response is not there with the digest they claim."""
    known = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), "payload_digest").distinct()
    return records.where("record_type = 'revisit'").join(known, ["refers_to", "payload_digest"], "left_anti")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back: one row per record.

    A gap in what was just written is an error, as a record would be lost.
    """
    path = stage_path(pages.sparkSession, "warc")
    write(prepare(pages, least_bytes=least_bytes), path)
    page = lambda c: F.when(F.col(c).startswith(PAGE), F.substring(c, len(PAGE) + 1, 20)).cast("bigint")
    lost = F.raise_error(F.concat_ws(" ", F.lit("gap in a written archive:"), "archive", "gap_start", "gap_end", "reason"))
    got = read(pages.sparkSession, path, payload=False).where(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(lost.cast("boolean")))
    return got.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      page("refers_to").alias("refers_to"))


# SHA-1 in DuckDB is hexadecimal; base32 is spelled from its bits
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (
  SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex FROM p),
g AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first_id,
         CAST(from_hex(hex) AS BIT) AS bits FROM h)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * get_bit(bits, (5 * k)::INT) + 8 * get_bit(bits, (5 * k + 1)::INT) + 4 * get_bit(bits, (5 * k + 2)::INT)
           + 2 * get_bit(bits, (5 * k + 3)::INT) + get_bit(bits, (5 * k + 4)::INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM g
"""
