import base64
import gzip
import hashlib
import re

import pytest

import frames  # noqa: F401  (ships the package to the workers)
from trafficlens.llm import warc as WA

SCHEMA = "page_id bigint, url string, html string, payload string, record_type string, first string"


def record(i, body, kind="response", ending=True):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    digest = base64.b32encode(hashlib.sha1(body).digest())
    return (b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Type: application/http; msgtype=response\r\n"
            b"WARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n" % (kind.encode(), i, digest, len(block)) + block + b"\r\n\r\n" * ending)


def ids(data):
    return [x[2]["record_id"] for x in WA.salvage(data) if x[0] == "record"], [x[1:] for x in WA.salvage(data) if x[0] == "gap"]


def test_salvage():
    r = [record(i, b"body WARC/1.0\r\n %d" % i) for i in range(4)]
    name = [f"urn:page:{i}" for i in range(4)]
    assert ids(b"") == ([], []) and ids(b"".join(r)) == (name, [])
    junk = b"\x00junk\r\n"
    got, gaps = ids(r[0] + junk + r[1] + r[2])
    assert got == name[:3] and gaps == [(len(r[0]), len(r[0] + junk), "no version line")]
    broken = r[1].replace(b"body", b"BODY")
    got, gaps = ids(r[0] + broken + r[2])
    assert got == [name[0], name[2]] and gaps == [(len(r[0]), len(r[0] + broken), "payload digest differs")]
    got, gaps = ids(r[0] + r[1][:-30] + r[2])  # shortened: the length runs into the next record
    assert got == [name[0], name[2]] and gaps[0][:2] == (len(r[0]), len(r[0]) + len(r[1]) - 30)
    got, gaps = ids(r[0] + r[3][:50])
    assert got == name[:1] and gaps == [(len(r[0]), len(r[0]) + 50, "headers do not end")]
    assert ids(junk) == ([], [(0, len(junk), "no version line")])


def test_salvage_of_gzip_members():
    z = [gzip.compress(record(i, b"<p>%d</p>" % i * 50)) for i in range(4)]
    bad = bytearray(z[1])
    bad[len(bad) // 2] ^= 255
    got, gaps = ids(z[0] + bytes(bad) + z[2] + z[3][:-9])
    assert got == ["urn:page:0", "urn:page:2"] and [g[:2] for g in gaps] == [(len(z[0]), len(z[0]) + len(z[1])), (len(z[0] + z[1] + z[2]), len(z[0] + z[1] + z[2] + z[3]) - 9)]
    assert ids(record(1, b"x") + z[2]) == (["urn:page:1", "urn:page:2"], [])


def test_round_trip(spark):
    rows = [(5, "u", "same"), (3, "u\r\nWARC/1.0", "same"), (3, "u", "same"), (9, "u", "same"), (7, None, None), (8, "u", ""), (None, "u", "x"),
            (10, "u", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"), (11, "u", "y" * 3_000_000), (None, "u", "same")]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    got = sorted(map(tuple, WA.round_trip(df).collect()), key=repr)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        f = first.get(h or "")
        other = f is not None and f != i
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if other else "response", f if other else None))
    assert got == sorted(want, key=repr)
    assert WA.round_trip(df.limit(0)).count() == 0
    assert {r.record_type for r in WA.round_trip(df, least_bytes=10).collect()} == {"response"}


def test_revisits_are_checked(spark, tmp_path):
    sound = record(1, b"text")
    revisit = record(2, b"text", "revisit").replace(b"WARC-Record-ID", b"WARC-Refers-To: <urn:page:1>\r\nWARC-Record-ID")
    digest = re.search(rb"sha1:(\w+)", revisit)[1]
    garbage = revisit.replace(digest, b"GARBAGE")
    assert ids(sound + revisit)[0] == ["urn:page:1", "urn:page:2"]
    got, gaps = ids(sound + garbage + sound)
    assert got == ["urn:page:1"] * 2 and gaps == [(len(sound), len(sound + garbage), "revisit names no payload")]
    assert ids(sound + record(2, b"text", "revisit"))[0] == ["urn:page:1"]  # refers to nothing
    other = revisit.replace(digest, digest[::-1])
    (tmp_path / "a.warc").write_bytes(sound + revisit + other)
    assert [r.payload_digest for r in WA.unresolved(WA.read(spark, str(tmp_path))).collect()] == [digest[::-1].decode()]


def test_files_are_cut_by_bytes_and_lost_records_are_an_error(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, "u", f"{i}" + "z" * 200_000, "a", "b", "c") for i in range(30)], SCHEMA).coalesce(1)
    monkeypatch.setattr(WA, "FILE_BYTES", 1 << 20)
    WA.write(WA.prepare(df), str(tmp_path / "w"))
    sizes = [f.stat().st_size for f in (tmp_path / "w").glob("part-*")]
    assert len(sizes) >= 5 and max(sizes) < 1.2 * (1 << 20)
    write = WA.write

    def damaged(rows, path):
        write(rows, path)
        from pathlib import Path
        f = next(Path(path.removeprefix("file://").removeprefix("file:")).glob("part-*"))
        data = bytearray(f.read_bytes())
        data[len(data) // 2] ^= 1
        f.write_bytes(bytes(data))
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)

    monkeypatch.setattr(WA, "write", damaged)
    with pytest.raises(Exception, match="gap in a written archive"):
        WA.round_trip(df).collect()


def test_read_logs_gaps(spark, tmp_path):
    r = [record(i, b"text %d" % i) for i in range(3)]
    (tmp_path / "a.warc").write_bytes(r[0] + b"????" + r[1])
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(r[2]) + b"tail")
    (tmp_path / "empty.warc").write_bytes(b"")
    rows = WA.read(spark, str(tmp_path)).collect()
    assert sorted(x.payload for x in rows if x.record_type) == [b"text 0", b"text 1", b"text 2"]
    assert sorted((x.archive.split("/")[-1], x.gap_end - x.gap_start) for x in rows if x.reason) == [("a.warc", 4), ("b.warc.gz", 4)]
