import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from trafficlens.llm import turn_repair as TR

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def search(faulty):
    """Uniform-cost search over whole lists of (cost, audit); ``faulty`` are (role, text, fault)."""
    heap, seen = [(0, "", 0, ())], set()
    while heap:
        cost, audit, i, lines = heapq.heappop(heap)
        initials = "".join(x[:1] for x in lines)
        if i == len(faulty) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, "\n".join(lines)
        # what the grammar can still become depends on these; a later equal one is no better
        if (i, initials[-1:], len(initials) > 0) in seen:
            continue
        seen.add((i, initials[-1:], len(initials) > 0))
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[initials[-1:]]
        for role in ("user", "assistant"):
            if role[0] in allowed:
                heapq.heappush(heap, (cost + 3, audit + "I", i, lines + (f"{role}:",)))
        if i < len(faulty):
            role, text, fault = faulty[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, lines))
            if fault in (None, "truncated"):
                extra = 3 if fault else 0
                if role[:1] and role[0] in allowed:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, lines + (f"{role}:{text}",)))
                for other in ("user", "assistant"):
                    if other[0] in allowed:
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, lines + (f"{other}:{text}",)))


def brute(rows, ids):
    out = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in ids}
    for conv in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == conv],
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        faulty, seen = [], set()
        for _, _, role, text in own:
            last = VISIBLE.findall(text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = {r[1] for r in own} - {None}
        pairs = ["".join((x[0][:1], y[0][:1])) for x, y in zip(faulty, faulty[1:])]
        n = [f for *_, f in faulty]
        cost, audit, text = search(faulty)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n.count("blank"), n.count("duplicate"), n.count("truncated"),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def check(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions).withColumns(
        {c: F.lit("x") for c in ("place", "copy", "fault", "kind", "head", "part", "digest", "cost", "__id")})
    got = TR.repair(TR.damage(df), ids=df).collect()
    want = brute(damaged(rows), {r[0] for r in rows})
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], (r, want[r.conv_id])


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"]
TEXTS = ["Yes.", "No?", "open", "Done! \n", "", None, " \t", "a.b", "é.", "x" * 50_000 + ".", " "]


def drawn(rng, conv, n):
    rows, turn = [], rng.randrange(3)
    for _ in range(n):
        rows.append((conv, turn if rng.random() < 0.95 else None, rng.choice(ROLES), rng.choice(TEXTS) if rng.random() < 0.5 else f"t{rng.random()}."))
        turn += rng.choice([0, 1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("block", [1000, 2])
def test_against_search(spark, monkeypatch, block):
    monkeypatch.setattr(TR, "BLOCK", block)
    monkeypatch.setattr(TR, "FAN", 2)
    rng = random.Random(3)
    rows = [r for c in range(250) for r in drawn(rng, c, rng.randrange(1, 10))] + drawn(rng, None, 7)
    rows += [(900, t, "user", "only.") for t in range(4)]
    rows += rows[:40]  # repeated rows
    check(spark, rows)


def test_long_conversation(spark, monkeypatch):
    """A third of all rows in one conversation, cut by partitions and blocks."""
    monkeypatch.setattr(TR, "BLOCK", 7)
    monkeypatch.setattr(TR, "FAN", 3)
    rng = random.Random(8)
    rows = drawn(rng, 77, 300) + [r for c in range(60) for r in drawn(rng, c, 8)]
    check(spark, rows, partitions=6)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert TR.repair(TR.damage(df), ids=df).count() == 0


def test_product_is_associative():
    rng = random.Random(5)
    for _ in range(50):
        rows = [(rng.choice("suaxt"), rng.randrange(4)) for _ in range(12)]
        whole = TR.least_weights(rows, range(4))
        for cut in (1, 5, 11):
            a, b = TR.least_weights(rows[:cut], range(4)), TR.least_weights(rows[cut:], range(4))
            assert TR.join_weights(a, cut, b, 12 - cut) == whole
