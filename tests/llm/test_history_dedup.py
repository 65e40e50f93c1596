import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from frames import docs
from trafficlens.llm import common
from trafficlens.llm import history_dedup as HD

BLANKS = set(" \t\n\x0b\x0c\r")


def brute(rows):
    """(doc_id, keep_id, size) per row and the number kept, by a dictionary of stripped texts"""
    held = {}
    for doc_id, text, *_ in rows:
        held.setdefault("".join(c for c in text or "" if c not in BLANKS), []).append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for doc_id, text, *_ in rows:
        g = held["".join(c for c in text or "" if c not in BLANKS)]
        best = min(g)
        out.append((doc_id, None if best[1] else best[2], len(g)))
    return sorted(out, key=repr), len(held)


def check(spark, rows, seen, **kw):
    got = HD.dedup(docs(spark, rows, **kw), seen).collect()
    want, n = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == n and len({bytes(r.digest) for r in kept}) == n  # one row of each group
    assert all(r.doc_id == r.keep_id for r in kept)


def test_perfect_hash():
    gen = np.random.default_rng(1)
    for n in (0, 1, 2, 9, 1000, 30_000):
        words = gen.integers(0, 2 ** 63, (n, 4), dtype=np.uint64)
        if n > 9:
            words[:n // 2, :3] = 7  # digests that agree in three of their four words
        sizes, bits = HD.perfect_hash(words)
        assert sorted(HD.slots_of(words, sizes, bits)) == list(range(n))
        other = gen.integers(0, 2 ** 63, (500, 4), dtype=np.uint64)
        at = HD.slots_of(other, sizes, bits)
        assert ((-1 <= at) & (at < max(n, 1))).all()


CASES = [(1, None), (2, ""), (3, " \n\t"), (None, ""), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "a\x0b\x0c b"), (None, "a  b  "), (8, "a b"),
         (9, "A b"), (4, "a b"), (4, "a b"), (10, "x" * 300_000), (11, "x " * 300_000), (12, "é e"), (13, "\x1c"), (14, "\x00"), (15, "z"), (15, "z\n")]


@pytest.mark.parametrize("seen", ["doc_id % 2 = 0", "false", "true", "cast(null as boolean)"])
def test_edge_cases(spark, seen):
    check(spark, CASES, F.expr(seen), clashing=True)


def test_many_shards_and_hot_groups(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, rng.choice(["hot  text", "hot text", f"t {i % 700}", f"u{i}"])) for i in range(4000)] + [(5, "t 5")] * 3
    monkeypatch.setattr(HD, "SHARD", 100)
    check(spark, rows, F.col("doc_id") % 10 == 0)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)  # hot groups broadcast, the rest by a shuffle join
    monkeypatch.setattr(HD, "HOT_GROUPS", 40)
    check(spark, rows, F.col("doc_id") % 10 != 0)


def test_empty_table(spark):
    assert HD.dedup(docs(spark, []), F.col("doc_id") > 0).count() == 0


def test_saved_history(spark, tmp_path, monkeypatch):
    """A reopened history decides members by the bytes of their digests."""
    monkeypatch.setattr(HD, "SHARD", 50)
    first = HD.groups(HD.digests(docs(spark, [(i, f"text {i}") for i in range(300)]))).persist()
    HD.History.build(first, str(tmp_path / "h"))
    history = HD.History.open(spark, str(tmp_path / "h"))
    assert (history.n, history.shards) == (300, 6)
    slots = [r.slot for r in history.slots().collect()]
    assert len(set(slots)) == 300
    again = HD.groups(HD.digests(docs(spark, [(1000 + i, f"te xt{i}") for i in range(250, 350)]))).persist()
    got = history.lookup(again, 100).collect()
    assert len(got) == 100 and sum(r.slot is not None for r in got) == 50
    known = {bytes(r.digest) for r in first.collect()}
    assert all((r.slot is not None) == (bytes(r.digest) in known) for r in got)
    total = HD.merged(history, history.lookup(again, 100))
    assert sorted(r.n_rows for r in total.collect()) == [1] * 300 + [2] * 50
