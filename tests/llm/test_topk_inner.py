import math
import random

import frames  # noqa: F401  (ships the package to the workers)
from pyspark.sql import functions as F

from trafficlens.llm import topk_inner as TK

SCHEMA = "vec_id bigint, embedding array<float>, label int, vec string, stripe string, rank string"


def brute(rows, k):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in good), default=0)
    good = [(i, v + [0] * (dim - len(v))) for i, v in good]
    queries = {}
    for i, v in good:
        if i % 20 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def check(spark, rows, k=20):
    df = spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], SCHEMA)
    got = TK.search(TK.quantised(df), F.col("vec_id") % 20 == 0, k)
    rows = [(i, [float(F32(x)) if x is not None else None for x in v] if v is not None else None) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == brute(rows, k)


def F32(x):
    import numpy as np
    return np.float32(x)


def test_against_all_pairs(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, rng.choice([0.1, 1, 3])) for _ in range(24)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 24) for i in range(300)]  # one very common vector: ties
    old = TK.ROWS, TK.QUERIES, TK.STEP
    TK.ROWS, TK.QUERIES, TK.STEP = 300, 16, 64
    try:
        check(spark, rows)
    finally:
        TK.ROWS, TK.QUERIES, TK.STEP = old


def test_odd_rows(spark):
    check(spark, [(0, [1.0, 2.0]), (0, [1.0, 1.0]), (20, []), (None, [9.0, 9.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]),
                  (4, [float("inf"), 1.0]), (5, [3.0]), (6, [-1.0, -1.0, 5.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0])], k=3)


def test_few_rows_and_none(spark):
    check(spark, [(20, [1.0])])
    check(spark, [(1, [1.0]), (2, [2.0])])
    check(spark, [])


def test_later_ranges_meet_few_queries(spark, monkeypatch):
    """Lengths fall off: ranges of short rows are sent only queries that they can still reach."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * 30 * 0.9965 ** i for _ in range(8)]) for i in range(1600)]
    rng.shuffle(rows)
    monkeypatch.setattr(TK, "FIRST", 200)
    monkeypatch.setattr(TK, "GROWTH", 2)
    monkeypatch.setattr(TK, "ROWS", 150)
    monkeypatch.setattr(TK, "QUERIES", 16)
    check(spark, rows, k=5)
    report = []
    df = spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], SCHEMA)
    n_found = TK.search(TK.quantised(df), F.col("vec_id") % 20 == 0, 5, report).count()
    n, n_q = len(rows), 80
    assert n_found == 5 * n_q and sum(m for m, _, _ in report) == n and len(report) >= 3
    assert report[0][1] == n_q and report[-1][1] < n_q // 2  # pairs of range and query are skipped
    assert sum(m for m, sent, _ in report if sent) + sum(sent for _, sent, _ in report) < n + n_q * len(report)


def test_equal_lengths_and_negative_products(spark, monkeypatch):
    monkeypatch.setattr(TK, "FIRST", 20)
    monkeypatch.setattr(TK, "GROWTH", 2)
    check(spark, [(i, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(120)], k=7)
    check(spark, [(i, [-1.0 - i, 2.0] if i % 20 else [5.0 + i, -1.0]) for i in range(150)], k=4)
