from collections import defaultdict

from frames import docs
from pyspark.sql import functions as F
from trafficlens.llm import source_mixing as SM


def fill(sizes, weights, cap):
    """targets by clamping and sharing again until none is above its cap"""
    target, open_ = {}, set(sizes)
    left = sum(sizes.values())
    while open_:
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w >= cap * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / w for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def mixed(spark, rows, **kw):
    sized = SM.sized(docs(spark, rows, **kw))
    return SM.mix(sized, SM.cyclic_weights(sized), 3)


def check(spark, rows, **kw):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = fill(dict(sizes), {s: 1 + i % 3 for i, s in enumerate(order)}, 3)
    got = mixed(spark, rows, **kw).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
    return got


def test_hot_small_and_null_sources(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "hot") for i in range(300)] + [(1000 + i, "a b c", "en", "b") for i in range(4)]
    rows += [(2000, "x " * 5000, "en", "c"), (None, "q r", "en", None), (None, None, "en", None), (3000, "", "en", "é"), (3001, None, "en", "d"), (5, "w w", "en", "hot"), (5, "w w", "en", "hot")]
    got = check(spark, rows, clashing=False)
    again = mixed(spark, rows)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r["size"], r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again.collect()))
    check(spark, rows[:50] + rows[-5:], clashing=True)


def test_single_source_and_empty(spark):
    assert all(r.taken == r["size"] for r in check(spark, [(i, "w w", "en", "s") for i in range(5)]))
    assert mixed(spark, []).count() == 0
    assert [r.taken for r in mixed(spark, [(1, None, "en", "s"), (2, "", "en", "t")]).collect()] == [0, 0]


def test_repeat_matches_taken(spark):
    rows = [(i, f" doc  {i}\tw " * (1 + i % 5), "en", f"s{i % 4}") for i in range(60)] + [(99, "long " * 3000, "en", "s9")]
    m = mixed(spark, rows)
    out = SM.repeat(m, ["doc_id", "text", "lang", "source", "n_chars"])
    words = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(SM.word_count()).alias("n")).collect()}
    assert {r.doc_id: r.taken for r in m.collect() if r.taken} == words
