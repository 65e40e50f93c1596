import random

from frames import docs
from trafficlens.llm import partenum_join as PJ
from trafficlens.llm.components import connected

rng = random.Random(5)


def text_of(words):
    return " ".join(words)


def edited(words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10 ** 9)}"
    return out


def brute(rows):
    """component of each row by comparing all pairs of sets"""
    sets = []
    for doc_id, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        k = find(i)
        if r[0] is not None:
            low[k] = min(low.get(k, r[0]), r[0])
    return [(r[0], len(s), low.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets))]


def check(spark, rows, **kw):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in PJ.classes(docs(spark, rows, **kw)).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_linked_sets_share_a_signature():
    bands = PJ.Bands()
    import numpy as np
    gen = np.random.default_rng(2)
    for size in [*range(1, 60), 80, 120, 333, 1000, 2500]:
        for _ in range(6):
            base = gen.integers(0, 2 ** 63, size + size // 4 + 2, dtype=np.uint64)
            cut = int(gen.integers(0, size // 4 + 1))
            a = np.unique(base[:size])
            b = np.unique(base[cut:cut + size + int(gen.integers(-(size // 8), size // 8 + 1))])
            if not len(b) or 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
                continue
            sig = [{int(v) for found in bands.signatures(x) for v in found} for x in (a, b)]
            assert sig[0] & sig[1], (len(a), len(b))
            # whatever is hot, either a shared signature is not, or both sets keep a shared hot one
            shared = np.array(sorted(sig[0] & sig[1]), np.uint64)
            for hot in (shared, shared[::2], shared[gen.random(len(shared)) < 0.8]):
                if set(shared.tolist()) <= set(hot.tolist()):
                    kept = [set(bands.not_withheld(x, hot).tolist()) for x in (a, b)]
                    assert kept[0] & kept[1], (len(a), len(b))


def test_bands():
    """Enough parts for the guarantee in every band, and few signatures."""
    import numpy as np
    gen = np.random.default_rng(4)
    bands = PJ.Bands()
    for size in [*range(1, 400, 3), 2000]:
        for band in bands.of(size):
            assert band.n1 - band.k // (band.k2 + 1) == 1 + band.spare
            if 6 <= band.low < PJ.LARGE:
                assert band.low / band.n1 * (band.n2 - band.k2) / band.n2 >= 2
        few = [sum(map(len, bands.signatures(np.unique(gen.integers(0, 2 ** 63, size, dtype=np.uint64))))) for _ in range(10)]
        assert np.mean(few) < 1.6 * size + 60


def test_sketches_bound_the_difference(spark):
    import numpy as np
    gen = np.random.default_rng(3)
    rows = []
    for size in (1, 3, 30, 70, 130, 400, 3000):
        base = gen.integers(0, 2 ** 63, size + size // 4, dtype=np.uint64)
        for n in (0, size // 20, size // 10, size // 5):
            a, b = np.unique(base[:size]), np.unique(base[n:size + n // 9])
            if len(b):
                linked = 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
                rows.append((len(a), len(b), PJ.sketch(a).tolist(), PJ.sketch(b).tolist(), linked))
        other = np.unique(gen.integers(0, 2 ** 63, size, dtype=np.uint64))
        rows.append((size, len(other), PJ.sketch(np.unique(base[:size])).tolist(), PJ.sketch(other).tolist(), False))
    df = spark.createDataFrame(rows, "n bigint, m bigint, x array<bigint>, y array<bigint>, linked boolean")
    got = df.withColumn("may", PJ.may_link("n", "m", "x", "y")).collect()
    assert all(r.may for r in got if r.linked)
    assert not got[-1].may and not got[-6].may


def test_against_all_pairs(spark):
    rows, k = [], 0
    for size in [1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 45, 60, 100, 200, 500]:
        base = [f"w{rng.randrange(10 ** 9)}" for _ in range(size)]
        for n in (0, 0, 1, 2, 4, size // 40 + 1, size // 25 + 1, size // 20 + 1):
            rows.append((k, text_of(edited(base, n) if n else base)))
            k += 1
        rows += [(k, text_of(base[:max(1, int(size * 0.85))])), (k + 1, text_of(base + base[:2])), (k + 2, text_of(base).upper())]
        k += 3
    rows += [(None, None), (k, None), (k + 1, ""), (k + 2, " \n"), (k + 3, "one"), (k + 4, "one"), (None, "one two"), (k + 5, "one two"), (k + 6, "É é")]
    rng.shuffle(rows)
    check(spark, rows, clashing=True)


def test_null_and_repeated_ids(spark):
    """A row without an id, and ids with several texts, are linked by their texts alone."""
    base = [f"w{i}" for i in range(60)]
    near, far = base[:55], base[:30] + [f"v{i}" for i in range(30)]
    rows = [(None, text_of(base)), (5, text_of(near)), (7, text_of(far)), (7, text_of(base + ["x"])), (9, text_of(far[:58])), (None, text_of(far)),
            (8, text_of(["lone"] * 9)), (8, "other words than that are here"), (None, "quite alone in here it is")]
    for g in range(12):  # id 100 + g: one text that is linked with 200 + g, and one just below
        own = [f"g{g}_{i}" for i in range(44)]
        rows += [(100 + g, text_of(own[:38])), (100 + g, text_of(own[:30] + [f"h{g}_{i}" for i in range(12)])), (200 + g, text_of(own))]
    check(spark, rows * 2, clashing=True)


def test_common_passage(spark, monkeypatch):
    """Short texts that share a passage: hot signatures are withheld, and no link is lost."""
    monkeypatch.setattr(PJ, "HOT", 4)
    passage = [f"p{i}" for i in range(14)]
    rows = []
    for i in range(300):
        own = [f"o{i}_{j}" for j in range(24)]
        rows.append((2 * i, text_of(own[:12] + passage + own[12:])))
        if i % 5 == 0:
            rows.append((2 * i + 1, text_of(own[:12] + passage + own[12:] + ["end"])))
    check(spark, rows)


def test_hot_groups(spark):
    base = [f"w{i}" for i in range(80)]
    rows = [(i, text_of(base)) for i in range(150)] + [(200 + i, text_of(edited(base, 1))) for i in range(150)]
    # a passage shared by texts that are not similar
    rows += [(1000 + i, text_of(base[:40] + [f"u{i}_{j}" for j in range(25)])) for i in range(120)]
    check(spark, rows)


def test_long_text_and_empty_table(spark):
    long = text_of(f"w{i}" for i in range(100_000))
    got = PJ.classes(docs(spark, [(5, long), (3, long + " end"), (4, "x " * 100_000)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (4, 4), (5, 3)]
    assert PJ.classes(docs(spark, [])).count() == 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (300, 300), (7, 3)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}
