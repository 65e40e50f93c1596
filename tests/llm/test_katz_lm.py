import math
from collections import Counter, defaultdict

import pytest
from frames import docs
from trafficlens.llm import katz_lm as KZ
from trafficlens.llm.common import id_remainder, read

END = b" end"


class Brute:
    """The model of the docstring, with dictionaries."""

    def __init__(self, texts):
        self.uni, self.bi = Counter(), Counter()
        for t in texts:
            w = self.tokens(t)
            self.uni.update(w)
            self.bi.update(zip([None] + w[:-1], w))
        self.n = sum(self.uni.values())
        types = lambda c: [Counter(c.values())[r] for r in range(1, KZ.K + 2)]
        self.du, self.db = KZ.discounts(types(self.uni)), KZ.discounts(types(self.bi))
        cut = lambda d, c: d[c - 1] * c if c <= KZ.K else c
        plain = all(c > KZ.K for c in self.uni.values())
        self.p1 = {w: cut(self.du, c) / (self.n + plain) for w, c in self.uni.items()}
        self.unknown = 1 - sum(self.p1.values()) if self.n else 1.0
        self.total, self.mass, self.held, low = Counter(), defaultdict(float), defaultdict(float), set()
        for (a, b), c in self.bi.items():
            self.total[a] += c
            self.mass[a] += cut(self.db, c)
            self.held[a] += self.p1[b]
            low |= {a} if c <= KZ.K else set()
        self.room = {a: 0 if a in low else 1 for a in self.total}
        self.cut = cut

    @staticmethod
    def tokens(t):
        return (t or "").encode().lower().split() + [END]

    def p(self, a, b):
        c, n = self.bi.get((a, b), 0), self.total.get(a, 0)
        if c:
            return self.cut(self.db, c) / (n + self.room[a])
        p1 = self.p1.get(b, self.unknown)
        return (1 - self.mass[a] / (n + self.room[a])) / (1 - self.held[a]) * p1 if n else p1

    def score(self, t):
        w = self.tokens(t)
        return sum(math.log10(self.p(a, b)) for a, b in zip([None] + w[:-1], w))

    def base(self, t):
        v = len(self.uni)
        return sum(math.log10((self.uni.get(b, 0) + 0.1) / (self.n + 0.1 * (v + 1))) for b in self.tokens(t))


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    m = Brute([t for i, t in rows if id_remainder(i, 10)])
    want = sorted(((i, len(m.tokens(t)), sum(w in m.uni for w in m.tokens(t)), m.n, round(m.base(t), 6), round(m.score(t), 6)) for i, t in rows), key=repr)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in KZ.score(df).collect()), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], abs=1e-5) and g[5] == pytest.approx(w[5], abs=1e-5)
    return m


@pytest.fixture
def small_parts():
    old = KZ.CHUNK, KZ.PIECE, KZ.PER_BUCKET
    KZ.CHUNK, KZ.PIECE, KZ.PER_BUCKET = 3000, 300, 2500
    yield
    KZ.CHUNK, KZ.PIECE, KZ.PER_BUCKET = old


def test_probabilities_add_up_to_one():
    m = Brute(["a b a b a c", "a b b", "x a b a d", "e e e e e e e e e", None] * 2 + ["q r s t"])
    for a in [None, *m.uni]:
        assert sum(m.p(a, b) for b in m.uni) + m.p(a, b"never") == pytest.approx(1)


def test_against_dictionaries(spark, small_parts):
    check(read(spark, "/root/testdata/sf0.001", "documents"))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "A b a B\x0bc"), (4, "a b " * 30), (4, "a b " * 30), (None, "z z"), (5, "É é w"), (6, "u v " * 9)]
    rows += [(i, "z unknown a b u q") for i in range(7, 60)]
    check(docs(spark, rows, clashing=True))


def test_a_history_without_discounts(spark, small_parts):
    # 'k' is always followed by 'l', often: its left-over mass comes from one more token
    rows = [(i, "k l m%d k l" % i) for i in range(1, 400)]
    held = next(i for i in range(1000, 2000) if id_remainder(i, 10) == 0)
    check(docs(spark, rows + [(held, "k m k z z k")]))


def test_no_training_text_and_empty_table(spark):
    held = next(i for i in range(100) if id_remainder(i, 10) == 0)
    got = KZ.score(docs(spark, [(held, "a b")])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0)]
    assert KZ.score(docs(spark, [])).count() == 0


def test_packing():
    import numpy as np
    for a in ([], [0], [0, 255, 256, 70_000, 2 ** 40]):
        assert KZ.unpack(KZ.pack(np.array(a, np.int64))).tolist() == a
    assert [x.tolist() for x in KZ.unpack_all(KZ.pack_all([np.array([1, 2]), np.array([], np.int64)]))] == [[1, 2], []]


def test_discounts_lie_between_zero_and_one():
    for types in ([100, 50, 30, 20, 15, 12], [5, 0, 0, 0, 0, 0], [0] * 6, [1, 1, 1, 1, 1, 1], [100, 10, 50, 2, 1, 7], [10, 20, 1, 0, 0, 0]):
        assert all(0 < d < 1 for d in KZ.discounts(types)), types
