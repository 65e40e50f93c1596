import math
import random
from collections import Counter

import pytest
from frames import docs
from trafficlens.llm import katz_lm as KZ
from trafficlens.llm import katz_tables as KT
from trafficlens.llm.common import crc_remainder

K = 5


def good_turing(counts):
    """Discounted counts by Katz: largest range of counts 1..k for which every ratio is sound."""
    n = Counter(counts)
    for k in range(K, 0, -1):
        if any(n[r] == 0 for r in range(1, k + 2)):
            continue
        common = (k + 1) * n[k + 1] / n[1]
        if common == 1:
            continue
        d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, k + 1)}
        if all(0 < x < 1 for x in d.values()):
            lost = k * (1 - d[k])  # higher counts lose as many occurrences as the last
            return {r: r - (r * (1 - d[r]) if r <= k else lost) for r in range(1, K + 1)}
    lost = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]))) if n[1] else 0.5
    return {r: r - lost for r in range(1, K + 1)}


class Brute:
    def __init__(self, texts, order):
        self.order = order
        self.grams = [Counter() for _ in range(order + 1)]
        for t in texts:
            w = self.tokens(t)
            for i in range(order - 1, len(w)):
                for k in range(1, order + 1):
                    self.grams[k][tuple(w[i - k + 1:i + 1])] += 1
        self.cut = [None] + [good_turing(g.values()) for g in self.grams[1:]]
        self.after = [{} for _ in range(order + 1)]
        for k in range(1, order + 1):
            for g, c in self.grams[k].items():
                self.after[k].setdefault(g[:-1], {})[g[-1]] = c

    def tokens(self, t):
        return ["<"] * (self.order - 1) + (t or "").encode().lower().split() + [">"]

    def p(self, h, w):
        seen = self.after[len(h) + 1].get(h)
        if seen is None:
            return self.p(h[1:], w) if h else 1.0
        plain = min(seen.values()) > K
        whole = sum(seen.values()) + plain
        kept = {x: self.cut[len(h) + 1].get(c, c) / whole for x, c in seen.items()}
        if w in kept:
            return kept[w]
        left = 1 - sum(kept.values())
        return left if not h else left / (1 - sum(self.p(h[1:], x) for x in seen)) * self.p(h[1:], w)

    def score(self, t):
        w = self.tokens(t)
        return sum(math.log10(self.p(tuple(w[i - self.order + 1:i]), w[i])) for i in range(self.order - 1, len(w)))


def texts(rng, n):
    words = [f"w{i}" for i in range(40)]
    out = []
    for _ in range(n):
        t = [rng.choice(words[:12] if rng.random() < 0.8 else words) for _ in range(rng.randrange(1, 25))]
        out.append((" \n".join(t)).upper() if rng.random() < 0.1 else " ".join(t))
    return out + ["a b a b a b a b a b a b a b", None, "", "w1 w2 w3"]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_stored_model_against_brute_force(spark, tmp_path, order):
    """A model trained on one table scores another one, unknown words and histories included."""
    rng = random.Random(order)
    known = texts(rng, 120) * 2
    KT.train(docs(spark, list(enumerate(known)), clashing=True), str(tmp_path / "m"), order)
    model = Brute(known, order)
    if order > 1:  # probabilities after a history add up to one
        h = tuple(["<"] * (order - 1))
        unknown = model.p(h, "never")
        assert abs(sum(model.p(h, g[0]) for g in model.grams[1]) + unknown - 1) < 1e-9
    other = texts(rng, 30) + ["new words here w1 w2", "w1 " * 30_000, "w1 w2 new w3 w4 w5"]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(other + other[:3])]
    got = KT.score(docs(spark, rows, clashing=True), str(tmp_path / "m")).collect()
    vocabulary = {g[0] for g in model.grams[1]}
    want = sorted(((i, len(model.tokens(t)) - order + 1, sum(w in vocabulary for w in model.tokens(t)[order - 1:]), round(model.score(t), 5))
                   for i, t in rows), key=repr)
    assert [(r[:3]) for r in sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.score, 5)) for r in got), key=repr)] == [w[:3] for w in want]
    for g, w in zip(sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.score, 5)) for r in got), key=repr), want):
        assert g[3] == pytest.approx(w[3], abs=1e-4, rel=1e-9)


def test_order_two_is_the_model_of_the_packed_form(spark, tmp_path):
    rng = random.Random(9)
    d = docs(spark, list(enumerate(texts(rng, 200))))
    KT.train(d.where(crc_remainder("doc_id", 10) != 0), str(tmp_path / "m"), 2)
    tables = {r.doc_id: r for r in KT.score(d, str(tmp_path / "m")).collect()}
    for r in KZ.score(d).collect():
        t = tables[r.doc_id]
        assert (t.n_tokens, t.n_known) == (r.n_tokens, r.n_known) and t.score == pytest.approx(r.score, abs=1e-6)


def test_nothing_to_learn_or_to_score(spark, tmp_path):
    KT.train(docs(spark, []), str(tmp_path / "none"), 3)
    assert [(r.n_tokens, r.n_known, r.score) for r in KT.score(docs(spark, [(1, "a b"), (None, None)]), str(tmp_path / "none")).orderBy("n_tokens").collect()] == [
        (1, 0, 0.0), (3, 0, 0.0)]
    KT.train(docs(spark, [(1, None)]), str(tmp_path / "one"), 2)
    assert KT.score(docs(spark, []), str(tmp_path / "one")).count() == 0
