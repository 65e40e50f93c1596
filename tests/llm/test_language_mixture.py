import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from frames import docs
from trafficlens.llm import language_mixture as LM
from trafficlens.llm.common import crc_remainder, id_remainder, read

EN = "the quick brown fox jumps over the lazy dog and then rests in the shade of the old tree "
DE = "der schnelle braune Fuchs springt über den faulen Hund und ruht dann im Schatten des Baumes "


def model(spark):
    return LM.train(docs(spark, [(1, EN * 5, "en"), (2, DE * 5, "de"), (3, EN, None), (4, None, "fr")]), F.lit(True))


def test_mixture_and_edges(spark):
    langs, table = model(spark)
    assert langs == ["de", "en"]
    rows = [(1, EN * 3), (2, DE * 3), (3, EN * 10 + DE * 10), (4, None), (5, ""), (6, "123 ... !!"), (7, EN * 20_000), (1, EN * 3), (None, DE)]
    out = LM.identify(docs(spark, rows, clashing=True), langs, table, keep=("doc_id",)).collect()
    got = [(r.doc_id, r.lang_pred, round(r.score, 1), r.langs) for r in out]
    assert got[0] == (1, "en", 1.0, ["en"]) and got[1] == (2, "de", 1.0, ["de"])
    assert set(got[2][3]) == {"de", "en"} and 0.4 < out[2].score < 0.65
    assert [g[1:3] for g in got[3:6]] == [("und", 0.0)] * 3
    assert got[6][1] == "en" and got[7] == got[0] and got[8][1] == "de"


def test_proportions_recover_a_mixture():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.full(400, 0.1), 3) + 1e-9
    n = rng.multinomial(20_000, np.array([0.6, 0.3, 0.1]) @ p / (np.array([0.6, 0.3, 0.1]) @ p).sum()).astype(float)
    pi, _ = LM.proportions(p, n, 200, 1e-9)
    assert np.allclose(pi, [0.6, 0.3, 0.1], atol=0.02)


def test_blocks_change_nothing():
    letters = LM.letter_table()
    whole = LM.trigram_hashes(EN * 50, letters)
    block, LM.BLOCK = LM.BLOCK, 97
    try:
        assert (LM.trigram_hashes(EN * 50, letters) == whole).all()
    finally:
        LM.BLOCK = block


def test_empty_table(spark):
    langs, table = LM.train(docs(spark, []), F.lit(True))
    assert langs == []
    assert LM.identify(docs(spark, []), langs, table).count() == 0
    assert [r.lang_pred for r in LM.identify(docs(spark, [(1, EN)]), langs, table).collect()] == ["und"]


def test_held_out_accuracy(spark):
    d = read(spark, "/root/testdata/sf0.01", "documents")
    langs, table = LM.train(d, crc_remainder("doc_id", 3) != 1)
    rows = LM.identify(d, langs, table, keep=("doc_id", "lang")).collect()
    held = [r for r in rows if id_remainder(r.doc_id, 3) == 1]
    assert len(rows) == d.count() and sum(r.lang_pred == r.lang for r in held) > 0.97 * len(held)


def plain_infer(hashes, model, penalty):
    """The same choice with dictionaries and loops: EM over all languages, then the growing sets."""
    n = {}
    for h in hashes.tolist():
        n[h] = n.get(h, 0) + 1
    total = sum(n.values())

    def em(ks):
        pi = {k: 1 / len(ks) for k in ks}
        for _ in range(40):
            new = dict.fromkeys(ks, 0.0)
            for h, c in n.items():
                mass = sum(pi[k] * model[k][h] for k in ks)
                for k in ks:
                    new[k] += c * pi[k] * model[k][h] / mass / total
            moved = max(abs(new[k] - pi[k]) for k in ks)
            pi = new
            if moved < 1e-4:
                break
        return pi, sum(c * math.log(sum(pi[k] * model[k][h] for k in ks)) for h, c in n.items())

    alone = [sum(c * math.log(model[k][h]) for h, c in n.items()) for k in range(len(model))]
    best, value = [(alone.index(max(alone)), 1.0)], max(alone)
    order = sorted(range(len(model)), key=lambda k, f=em(range(len(model)))[0]: -f[k])
    for size in range(2, len(model) + 1):
        pi, ll = em(sorted(order[:size]))
        ll -= (size - 1) * penalty * math.log(total + 1)
        if ll <= value:
            break
        value, best = ll, sorted(pi.items(), key=lambda kx: (-kx[1], kx[0]))
    return best


def test_inference_against_plain_python():
    rng = np.random.default_rng(4)
    model = rng.dirichlet(np.full(60, 0.3), 4) + 1e-4
    model /= model.sum(1, keepdims=True)
    sizes = set()
    for weights in ([1, 0, 0, 0], [0.5, 0.5, 0, 0], [0.4, 0.3, 0.3, 0], [0.25] * 4, [0.9, 0.1, 0, 0], [0, 0, 0.2, 0.8]):
        for length in (3, 40, 600):
            for penalty in (0.5, 4.0):
                h = rng.choice(60, length, p=np.array(weights) @ model / (np.array(weights) @ model).sum()).astype(np.uint16)
                got, want = LM.infer(h, model, penalty), plain_infer(h, model, penalty)
                assert [k for k, _ in got] == [k for k, _ in want] and np.allclose([x for _, x in got], [x for _, x in want], atol=1e-6)
                sizes.add(len(got))
    assert sizes >= {1, 2, 3}  # sets of several languages are chosen where they pay


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(LM, "MAX_LANGUAGES", 3)
    rows = [(i, EN, f"l{i}") for i in range(4)]
    assert len(LM.train(docs(spark, rows[:3]), F.lit(True))[0]) == 3
    with pytest.raises(ValueError, match="more than 3 languages"):
        LM.train(docs(spark, rows), F.lit(True))
