import math
import zlib

import numpy as np
import pytest

from frames import docs
from trafficlens.llm import quality_bytes_cnn as QC
from trafficlens.llm import quality_divergence as QD
from trafficlens.llm.common import crc_remainder, id_remainder, read

SF = "/root/testdata/sf0.01"


def brute(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    lines = [x for x in (text or "").split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, t in enumerate(tri):
        if tri.count(t) > 1:
            hit |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


def test_base_counts():
    texts = [None, "", " \n\t", "a b c a b c", "a a a a", "a b c", "x\nx\n\ny\nx\r\n", "é ü #1 | <b>", "a\x0bb\x0cc\x1cd",
             "one two three four one two three", "\n\n a \n a \n"]
    for t in texts:
        assert QD.base_counts(t)[:5] == brute(t), t


def test_divergence_verdicts(spark):
    d = read(spark, SF, "documents")
    ref = QD.references(d)
    labels = {r.doc_id: r.quality for r in read(spark, SF, "labels").collect()}
    rows = QD.judge(d, ref).collect()
    assert len(rows) == d.count()
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in rows if labels.get(r.doc_id) == 0]
    assert all(r.kept for r in good) and sum(r.kept for r in bad) <= 0.02 * len(bad)
    edge = docs(spark, [(1, None), (2, ""), (3, "word " * 400_000), (None, "a b"), (3, "x" * 500)], clashing=True)
    assert [r.kept for r in QD.judge(edge, ref).collect()] == [False] * 5
    assert [r.n_words for r in QD.judge(edge, ref).collect()] == [0, 0, 400_000, 2, 1]


def plain_distance(p, q):
    def kl(a, m):
        return sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    m = [(x + y) / 2 for x, y in zip(p, q)]
    return math.sqrt(max(0.0, (kl(p, m) + kl(q, m)) / 2))


def share(counts):
    total = sum(counts)
    return [c / total for c in counts]


def test_distances_against_plain_python(spark):
    """References and distances with dictionaries and loops, for words that share buckets too."""
    rng = np.random.default_rng(6)
    vocabulary = {g: [f"{g}{chr(97 + i % 26)}{i}," if i % 7 else f"{g.upper()}É{i}" for i in range(90)] for g in ("en", "de")}
    rows = []
    for i in range(24):
        g = ("en", "de")[i % 2]
        words = [vocabulary[g][min(89, int(x))] for x in rng.exponential(20, int(rng.integers(30, 160)))]
        rows.append((i, " ".join(words) + ("\n## 12 | <x>" if i % 5 == 0 else ""), None if i == 8 else g))
    rows += [rows[3], (50, "", "en"), (51, None, None), (52, "short text", "de")]
    d = docs(spark, rows)
    ref, n_common = QD.references(d, n_common=10), 10

    def classes(text):
        out = [0] * 9
        for ch in text:
            out[4 if ch == "\n" else 3 if ch in " \t\r\x0b\x0c" else 5 if ch in QD.SENTENCE else 6 if ch in QD.SYMBOLS
                else (1 if ch.isupper() else 0) if ch.isalpha() else 2 if ch.isdigit() else 7 if ord(ch) < 128 else 8] += 1
        return out

    def buckets(text):
        out = {}
        for w in (text or "").split():
            b = zlib.crc32(w.encode().lower().strip(QD.SENTENCE.encode())) % (1 << 16)
            out[b] = out.get(b, 0) + 1
        return out

    chars, words = {}, {}
    for _, text, lang in rows:
        n, _, _, _, repeats = brute(text)
        if n >= 50 and 100 * repeats <= 50 * n:
            lang = lang or "und"
            chars[lang] = [x + y for x, y in zip(chars.get(lang, [0] * 9), classes(text))]
            for b, c in buckets(text).items():
                words.setdefault(lang, {})[b] = words.get(lang, {}).get(b, 0) + c
    common = {g: sorted(w, key=lambda b, w=w: (-w[b], b))[:n_common] for g, w in words.items()}
    got = {(r.doc_id, r.n_words): r for r in QD.judge(d, ref, max_char=0.2, max_word=0.5).collect()}
    judged = 0
    for doc_id, text, _ in rows:
        n, _, _, _, repeats = brute(text)
        r = got[doc_id, n]
        far_char = min(plain_distance(share(classes(text)), share(c)) for c in chars.values()) if text and len(text) >= 200 else None
        far_word = None
        if n >= 50:
            own = buckets(text)
            far_word = min(plain_distance(share([own.get(b, 0) for b in top] + [n - sum(own.get(b, 0) for b in top)]),
                                          share([words[g][b] for b in top] + [sum(words[g].values()) - sum(words[g][b] for b in top)]))
                           for g, top in common.items())
        for a, b in ((r.char_distance, far_char), (r.word_distance, far_word)):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
            judged += a is not None
        failed = n < 50 or 100 * repeats > 50 * n
        assert r.base_failed == failed and r.kept == (not failed and not (far_char or 0) > 0.2 and not (far_word or 0) > 0.5)
    assert judged > 20


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(QD, "MAX_LANGUAGES", 2)
    text = " ".join(f"w{i}" for i in range(60))
    with pytest.raises(ValueError, match="more than 2 languages"):
        QD.references(docs(spark, [(i, text, f"l{i}") for i in range(3)]))


def test_divergence_of_an_empty_table(spark):
    ref = QD.references(docs(spark, []))
    text = " ".join(f"w{i}" for i in range(60))
    got = QD.judge(docs(spark, [(1, text)]), ref).collect()
    assert got[0].kept and got[0].char_distance is None and QD.judge(docs(spark, []), ref).count() == 0


def test_js_distance():
    p = np.array([0.5, 0.5, 0.0])
    assert QD.js_distance(p, np.array([p, [0.0, 0.0, 1.0]])).round(12).tolist() == [0.0, 1.0]


def test_chunks_cover_every_byte():
    for n in (0, 1, QC.CHUNK - 1, QC.CHUNK, QC.CHUNK + 1, QC.CHUNK + QC.HOP, 5000):
        data = bytes(1 + i % 251 for i in range(n))
        k = QC.chunk_count(n)
        x = QC.chunks(data, 0, k)
        seen = {i * QC.HOP + j for i in range(k) for j in np.flatnonzero(x[i])}
        assert seen == set(range(n))


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    samples = [rng.integers(0, 256, (k, QC.CHUNK), dtype=np.uint8) for k in (1, 3, 2)]
    y, w = np.array([1.0, 0.0, 1.0], np.float32), np.array([1.0, 2.0, 0.5], np.float32)
    net = {"embed": rng.normal(0, 0.5, (256, QC.DIM)), "filters": rng.normal(0, 0.2, (QC.WIDTH * QC.DIM, QC.FILTERS)),
           "bias": np.full(QC.FILTERS, 0.1), "out": rng.normal(0, 0.3, 3 * QC.FILTERS), "shift": np.zeros(1)}

    def loss():
        total = 0.0
        for s, t, k in zip(samples, y, w):
            z = (QC.windows(s, net["embed"]).reshape(-1, QC.WIDTH * QC.DIM) @ net["filters"]).reshape(len(s), QC.POSITIONS, -1)
            a = np.maximum(z.max(1) + net["bias"], 0)
            p = QC.sigmoid(np.r_[a.max(0), a.mean(0), a.min(0)] @ net["out"] + net["shift"][0])
            total -= k * (t * np.log(p) + (1 - t) * np.log(1 - p)) / len(y)
        return total

    grad = QC.gradients(samples, y, w, net)
    for name, at in (("out", (5,)), ("out", (40,)), ("filters", (3, 2)), ("bias", (4,)), ("embed", (17, 3)), ("shift", (0,))):
        net[name][at] += 1e-6
        up = loss()
        net[name][at] -= 2e-6
        down = loss()
        net[name][at] += 1e-6
        assert abs((up - down) / 2e-6 - grad[name][at]) < 1e-4, name


def test_pieces_change_nothing():
    rng = np.random.default_rng(3)
    net = {"embed": rng.normal(0, 0.5, (256, QC.DIM)).astype(np.float32),
           "filters": rng.normal(0, 0.2, (QC.WIDTH * QC.DIM, QC.FILTERS)).astype(np.float32), "bias": np.zeros(QC.FILTERS, np.float32)}
    datas = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 10, 30_000, 700)]
    whole = QC.features(datas, net)
    piece, QC.PIECE = QC.PIECE, 7
    try:
        assert np.allclose(QC.features(datas, net), whole)
    finally:
        QC.PIECE = piece


def forward(data, net):
    """Score of one text, filter by filter, in exact integers up to the last layer"""
    n = max(1, -(-(len(data) - 512) // 384) + 1)
    tops = []
    for c in range(n):
        piece = data[c * 384:c * 384 + 512].ljust(512, b"\0")
        z = [[sum(int(net["embed"][piece[p + i]][d]) * int(net["filters"][i * QC.DIM + d][f]) for i in range(QC.WIDTH) for d in range(QC.DIM))
              for p in range(0, 505, 4)] for f in range(QC.FILTERS)]
        tops.append([max(0, max(row) + int(net["bias"][f])) for f, row in enumerate(z)])
    by = list(zip(*tops))
    feats = [max(t) for t in by] + [sum(t) / n for t in by] + [min(t) for t in by]
    return 1 / (1 + np.exp(-(sum(f * w for f, w in zip(feats, net["out"])) + net["shift"][0])))


def test_score_against_plain_forward_pass_in_any_batch():
    rng = np.random.default_rng(9)
    net = QC.rounded({"embed": rng.normal(0, 0.5, (256, QC.DIM)), "filters": rng.normal(0, 0.2, (QC.WIDTH * QC.DIM, QC.FILTERS)),
                      "bias": rng.normal(0, 0.3, QC.FILTERS), "out": rng.normal(0, 0.1, 3 * QC.FILTERS), "shift": np.array([0.1])})
    assert QC.WIDTH * QC.DIM * QC.LEVELS ** 2 < 2 ** 24
    datas = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 5, 512, 513, 900)]
    for d in datas:
        assert abs(QC.probability([d], net)[0] - forward(d, net)) < 1e-9
    datas += [bytes(rng.integers(0, 256, int(n), dtype=np.uint8)) for n in rng.integers(0, 9000, 130)]
    alone = [QC.probability([d], net)[0] for d in datas]
    for size in (2, 3, 17, 64, 135):
        assert [x for i in range(0, len(datas), size) for x in QC.probability(datas[i:i + size], net)] == alone


def test_scores_do_not_depend_on_partitions(spark):
    d, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    rows = docs(spark, [(r.doc_id % 7, r.text) for r in d.limit(60).collect()] + [(1, None), (1, "x" * 150_000)], clashing=True)
    net = QC.train(d, labels.withColumn("score", labels.quality))
    got = [sorted((r.doc_id, r.score) for r in QC.score(rows.repartition(n), net).collect()) for n in (1, 3, 8)]
    assert got[0] == got[1] == got[2]
    # repeated ids with several texts: the same network at every run
    again = [QC.train(rows.repartition(n), spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id bigint, quality int")) for n in (1, 5)]
    assert all((again[0][k] == again[1][k]).all() for k in again[0])


def test_classifier(spark):
    d, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    held = crc_remainder("doc_id", 5) == 0
    net = QC.train(d.where(~held), labels.where(~held))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = [r for r in QC.score(d, net).collect() if r.doc_id in truth and id_remainder(r.doc_id, 5) == 0]
    assert sum((r.score >= 0.3) == (truth[r.doc_id] == 1) for r in got) >= 0.9 * len(got)
    edge = docs(spark, [(1, None), (2, ""), (3, "long text " * 100_000), (None, "x"), (1, None)], clashing=True)
    s = [r.score for r in QC.score(edge, net).collect()]
    assert len(s) == 5 and s[0] == s[1] == s[4] and all(0 <= x <= 1 for x in s)


def test_classifier_without_two_classes(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    one = spark.createDataFrame([(1, 1), (1, 1), (None, 0)], "doc_id bigint, quality int")
    d = docs(spark, [(1, "a"), (2, None)])
    assert QC.train(d, none) == 0.5 and QC.train(d, one) == 1.0
    assert [r.score for r in QC.score(d, 0.5).collect()] == [0.5, 0.5] and QC.score(docs(spark, []), 0.5).count() == 0
