import random
import re
from collections import Counter, defaultdict

import pytest
from frames import docs
from trafficlens.llm import collocations as CO


def brute(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting every n-gram of every length"""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {g: c for g, c in count.items() if len(g) > 1 and c >= least}
        drop = {g[i:j] for g, c in cand.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1)
                if j - i < len(g) and 100 * c >= 80 * count[g[i:j]]}
        scored = []
        for g, a in cand.items():
            if g in drop:
                continue
            cuts = [(2_000_000 * a // (count[g[:k]] + count[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(g).encode("utf-8", "surrogatepass"), count[g[:k]], count[g[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode("utf-8", "surrogatepass"), -a, l, r, n[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def drawn(rng, n):
    phrases = ["new york city hall", "New York", "à la carte", "x y z", "machine learning model", "of the", "a b c d e"]
    words = [f"w{i}" for i in range(30)] + ["the", "a", "É", "\x1c", "#", "naïve"]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(phrases) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(0, 30)))
        text = re.sub(" ", lambda m: rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\x0b"]), text)
        out.append((i, text.upper() if rng.random() < 0.1 else text, rng.choice(["en", "de", "en", "en", None, "und"])))
    return out


EDGES = [(1, None, "en"), (2, "", "fr"), (None, " \n.,;", None), (3, "ab " * 60_000, "long"), (4, "p q" + "." * 5000 + "p q", "en"), (4, "p q", "en"), (4, "p q", "en")]


@pytest.mark.parametrize("numbered", [True, False])
def test_against_counting_everything(spark, monkeypatch, numbered):
    rng = random.Random(1)
    rows = drawn(rng, 400) + EDGES
    monkeypatch.setattr(CO, "CHUNK", 900)  # many chunks of windows
    monkeypatch.setattr(CO, "PART", 700)
    d = docs(spark, rows, clashing=True).repartition(5)
    got = rows_of(CO.collocations(d, least=3, top=60, dictionary_bytes=CO.DICTIONARY_BYTES if numbered else 0))
    assert got == brute(rows, 3, 60)


def test_hot_pairs_and_held_rows(spark, monkeypatch):
    """One pair of words that leads a third of all windows, more rows than a task holds back."""
    rng = random.Random(2)
    rows = [(i, "hot pair " + " ".join(rng.choice(["hot pair", f"c{rng.randrange(40)}", f"r{rng.randrange(10 ** 6)}"]) for _ in range(25)), "en") for i in range(300)]
    monkeypatch.setattr(CO, "HELD", 5)
    monkeypatch.setattr(CO, "STEP", 40)
    monkeypatch.setattr(CO, "CHUNK", 500)
    monkeypatch.setattr(CO, "HEAVY", 20)
    assert rows_of(CO.collocations(docs(spark, rows).repartition(4), least=4, top=500)) == brute(rows, 4, 500)


def test_marginals_of_every_length(spark):
    """The ROLLUP gives single words the counts that the vocabulary has."""
    rng = random.Random(3)
    d = docs(spark, drawn(rng, 120))
    phrases, totals = CO.counts(d, 1)
    single = {(r.lang, r.phrase): r.f for r in phrases.where("size = 1").collect()}
    words = CO.vocabulary(d.selectExpr("coalesce(lang, 'und') as lang", "text")).collect()
    assert single == {(r.lang, r.word): r.f for r in words}
    by_lang = Counter()
    for (lang, _), f in single.items():
        by_lang[lang] += f
    assert by_lang == {r.lang: r.n for r in totals.collect()}


def test_empty_table(spark):
    assert CO.collocations(docs(spark, [])).count() == 0
    assert CO.collocations(docs(spark, [(1, None), (2, "one word. each")])).count() == 0


def test_many_frequent_words_leave_cut_windows(spark, monkeypatch):
    """More words than the dictionary holds: windows are cut at rare words before they are sent, in chunks with their own words."""
    rng = random.Random(4)
    rows = drawn(rng, 300) + [(i, " ".join(f"r{rng.randrange(10 ** 9)}" for _ in range(40)), "en") for i in range(200)] + EDGES
    monkeypatch.setattr(CO, "CHUNK", 700)
    monkeypatch.setattr(CO, "PIECE", 90)
    monkeypatch.setattr(CO, "OWN", 500)
    monkeypatch.setattr(CO, "TEXTS", 1500)
    monkeypatch.setattr(CO, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(CO, "COMMON", 5)
    sent = []
    cut = CO.cut_windows
    monkeypatch.setattr(CO, "cut_windows", lambda df, *a: sent.append(df) or cut(df, *a))
    monkeypatch.setattr(CO, "discard", lambda *tables: None)
    d = docs(spark, rows, clashing=True).repartition(3)
    got = CO.collocations(d, least=3, top=60, dictionary_bytes=0)
    assert rows_of(got) == brute(rows, 3, 60)
    numbered = {n for r in sent[0].collect() for n in (r.p >> 31, r.p & (2 ** 31 - 1), r.q >> 31, r.q & (2 ** 31 - 1))}
    frequent = CO.vocabulary(d.selectExpr("coalesce(lang, 'und') as lang", "text")).where("f >= 3").count()
    assert numbered == set(range(frequent + 1))


def test_numbers_by_frequency(spark):
    words = [("en", f"w{i}", 1 + i % 7) for i in range(500)] + [("de", "w1", 50)]
    got = CO.numbered(spark.createDataFrame(words, "lang string, word string, f bigint").repartition(9)).orderBy("id").collect()
    assert [(r.id, r.lang, r.word, r.f) for r in got] == [(i, *w) for i, w in enumerate(sorted(words, key=lambda w: (-w[2], w[0], w[1])), 1)]


def test_packed_codes():
    codes = CO.np.array([0, 1, 255, 256, 70_000, 2 ** 32 - 1], CO.np.uint32)
    assert CO.unpacked(CO.packed(codes)).tolist() == codes.tolist()
