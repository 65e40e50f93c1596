import hashlib
from collections import Counter

import corpus_pipeline as CP
import numpy as np
import public_tokenizers as P
import tiktoken
from frames import docs
from test_line_runs import brute as line_brute
from test_partenum_join import brute as join_brute

from trafficlens.llm import bpe_replay as BP
from trafficlens.llm.common import read

SF = "/root/testdata/sf0.001"


def key(r):
    return (r.doc_id is None, r.doc_id or 0, r.text or "")


def test_stages_one_by_one(spark):
    d = read(spark, SF, "documents").cache()
    a = CP.language_id(spark, d, SF).cache()
    assert a.columns == CP.COLUMNS and a.count() >= 0.97 * d.where("lang IS NOT NULL").count()

    b = CP.line_dedup(spark, a, SF).cache()
    rows = [(r.doc_id, r.text) for r in a.collect()]
    want = sorted((i, t) for i, t, gone in line_brute(rows, 50) if not gone or t.encode().split())
    assert sorted((r.doc_id, r.text) for r in b.collect()) == want

    c = CP.near_duplicates(spark, b, SF).cache()
    rows = [(r.doc_id, r.text) for r in b.collect()]
    want = sorted(i for i, n, low in join_brute(rows) if low == i or not n)
    assert sorted(r.doc_id for r in c.collect()) == want and len(set(want)) == len(want)

    m = CP.mix_sources(spark, c, SF).cache()
    assert m.columns == CP.COLUMNS
    size = lambda rs: sum(len(r.text.encode().split()) for r in rs)
    kept = {r.doc_id: r for r in c.collect()}
    mixed = m.collect()
    assert abs(size(mixed) - size(kept.values())) <= len({r.source for r in mixed})
    assert max(Counter(r.doc_id for r in mixed).values()) <= 4  # three whole ones, or two and a part
    cut = [r for r in mixed if r.text != kept[r.doc_id].text]
    assert len(cut) <= len({r.source for r in mixed}) and all(kept[r.doc_id].text.split()[:len(r.text.split())] == r.text.split() for r in cut)

    ranks = BP.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, hashlib.sha256(np.array(lib.encode_ordinary(r.text), "<u4").tobytes()).hexdigest()) for r in mixed)
    assert sorted((r.doc_id, r.ids_sha256) for r in CP.tokens(spark, m, SF).collect()) == want


def test_edges(spark):
    words = [f"token{i} of the text" for i in range(40)]
    long = " ".join(words)
    rows = [(1, None), (2, ""), (3, "123 456"), (4, long), (4, long), (None, long + " more"), (5, long + " x"), (6, "short text"), (7, None, None, None),
            (8, "the other text " * 50_000), (9, "short text", None, None)]
    d = docs(spark, rows, clashing=True)
    for name, stage in CP.STAGES:
        d = CP.write_table(stage(spark, d, SF), "test")
        if name == "language ID":
            assert sorted(map(key, d.collect())) and d.where("doc_id IN (1, 2, 3)").count() == 0
        if name == "n-gram Jaccard join":
            assert d.where("doc_id IN (4, 5) OR doc_id IS NULL").count() == 1
    assert d.count() > 0
    empty = docs(spark, [])
    for _, stage in CP.STAGES:
        empty = CP.write_table(stage(spark, empty, SF), "test")
    assert empty.count() == 0
