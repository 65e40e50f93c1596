import random

import duckdb
from frames import docs
from trafficlens.llm import line_runs as LR


def brute(rows, least):
    """(doc_id, text, deleted): a line goes when it lies in a run of enough words that occurs earlier"""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seqs = {}
    for i in order:
        lines = (rows[i][1] or "").split("\n")
        at = [k for k, x in enumerate(lines) if x.encode().split()]
        seqs[i] = (lines, at)
    starts = [(i, s) for i in order for s in range(len(seqs[i][1]))]
    rank = {p: n for n, p in enumerate(starts)}
    gone = {i: set() for i in order}
    first = {}
    for i, s in starts:
        lines, at = seqs[i]
        for e in range(s + 1, len(at) + 1):
            run = tuple(lines[k] for k in at[s:e])
            if sum(len(x.encode().split()) for x in run) >= least:
                if first.setdefault(run, rank[i, s]) < rank[i, s]:
                    gone[i] |= set(at[s:e])
    return sorted(((rows[i][0], None if rows[i][1] is None else "\n".join(x for k, x in enumerate(seqs[i][0]) if k not in gone[i]), len(gone[i]))
                   for i in order), key=repr)


def run(spark, rows, least, **kw):
    return sorted(((r.doc_id, r.text, r.n_deleted) for r in LR.dedup(docs(spark, rows, **kw), least).collect()), key=repr)


def test_random_sequences(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(7)] + ["", "  ", "x\ty"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for i in range(60)]
    assert run(spark, rows, 6) == brute(rows, 6)
    assert run(spark, rows[:30], 1) == brute(rows[:30], 1)


def test_edges(spark):
    a = "\n".join(f"line {i} of a passage" for i in range(12))
    rows = [(3, a), (1, "intro\n" + a + "\n\noutro"), (2, None), (4, ""), (5, a), (5, a), (None, a), (6, "\n\n"), (7, "same line here\n" * 40),
            (8, "alone " * 60), (9, "alone " * 60), (10, a.upper())]
    assert run(spark, rows, 50, clashing=True) == brute(rows, 50)
    assert run(spark, [], 50) == [] and run(spark, [(1, None), (2, "")], 50) == [(1, None, 0), (2, "", 0)]


def test_long_runs(spark):
    long = "\n".join(f"w{i} w w" for i in range(6000))
    got = {r.doc_id: (r.n_lines, r.n_deleted) for r in LR.dedup(docs(spark, [(1, long), (2, "x\n" + long), (3, "a b\n" * 5000)])).collect()}
    assert got == {1: (6000, 0), 2: (6001, 6000), 3: (5000, 4999)}


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, text, n_lines, n_deleted FROM ({LR.ORACLE_SQL})").fetchall())
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_deleted) for r in LR.dedup(spark.read.parquet(f"{sf}/documents.parquet")).collect())
    assert got == want
