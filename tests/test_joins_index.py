"""Heavy keys, the literal index of pattern libraries, observed counters, log content in a column, the count-based model."""

import math
import re
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from trafficlens.functions import pattern_index as PI
from trafficlens.functions.regex import matches_any
from trafficlens.operators import dims
from trafficlens.operators.parse import parse_access_log, parse_counters
from trafficlens.plans import bayes as NB
from trafficlens.plans import catalog as C
from trafficlens.plans import enrich as EN
from trafficlens.sources import access_log as AL
from trafficlens.sources import stage_io as IO
from trafficlens.sources import threat_patterns as TP

from conftest import SF_SMALL, rows


def test_heavy_keys_are_dealt_out(spark):
    """One key with half of the rows: no task gets more than twice the median."""
    df = spark.range(40_000).select(F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 97 == 1, F.lit(None).cast("string"))
                                    .otherwise(F.concat(F.lit("k"), (F.col("id") % 3001).cast("string"))).alias("ip"))
    dim = df.where("ip is not null").groupBy("ip").agg(F.count(F.lit(1)).alias("w"), F.max("n").alias("last"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = dims.weighted_join(df, dim, ["ip"], "w")
        assert rows(got, "n", "last") == rows(df.join(dim, "ip", "left"), "n", "last")
        sizes = sorted(r["count"] for r in got.where("ip is not null").groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def library():
    """Some 300 patterns of many shapes, made by rule."""
    words = ["".join(chr(97 + (i * k + j) % 26) for j in range(3 + i % 4)) for i in range(60) for k in (3, 7)]
    shapes = [r"{0}\(", r"({0}|{1})\s", r"^/{0}-(?:{1}|x)\.php$", r"{0}[0-9]+{1}", r"(?:{0}){{2,}}", r"\b{0}\b", r"{0}.*?{1}", r"[{0}]+=", r"/(?=.{{3}}){0}", r"{0}?"]
    out = [s.format(words[i], words[(i * 5 + 1) % len(words)]) for i in range(len(words)) for s in (shapes[i % 10], shapes[(i + 3) % 10], shapes[(i + 7) % 10])]
    return words, list(dict.fromkeys(out))


def test_index_equals_all_alternations(spark):
    words, patterns = library()
    texts = [f"/{w}-{v}.php" for w, v in zip(words, words[3:])] + [f"/a?x={w.upper()}({v} {w}{w}1{v}" for w, v in zip(words, words[1:])]
    texts += ["", "ab", "/", None, "/ſearch", "/" + words[0].upper() + "K", "x" * 5000 + words[5] + "("] + [w[:2] for w in words]
    keys = spark.createDataFrame([(t,) for t in texts], "path string").where("path is not null").distinct()
    third = len(patterns) // 3
    lists = {"one": patterns[:third], "two": patterns[third:], "none": [], "loose": [r"a.?", r"[xyz]{2}", r"(k)\1"]}
    got = PI.pattern_hits(keys, "path", {k: (F.col("path"), p) for k, p in lists.items()})
    want = keys.select("path", *[matches_any("path", p).alias(k) for k, p in lists.items()]).where("one or two or none or loose")
    assert rows(got, "path", *lists) == rows(want, "path", *lists)
    indexed = [p for p in patterns if PI.needed(p)]
    assert len(indexed) > len(patterns) / 2
    for p in indexed:  # what the index relies on
        for t in texts:
            if t and t.isascii() and re.search(p, t, re.I):
                assert any(x in t.lower() for x in PI.needed(p)), (p, t)


def test_enrichment_through_the_index(spark):
    _, patterns = library()
    lib = dict(TP.DEFAULT_LIBRARY) | {"xss": TP.DEFAULT_LIBRARY["xss"] + patterns[:200]}
    flags = ["n", *C.PATTERN_FLAGS]
    stage = C.parsed_stage(spark, SF_SMALL)
    through = EN.enrich_train(stage, C.blocklist(spark), patterns=lib, tiebreak=C.TIE)  # large enough for the index
    shuffled = EN.enrich_train(stage, C.blocklist(spark), patterns=lib, tiebreak=C.TIE, max_broadcast_rows=0)
    want = rows(EN.enrich_train(stage, C.blocklist(spark), patterns=lib, tiebreak=C.TIE, indexed=False), *flags)
    assert rows(through, *flags) == want == rows(shuffled, *flags)


def test_unbalanced_patterns_are_repaired_in_compat_mode(spark):
    lines = ["# REQUEST URI PATTERNS", "a(b", "(x)(y)", "[ab", "*a)", "a\\", "(ok)", ")a(b)"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    found = {r.line_no: (r.pattern, r.status) for r in TP.patterns_from_lines(df, compat=True).collect()}
    status = [found[k][1] for k in sorted(found)]
    assert status == ["repaired", "escaped", "repaired", "escaped", "repaired", "ok", "repaired"]
    assert [found[k][0] for k in sorted(found)][0] == "a(b)"
    plain = {r.status for r in TP.patterns_from_lines(df).collect()}
    assert "repaired" not in plain


def test_observed_counters(spark, tmp_path):
    lines = C.odd_lines(spark, SF_SMALL)
    got = IO.write_parsed(lines, str(tmp_path / "t"))
    assert got == parse_counters(lines).first().asDict()
    assert spark.read.parquet(str(tmp_path / "t")).count() == got["parsed"]


RETRY = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from trafficlens.session import get_spark
from trafficlens.plans import catalog as C
from trafficlens.operators.parse import parse_counters
from trafficlens.sources import stage_io as IO
spark = get_spark("local[2,3]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {ckpt!r}}})
flag = {ckpt!r} + "/failed"
def once(batches):
    for b in batches:
        yield b
    if not os.path.exists(flag):  # the first attempt fails after its last row
        open(flag, "w").close()
        raise RuntimeError("lost task")
lines = C.odd_lines(spark, {sf!r})
got = IO.write_parsed(lines.mapInArrow(once, lines.schema), {ckpt!r} + "/t")
assert os.path.exists(flag) and got == parse_counters(lines).first().asDict(), got
print("equal")
"""


def test_observed_counters_after_a_task_retry(tmp_path):
    code = RETRY.format(root=str(Path(__file__).resolve().parents[1]), ckpt=str(tmp_path), sf=SF_SMALL)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert "equal" in out.stdout, out.stderr[-2000:]


def test_content_in_a_column(spark):
    docs = spark.createDataFrame([("a", "\n one\n\ntwo \n"), ("b", None), ("c", ""), ("d", "x")], "name string, content string")
    assert rows(AL.lines_from_documents(docs), "name", "line_id", "value") == [
        ("a", 0, "one"), ("a", 1, ""), ("a", 2, "two"), ("c", 0, ""), ("d", 0, "x")]
    assert rows(AL.lines_from_text(spark, "p\nq"), "value", "line_id") == [("p", 0), ("q", 1)]
    text = "\n".join(r.value for r in C.lines(spark, SF_SMALL).orderBy("n").collect())
    parsed = parse_access_log(AL.lines_from_text(spark, text))
    assert parsed.count() == C.parsed(spark, SF_SMALL).count()


def test_counts_model_against_plain_python(spark):
    data = [("legitimate_human", "/p/1", True, False), ("legitimate_human", "/p/2?x=1", True, False), ("illegitimate_bot", "/scan/a.php", False, True),
            ("illegitimate_bot", "/scan/b.php", False, True), ("illegitimate_bot", "/p/1", False, True), ("unknown", "/p/3", True, True),
            ("legitimate_bot", "/P/p/p", True, True)]
    df = spark.createDataFrame(data, "classification string, path string, f boolean, g boolean")
    model = NB.fit(df, ["f", "g"])
    train = [r for r in data if r[0] in NB.CLASSES]
    feats = lambda r: {f"path:{t}" for t in re.split(NB.TOKEN_SPLIT, r[1].lower()) if t} | {f"flag:{n}" for n, v in zip("fg", r[2:]) if v}
    names = set().union(*map(feats, train)) | {"flag:f", "flag:g"}
    weights = {}
    for c in NB.CLASSES:
        own = [feats(r) for r in train if r[0] == c]
        size = sum(map(len, own)) + len(names)
        weights[c, "prior"] = math.log((len(own) + 1) / (len(train) + 4))
        weights |= {(c, t): math.log((sum(t in x for x in own) + 1) / size) for t in names}
    got = {(r.classification, r.feature): r.log_weight for r in model.tables().collect()}
    assert got.keys() == weights.keys() and all(abs(got[k] - weights[k]) < 1e-12 for k in got)
    new = data + [("x", "/never/seen", True, False), ("x", None, False, False), ("x", "/p/1", None, True)]
    rows_ = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(new)], "n int, path string, f boolean, g boolean")
    for r in model.classify(rows_).collect():
        if r.f is None:
            assert (r.classification, r.confidence) == ("error", 0.0)
            continue
        s = {c: weights[c, "prior"] + sum(weights[c, t] for t in feats(("", r.path or "", r.f, r.g)) if t in names) for c in NB.CLASSES}
        best = max(s, key=s.get)
        assert r.classification == best and abs(r.confidence - 1 / sum(math.exp(v - s[best]) for v in s.values())) < 1e-9
