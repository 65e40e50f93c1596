"""M3, M4, M5 / Q2 on literal strings."""

from pyspark.sql import functions as F

from trafficlens.functions import labels as L


def _parse(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.p for r in df.select("i", fn(F.col("t")).alias("p")).orderBy("i").collect()]


def test_label_answer(spark):
    texts = [
        'Here:\n```json\n{"classification": "legitimate_bot", "confidence": 0.9, "reasoning": "crawler"}\n```',
        'Result {"classification": "illegitimate_human", "confidence": 0.7, "reasoning": "sqli"} done',
        'classification is "classification": "legitimate_human", "confidence": 0.55 and no json',
        '"classification": "legitimate_human" without a confidence',
        "I cannot decide.",
    ]
    got = _parse(spark, L.parse_label_answer, texts)
    assert (got[0].classification, got[0].confidence, got[0].reasoning) == ("legitimate_bot", 0.9, "crawler")
    assert (got[1].classification, got[1].confidence) == ("illegitimate_human", 0.7)
    assert (got[2].classification, got[2].confidence) == ("legitimate_human", 0.55)
    assert (got[3].classification, got[3].confidence, got[3].reasoning) == ("unknown", 0.0, "")
    assert (got[4].classification, got[4].confidence, got[4].reasoning) == ("unknown", 0.0, "")


def test_generated_answer(spark):
    texts = [
        "Classification: illegitimate_bot\nConfidence: 0.93\nReasoning: scanner paths\n\nextra",
        "Classification: legitimate_human\nConfidence: 0.8",
        "Classification: legitimate_bot\nConfidence: 1.2.3\nReasoning: x",
        "nothing useful",
    ]
    got = _parse(spark, L.parse_generated_answer, texts)
    assert (got[0].classification, got[0].confidence, got[0].reasoning) == \
        ("illegitimate_bot", 0.93, "scanner paths")
    assert (got[0].is_legitimate, got[0].is_human) == (False, False)
    assert (got[1].reasoning, got[1].is_legitimate, got[1].is_human) == ("No reasoning provided", True, True)
    assert (got[2].classification, got[2].confidence) == ("unknown", 0.0)
    assert (got[3].classification, got[3].confidence) == ("unknown", 0.0)


def test_class_flags(spark):
    classes = ["legitimate_human", "legitimate_bot", "illegitimate_human", "illegitimate_bot",
               "unknown", "error", "LEGITIMATE_HUMAN", None]
    df = spark.createDataFrame([(c,) for c in classes], "classification string")
    got = df.select("classification", L.is_legitimate().alias("l"), L.is_legitimate(compat=True).alias("lc"),
                    L.is_human().alias("h")).collect()
    m = {r.classification: (r.l, r.lc, r.h) for r in got}
    assert m["legitimate_human"] == (True, True, True)
    assert m["illegitimate_bot"] == (False, True, False)   # Q2: substring test says legitimate
    assert m["illegitimate_human"] == (False, True, True)
    assert m["LEGITIMATE_HUMAN"] == (True, True, True)
    assert m["unknown"] == (False, False, False)
    assert m[None] == (False, False, False)


def test_label_answer_blocks(spark):
    texts = [
        '{"confidence": 0.4, "reasoning": "r"}',                                       # lacks only the class
        '```json\n{"classification": oops}\n```\n{"classification": "legitimate_bot", "confidence": 1.0}',
        '{"classification": "legitimate_bot", "confidence": 0.8, "reasoning": "a {b}", "x": {"y": 1}}',
        '{"classification": "legitimate_bot"} or {"classification": "illegitimate_bot"}',
        '{"classification": "legitimate_bot"}',
    ]
    got = [tuple(r) for r in _parse(spark, L.parse_label_answer, texts)]
    assert got == [("unknown", 0.4, "r"), ("unknown", 0.0, ""), ("legitimate_bot", 0.8, "a {b}"), ("unknown", 0.0, ""),
                   ("legitimate_bot", 0.0, "")]


def test_prompts_print_defaults(spark):
    df = spark.createDataFrame([("1.2.3.4", None, None, "GET", None)], "ip string, country string, asn string, method string, path string")
    text = df.select(L.serving_prompt(df.columns).alias("p")).first().p
    assert "client: 1.2.3.4 (Unknown, Unknown)" in text and "request: GET Unknown Unknown" in text
    assert "rate: 0.00 per minute" in text and "- is_known_bot: false" in text and "- ip_reputation_score: 0" in text
