"""IO3-IO6, IO10-IO12, M2, M8-M10 end to end on the small fixture."""

import pandas as pd
from pyspark.sql import functions as F

from trafficlens.functions.fixed import CLASSES, ERROR_CLASS, UNKNOWN_CLASS
from trafficlens.operators.summary import hourly_summary
from trafficlens.plans import analyze as AN
from trafficlens.plans import catalog as C
from trafficlens.plans import enrich as EN
from trafficlens.plans import label as LB
from trafficlens.plans import model as MD
from trafficlens.schemas import HOURLY, PARSED
from trafficlens.sources import stage_io as IO

from conftest import SF_SMALL, rows


def test_empty_input_keeps_schema(spark):
    empty = spark.createDataFrame([], PARSED)
    bl = C.blocklist(spark)
    t = EN.enrich_train(empty, bl)
    s = EN.enrich_serve(empty, bl)
    assert t.count() == 0 and s.count() == 0
    assert t.columns == [f.name for f in PARSED.fields] + EN.T_FEATURES
    assert s.columns == [f.name for f in PARSED.fields] + EN.S_FEATURES


def test_csv_and_jsonl_round_trip(spark, tmp_path):
    h = hourly_summary(C.classified(spark, SF_SMALL)).select(*[f.name for f in HOURLY.fields])
    p = str(tmp_path / "hourly")
    IO.write_stage_csv(h, p)
    back = IO.read_hourly_csv(spark, p)
    hours = [r.hour for r in back.collect()]
    assert hours == sorted(hours)
    assert rows(back) == rows(h)

    ex = LB.training_examples(LB.label(C.enriched_train(spark, SF_SMALL), max_samples=50, key_cols=["n"]))
    j = str(tmp_path / "train.jsonl")
    IO.write_training_jsonl(ex, j)
    assert rows(IO.read_training_jsonl(spark, j)) == rows(ex)


def test_user_labeller_failures_become_unknown(spark):
    enriched = C.enriched_train(spark, SF_SMALL)

    def labeller(pdf: pd.DataFrame) -> pd.DataFrame:
        if (pdf["status_code"] >= 500).any():
            if len(pdf) == 1:
                raise RuntimeError("remote labeller failed")
            raise RuntimeError("batch failed")
        return pd.DataFrame({"classification": ["legitimate_human"] * len(pdf),
                             "confidence": [0.9] * len(pdf), "reasoning": ["ok"] * len(pdf)})

    out = LB.label(enriched, max_samples=200, labeller=labeller, key_cols=["n"])
    got = out.select("status_code", "classification", "confidence").collect()
    assert len(got) == 200
    for r in got:
        if r.status_code >= 500:
            assert (r.classification, r.confidence) == (UNKNOWN_CLASS, 0.0)
        else:
            assert (r.classification, r.confidence) == ("legitimate_human", 0.9)


def test_user_labeller_runs_once_per_row(spark):
    """A non-deterministic labeller: its labels are checkpointed, so every read sees the same ones."""
    import numpy as np

    enriched = C.enriched_train(spark, SF_SMALL)

    def labeller(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"classification": ["legitimate_human"] * len(pdf),
                             "confidence": np.random.random(len(pdf)), "reasoning": ["r"] * len(pdf)})

    out = LB.label(enriched, max_samples=100, labeller=labeller, key_cols=["n"])
    first = sorted((r.n, r.confidence) for r in out.select("n", "confidence").collect())
    again = sorted((r.n, r.confidence) for r in out.select("n", "confidence").collect())
    assert len(first) == 100 and first == again


def test_train_save_load_analyze(spark, tmp_path):
    bl = C.blocklist(spark)
    parsed = C.parsed(spark, SF_SMALL)
    train_rows = EN.enrich_train(parsed, bl, tiebreak=C.TIE).where(F.col("classification").isin(CLASSES))
    model, metrics = MD.train(train_rows, 0.2, reg_params=(0.01,), key_cols=["n"])
    m = metrics.first()
    assert m.train_rows + m.validation_rows == train_rows.count()
    assert m.eval_loss == m.eval_loss  # not NaN

    path = str(tmp_path / "packaged")
    MD.save(model, path, {"profile": "serve", "blacklist": "4"})
    model2, cfg = MD.load(spark, path)
    assert cfg == {"profile": "serve", "blacklist": "4"}

    serve_in = parsed.drop("classification", "confidence")
    classified, hourly, report = AN.analyze(serve_in, model2, bl, blacklist=cfg["blacklist"], tiebreak=C.TIE)
    n = serve_in.where(~F.col("status_code").cast("string").startswith("4")).count()
    assert classified.count() == n
    assert {r[0] for r in classified.select("classification").distinct().collect()} <= set(CLASSES) | {ERROR_CLASS}
    assert hourly.agg(F.sum("total_requests")).first()[0] == n
    assert report.count() > 0


def test_labels_stay_on_their_rows(spark):
    """Answers of another length or order are retried row by row."""
    rows = spark.createDataFrame([(i,) for i in range(40)], "id int").repartition(3)

    def frame(pdf):
        return pd.DataFrame({"classification": pdf["id"].astype(str).values, "confidence": 0.5, "reasoning": "r"}, index=pdf.index)

    def short(pdf):
        return frame(pdf[pdf["id"] % 2 == 0])

    def shuffled(pdf):
        return frame(pdf).iloc[::-1]

    def raising(pdf):
        if (pdf["id"] == 7).any():
            raise RuntimeError("no")
        return frame(pdf)

    for fn, lost in ((frame, set()), (short, set(range(1, 40, 2))), (shuffled, set()), (raising, {7})):
        got = {r.id: r.classification for r in LB.label(rows, 0, labeller=fn).collect()}
        assert got == {i: UNKNOWN_CLASS if i in lost else str(i) for i in range(40)}


def test_package_applies_its_filter_and_training_skips_invalid_rows(spark, tmp_path):
    bl = C.blocklist(spark)
    parsed = C.parsed_stage(spark, SF_SMALL)
    rows = EN.enrich_train(parsed, bl, tiebreak=C.TIE).where(F.col("classification").isin(CLASSES))
    rows = rows.withColumn("requests_per_minute", F.when(F.col("n") % 50 == 0, F.lit(None)).otherwise(F.col("requests_per_minute")))
    model, metrics = MD.train(rows, 0.2, reg_params=(0.01,), key_cols=["n"], num_path_features=64)
    m = metrics.first()
    assert m.skipped_rows == rows.where("n % 50 = 0").count() and m.train_rows + m.validation_rows + m.skipped_rows == rows.count()
    MD.save(model, str(tmp_path / "p"), {"profile": "serve", "blacklist": "4", "lag_bucket": "second"})
    classified, _, _ = AN.analyze_packaged(spark, str(tmp_path / "p"), parsed.drop("classification", "confidence"), bl, tiebreak=C.TIE)
    assert classified.count() == parsed.where(~F.col("status_code").cast("string").startswith("4")).count()
    MD.save(model, str(tmp_path / "q"), {"profile": "train"})
    import pytest
    with pytest.raises(ValueError):
        AN.analyze_packaged(spark, str(tmp_path / "q"), parsed, bl)


def test_sorted_stage_and_first_rows(spark, tmp_path):
    from trafficlens.sources.stage_io import first_rows, write_stage
    df = spark.range(1000).withColumn("raw_log", F.reverse(F.col("id").cast("string"))).repartition(7)
    write_stage(df, str(tmp_path / "s"), order_by=["raw_log"])
    got = [r.raw_log for r in spark.read.parquet(str(tmp_path / "s")).orderBy(F.input_file_name(), F.monotonically_increasing_id()).collect()]
    assert got == sorted(got) and len(got) == 1000
    assert [r.raw_log for r in first_rows(df, 10).collect()] == sorted(got)[:10]


def test_path_tokens_are_made_once_for_all_fits(spark, monkeypatch):
    """Both fits and both evaluations read the finished vectors; the model still starts from the columns."""
    made, transform = [], MD.RegexTokenizer._transform
    monkeypatch.setattr(MD.RegexTokenizer, "_transform", lambda self, d: made.append(1) or transform(self, d))
    numbers = {c: (F.col("id") % (k + 2)).cast("double") for k, c in enumerate(MD.NUMERIC_FEATURES)}
    flags = {c: F.col("id") % (k + 2) == 0 for k, c in enumerate(MD.BOOL_FEATURES)}
    rows_ = spark.range(120).withColumns({**numbers, **flags, "path": F.concat(F.lit("/p/"), (F.col("id") % 7).cast("string")),
                                          "raw_log": F.col("id").cast("string"),
                                          "classification": F.element_at(F.array(*map(F.lit, CLASSES)), (F.col("id") % 4 + 1).cast("int"))})
    rows_ = rows_.withColumn("requests_per_minute", F.when(F.col("id") != 5, F.col("requests_per_minute")))
    model, metrics = MD.train(rows_, 0.2, num_path_features=16)
    assert len(made) == 1
    m = metrics.first()
    assert m["skipped_rows"] == 1 and m["train_rows"] + m["validation_rows"] == 119 and m["validation_rows"] > 0
    out = MD.classify(model, rows_.drop("classification"))
    assert out.count() == 120 and rows(out.where("id = 5"), "classification", "confidence") == [(ERROR_CLASS, 0.0)]
    assert out.where(F.col("classification").isin(CLASSES)).count() == 119


def test_wide_log_queries_run_in_compiled_methods(spark, monkeypatch):
    import __spark_entry__ as entry

    assert entry.llm_queries
    key, seen = "spark.sql.codegen.hugeMethodLimit", {}
    look = lambda name: lambda s, _: seen.update({name: s.conf.get(key)})
    monkeypatch.setattr(entry.catalog, "QUERIES", {"m9_classify": look("log")})
    monkeypatch.setattr(entry.catalog_state, "QUERIES", {})
    monkeypatch.setattr(entry.llm_queries, "QUERIES", {"op1_x": look("text")})
    for name in ("m9_classify", "op1_x"):
        entry.queries()[name](spark, "")
    spark.conf.unset(key)
    assert seen["log"] == "8000" and seen["text"] == spark.conf.get(key) != "8000"
