"""Classifier training and serving with Spark ML (M8, M9, IO12, M10).

The reference fine-tunes a text generator; re-aimed as a Spark ML pipeline
over the enriched feature columns plus hashed path tokens, so training and
scoring are distributed Spark jobs:

    RegexTokenizer(path) -> HashingTF -> VectorAssembler(features + tokens)
    -> multinomial LogisticRegression

Labels are indexed over the fixed class list (a class absent from a split
keeps its index).  The best model of a small ``regParam`` grid by validation
log-loss is kept (M8).  Scoring (M9) gives ``classification`` (argmax),
``confidence`` (max probability); a row whose features cannot be built gets
``error`` / 0.0.
"""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.fixed import CLASSES, ERROR_CLASS
from ..operators.dims import materialize
from ..operators.sampling import split_flag

NUMERIC_FEATURES = ["status_code", "requests_per_minute", "time_diff", "ip_reputation_score",
                    "asn_reputation_score", "combined_reputation_score"]
BOOL_FEATURES = ["has_user_agent", "is_known_bot", "is_old_browser", "is_suspicious_user_agent",
                 "is_malicious_user_agent", "has_suspicious_patterns", "has_malicious_pattern",
                 "path_matches", "query_matches", "ua_matches", "referrer_matches", "sql_injection_matches",
                 "xss_matches", "cmd_injection_matches", "file_inclusion_matches", "wordpress_matches",
                 "shell_upload_matches", "malicious_ext_matches", "likely_malicious_human", "ip_is_known_bad",
                 "is_high_risk_country", "is_high_risk_asn", "potential_dos", "potential_scanner",
                 "during_traffic_spike", "from_coordinated_asn", "to_high_error_path"]


def feature_frame(enriched: DataFrame) -> DataFrame:
    """Numeric view of the enriched columns; ``time_diff`` null -> -1 (first request)."""
    cols = {f"f_{c}": F.col(c).cast("double") for c in NUMERIC_FEATURES}
    cols["f_time_diff"] = F.coalesce(F.col("time_diff").cast("double"), F.lit(-1.0))
    cols.update({f"f_{c}": F.col(c).cast("double") for c in BOOL_FEATURES})
    cols["_path_text"] = F.coalesce(F.col("path"), F.lit(""))
    return enriched.withColumns(cols)


def valid_features() -> F.Column:
    """Whether every numeric feature of a :func:`feature_frame` row is present (no null, no NaN)."""
    return reduce(lambda a, b: a & b, [F.col(f"f_{c}").isNotNull() & ~F.isnan(f"f_{c}")
                                       for c in NUMERIC_FEATURES + BOOL_FEATURES])


def label_index() -> F.Column:
    e = None
    for i, c in enumerate(CLASSES):
        e = F.when(F.col("classification") == c, F.lit(float(i))) if e is None else \
            e.when(F.col("classification") == c, F.lit(float(i)))
    return e


def feature_stages(num_path_features: int = 1 << 10) -> list:
    """From a :func:`feature_frame` to the vector ``features``: nothing to fit."""
    tok = RegexTokenizer(inputCol="_path_text", outputCol="_path_tokens", pattern=r"[/?&=.\-_]+")
    tf = HashingTF(inputCol="_path_tokens", outputCol="_path_tf", numFeatures=num_path_features)
    feats = [f"f_{c}" for c in NUMERIC_FEATURES + BOOL_FEATURES] + ["_path_tf"]
    va = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    return [tok, tf, va]


def classifier(reg_param: float = 0.01) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", family="multinomial",
                              regParam=reg_param, maxIter=30)


def build_pipeline(reg_param: float = 0.01, num_path_features: int = 1 << 10) -> Pipeline:
    return Pipeline(stages=[*feature_stages(num_path_features), classifier(reg_param)])


def train(labeled_enriched: DataFrame, validation_split: float = 0.1, reg_params=(0.001, 0.01),
          key_cols: list[str] | None = None, num_path_features: int = 1 << 10) -> tuple[PipelineModel, DataFrame]:
    """M8: fit on the training share, keep the best ``regParam`` by validation log-loss.

    Rows with a missing feature are left out, as :func:`classify` leaves them
    unclassified.  ``num_path_features`` is the number of hash buckets of the path
    tokens.  Returns the model and a one-row metrics table (``skipped_rows``
    counts the rows left out).
    """
    d = feature_frame(labeled_enriched).withColumn("label", label_index()).where(F.col("label").isNotNull())
    # One table of the finished vectors feeds both splits and every fit.
    stages = feature_stages(num_path_features)
    d = d.withColumn("_val", split_flag(key_cols or ["raw_log"], validation_split)).withColumn("_valid", valid_features())
    d = materialize(PipelineModel(stages).transform(d).select("features", "label", "_val", "_valid"))
    skipped = d.where(~F.col("_valid")).count()
    tr = d.where(F.col("_valid") & ~F.col("_val")).select("features", "label")
    va = d.where(F.col("_valid") & F.col("_val")).select("features", "label")
    ll = MulticlassClassificationEvaluator(metricName="logLoss")
    acc = MulticlassClassificationEvaluator(metricName="accuracy")
    best, n_va = None, va.count()
    for rp in reg_params:
        m = classifier(rp).fit(tr)
        p = m.transform(va).select("label", "rawPrediction", "probability", "prediction").cache()  # for both evaluators
        loss, hits = (ll.evaluate(p), acc.evaluate(p)) if n_va else (float("nan"), float("nan"))
        p.unpersist()
        if best is None or loss < best[1] or best[1] != best[1]:
            best = (m, loss, rp, hits)
    m, loss, rp, a = best
    spark = labeled_enriched.sparkSession
    metrics = spark.createDataFrame(
        [(tr.count(), n_va, skipped, float(loss), float(a), float(rp))],
        "train_rows bigint, validation_rows bigint, skipped_rows bigint, eval_loss double, accuracy double, reg_param double")
    return PipelineModel([*stages, m]), metrics


def classify(model: PipelineModel, enriched: DataFrame) -> DataFrame:
    """M9: classification, confidence (+ M5 flags) for every row; unbuildable rows -> 'error'."""
    d = feature_frame(enriched)
    d = d.withColumn("_valid", valid_features())
    p = model.transform(d)
    probs = vector_to_array("probability")
    cls_arr = F.array(*[F.lit(c) for c in CLASSES])
    pred = F.element_at(cls_arr, F.col("prediction").cast("int") + 1)
    out = p.withColumns({
        "classification": F.when(F.col("_valid"), pred).otherwise(F.lit(ERROR_CLASS)),
        "confidence": F.when(F.col("_valid"), F.array_max(probs)).otherwise(F.lit(0.0)),
    })
    out = out.withColumns({"is_legitimate": L.is_legitimate(), "is_human": L.is_human()})
    drop = [c for c in out.columns if c.startswith("f_") or c.startswith("_")] + \
           ["features", "rawPrediction", "probability", "prediction"]
    return out.drop(*drop)


def save(model: PipelineModel, path: str, config: dict) -> None:
    """IO12: the fitted pipeline plus its parameters: ``whitelist`` / ``blacklist`` and the
    options of ``enrich_serve``; ``analyze.analyze_packaged`` applies them."""
    model.write().overwrite().save(os.path.join(path, "model"))
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(config),)], "config string").coalesce(1) \
        .write.mode("overwrite").json(os.path.join(path, "config"))


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    m = PipelineModel.load(os.path.join(path, "model"))
    cfg = spark.read.json(os.path.join(path, "config")).first()
    return m, json.loads(cfg["config"]) if cfg else {}
