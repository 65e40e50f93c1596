"""Labelling (M2) and training-text (M6) jobs.

The reference calls a remote model per row; here the labeller is pluggable:

* ``rule_labeller`` (default) - a deterministic rule set over the enriched
  flags, as column expressions (own design, no network);
* any user function ``fn(pandas.DataFrame) -> pandas.DataFrame`` with columns
  ``classification, confidence, reasoning``, run with ``mapInPandas`` over
  Arrow batches.  The answer must have the rows and the index of the batch; a
  batch that fails (or answers for other rows) is retried row by row, each row up
  to ``max_retries`` times; a row that still fails gets ``unknown`` / 0.0 / the
  error text, so output rows = input rows.  The sample
  is spread over tasks first (the top-n arrives in one partition), and the
  labelled rows are checkpointed to the shared folder, so each row is labelled
  once even though later steps (split, counts, training) read it several times.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import features as X
from ..functions import labels as L
from ..functions.fixed import UNKNOWN_CLASS
from ..operators.dims import materialize
from ..operators.sampling import sample_exact

BOT_SIGNALS = ["is_known_bot", "is_malicious_user_agent", "potential_dos", "potential_scanner"]
BAD_SIGNALS = ["has_malicious_pattern", "ip_is_known_bad", "potential_dos", "potential_scanner",
               "is_malicious_user_agent", "likely_malicious_human"]


def rule_labeller(df: DataFrame) -> DataFrame:
    """Deterministic labels from enriched flags: classification, confidence, reasoning."""
    no_ua = ~F.col("has_user_agent")
    bot = X.any_of(BOT_SIGNALS) | no_ua
    bad = X.any_of(BAD_SIGNALS) | (no_ua & F.col("is_error"))
    cls = (F.when(bad & bot, "illegitimate_bot").when(bad, "illegitimate_human")
            .when(bot, "legitimate_bot").otherwise("legitimate_human"))
    fired = [F.when(F.col(s), F.lit(s)) for s in dict.fromkeys(BOT_SIGNALS + BAD_SIGNALS)]
    fired.append(F.when(no_ua, F.lit("no_user_agent")))
    n_fired = sum(F.col(s).cast("int") for s in dict.fromkeys(BOT_SIGNALS + BAD_SIGNALS)) + no_ua.cast("int")
    conf = F.least(F.lit(0.95), F.lit(0.6) + F.lit(0.1) * n_fired)
    reason = F.concat_ws("; ", *fired)
    return df.withColumns({
        "classification": cls,
        "confidence": conf.cast("double"),
        "reasoning": F.when(reason == "", F.lit("no risk indicator")).otherwise(reason),
    })


LABEL_NAMES = ["classification", "confidence", "reasoning"]


def _answers(fn, pdf: pd.DataFrame) -> pd.DataFrame:
    """The three label columns for the rows of ``pdf``, in order.  An answer of another
    length, with another index or without a column is an error."""
    res = fn(pdf)
    if len(res) != len(pdf) or not res.index.equals(pdf.index):
        raise ValueError(f"the labeller returned {len(res)} rows for {len(pdf)}, or changed their index")
    return pd.DataFrame({c: res[c].astype(float if c == "confidence" else object).values for c in LABEL_NAMES})


def _apply_user_fn(fn: Callable[[pd.DataFrame], pd.DataFrame], max_retries: int = 3):
    def one(row: pd.DataFrame) -> pd.DataFrame:
        for attempt in range(max(1, max_retries)):
            try:
                return _answers(fn, row)
            except Exception as e:
                error = e
        return pd.DataFrame([(UNKNOWN_CLASS, 0.0, f"Error: {error}")], columns=LABEL_NAMES)

    def run(batches):
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            try:
                out = _answers(fn, pdf)
            except Exception:
                rows = [one(pdf.iloc[i:i + 1].reset_index(drop=True)) for i in range(len(pdf))]
                out = pd.concat(rows, ignore_index=True) if rows else pd.DataFrame(columns=LABEL_NAMES)
            yield pd.concat([pdf, out], axis=1)
    return run


def label(enriched: DataFrame, max_samples: int = 1000, seed: int = 42,
          labeller: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
          key_cols: list[str] | None = None, batch_size: int = 10,
          partitions: int | None = None, max_retries: int = 3) -> DataFrame:
    """M2: sample (S5) then label each sampled row; 3 label columns appended.

    With a user ``labeller``: the sample is spread over ``partitions`` tasks
    (default: one per ``batch_size`` rows, at most the default parallelism)
    and the labelled rows are checkpointed (one job), so the labeller runs
    once per row.
    """
    s = sample_exact(enriched, max_samples, seed, key_cols=key_cols)
    if labeller is None:
        out = rule_labeller(s)
    else:
        base = [f for f in s.schema.fields if f.name not in ("classification", "confidence", "reasoning")]
        s = s.select(*[f.name for f in base])
        if partitions is None:
            par = s.sparkSession.sparkContext.defaultParallelism
            partitions = max(1, min(par, -(-max_samples // batch_size))) if max_samples > 0 else par
        s = s.repartition(partitions)
        schema = T.StructType(base + list(L.LABEL_SCHEMA.fields))
        out = s.mapInPandas(_apply_user_fn(labeller, max_retries), schema)
    out = out.withColumns({
        "classification": F.coalesce("classification", F.lit(UNKNOWN_CLASS)),
        "confidence": F.coalesce("confidence", F.lit(0.0)),
        "reasoning": F.coalesce("reasoning", F.lit("")),
    })
    return materialize(out) if labeller is not None else out


def training_examples(labeled: DataFrame) -> DataFrame:
    """M6: (input, output) text pairs for training/validation files (IO5)."""
    cat = X.ua_category()
    return labeled.select(L.request_facts(cat).alias("input"), L.label_text().alias("output"))


def labelling_prompts(enriched: DataFrame) -> DataFrame:
    """M1 over a table: one prompt per row."""
    return enriched.withColumn("prompt", L.labelling_prompt())
