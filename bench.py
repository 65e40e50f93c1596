"""Headline benchmark: parse, enrich (train), enrich (serve), classify, hourly summary.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  The stages pass Parquet
stage tables in the shared checkpoint folder, as the pipeline does:

    parse -> parsed -> enrich T -> enriched_T -> train ─┐
                    -> enrich S -> enriched_S ──────────┴ classify -> classified -> hourly

Every stage runs in full (all rows written, nothing collected).  The whole
pipeline runs once untimed first (JIT, generated code, Python workers), so
the reported times are steady-state stage times; ``BENCH_WARMUP=0`` skips it.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from trafficlens.functions.fixed import CLASSES  # noqa: E402
from trafficlens.operators.dims import release_all  # noqa: E402
from trafficlens.operators.summary import hourly_summary  # noqa: E402
from trafficlens.plans import catalog as C  # noqa: E402
from trafficlens.plans import enrich as EN  # noqa: E402
from trafficlens.plans import model as MD  # noqa: E402
from trafficlens.session import checkpoint_dir, get_spark  # noqa: E402
from trafficlens.sources.stage_io import write_stage  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app="trafficlens-bench", shuffle_partitions=int(cpus) * 2)
    checkpoint_dir(spark)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def pipeline(warm: bool) -> int:
        base = os.path.join(checkpoint_dir(spark), "bench", uuid.uuid4().hex[:8], "warm" if warm else "timed")

        def stage(name, df):
            path = os.path.join(base, name)
            write_stage(df, path)
            release_all()
            return path

        # parse: raw lines -> typed stage table
        parsed_path = timed("parse", lambda: stage("parsed", C.parsed(spark, sf)))
        parsed = spark.read.parquet(parsed_path)
        n_rows = parsed.count()
        bl = C.blocklist(spark)
        train_path = timed("enrich_train", lambda: stage("enriched_T", EN.enrich_train(parsed, bl, tiebreak=C.TIE)))
        serve_path = timed("enrich_serve", lambda: stage(
            "enriched_S", EN.enrich_serve(parsed.drop("classification", "confidence"), bl, tiebreak=C.TIE)))

        def classify():
            train_rows = spark.read.parquet(train_path).where(F.col("classification").isin(CLASSES))
            model, _ = MD.train(train_rows, 0.1, reg_params=(0.01,), key_cols=["raw_log", "n"])
            return stage("classified", MD.classify(model, spark.read.parquet(serve_path)))
        classified_path = timed("classify", classify)
        timed("hourly", lambda: run(hourly_summary(spark.read.parquet(classified_path))))
        return n_rows

    if os.environ.get("BENCH_WARMUP", "1") != "0":
        pipeline(warm=True)
    times.clear()
    n_rows = pipeline(warm=False)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "pipeline_wall_time", "value": total, "unit": "sec", "queries": times,
                      "rows": n_rows, "rows_per_sec": round(n_rows * len(times) / total, 1),
                      "sf": os.path.basename(sf.rstrip("/")).replace("sf", "")}))


if __name__ == "__main__":
    main()
