"""SparkSession helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark import cloudpickle
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast of a join side only when its measured shuffle
    # size is below this bound; static broadcast is decided separately.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "trafficlens",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the setting is absent *and* the master is local (tests) a scratch
    folder is created and registered; on a cluster a missing setting is an
    error, never a machine-local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
        d = tempfile.mkdtemp(prefix="trafficlens-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def stage_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for materialised stage tables."""
    return os.path.join(checkpoint_dir(spark), "stages", name)


#: Rows of an Arrow batch: texts are long, and a batch is held by the JVM and the worker at once.
ARROW_ROWS = "1000"


def prepare_workers(spark: SparkSession) -> None:
    """What jobs with Python workers rely on: the package by value, and batches of few rows."""
    ship_package()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


#: Bytecode of a generated method beyond which HotSpot leaves it uncompiled.
METHOD_BYTES = "8000"


def prepare_wide_plans(spark: SparkSession) -> None:
    """For plans of many columns: their whole-stage methods pass HotSpot's limit and would run
    interpreted, so such stages run operator by operator, in methods that are compiled."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", METHOD_BYTES)


def ship_package() -> None:
    """Send this package's functions to Python workers by value, so that the
    workers need not have it on their path."""
    import trafficlens
    cloudpickle.register_pickle_by_value(trafficlens)
