"""Stage tables as files (IO3-IO6, IO10).

Stages pass Parquet between each other; CSV and JSON Lines remain user-facing
sources/sinks with explicit schemas (no inference).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from ..operators.parse import parse_access_log
from ..operators.traffic import default_order
from ..schemas import HOURLY, TRAINING_EXAMPLE


def read_stage_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """IO3: a CSV stage table with header, RFC-4180 quoting and multi-line fields."""
    return (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", True).csv(path))


def write_stage_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO4: CSV sink ("overwrite" for the first write, "append" after)."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_stage(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                order_by: list[str] | None = None) -> None:
    """Parquet stage table; partition by a date column for pruning of later reads.

    ``order_by`` (S1) sorts the table: its files follow one another by range, and
    the rows are sorted within each.
    """
    if order_by:
        df = df.orderBy(*order_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_parsed(lines: DataFrame, path: str, mode: str = "overwrite", value_col: str = "value",
                 drop_redirects: bool = True) -> dict[str, int]:
    """Parse lines into a Parquet table and return the P9 counters of what was written.

    The counters are observed by the writing tasks: the lines are read once, and
    an attempt that fails does not count (only a finished write task reports).
    """
    seen = Observation("parse")
    parse_access_log(lines, value_col, drop_redirects, seen).write.mode(mode).parquet(path)
    return {k: int(v) for k, v in seen.get.items()}


def first_rows(df: DataFrame, k: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """The first ``k`` rows in the order of the columns (by default file order, then
    the raw line), which makes the choice definite; a top-k, no global sort."""
    return df.orderBy(*(order_by or default_order(df))).limit(k)


def write_training_jsonl(examples: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO5: JSON Lines of ``{input, output}``."""
    examples.select("input", "output").write.mode(mode).json(path)


def read_training_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """IO6."""
    return spark.read.schema(TRAINING_EXAMPLE).json(path)


def read_hourly_csv(spark: SparkSession, path: str) -> DataFrame:
    """IO10: an hourly summary table, sorted by hour."""
    return read_stage_csv(spark, path, HOURLY).orderBy("hour")
