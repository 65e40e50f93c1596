"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import checkpoint_dir

#: A word: a maximal run of anything but space and U+0009 - U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: A side is broadcast only when its measured row count times its bounded row
#: width stays below this many bytes; larger sides go through a shuffle join.
BROADCAST_BYTES = 32 << 20

#: Rows of an Arrow batch that a Python function gets at once, and rows that it returns at once.
SLICE, PART = 2048, 512

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage and freezes anything that a recomputation could change;
    the files outlive lost executors.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove the files of written tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stage)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed: Spark does so when the driver collects garbage."""
    spark._jvm.System.gc()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_file_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column ``name`` that tells its rows apart and is the same at every reading.

    For a table as read from Parquet files: the hash of the file's path and the
    row's place in the file.  Any other DataFrame (but not one that repeats the
    rows of a file by a join or an explode) is written once with a row number.
    """
    try:
        file = F.xxhash64("_metadata.file_path").alias("file")
        out = df.select("*", F.struct(file, F.col("_metadata.row_index").alias("index")).alias(name))
        out.schema  # resolves the columns
        return out
    except AnalysisException:
        return write_table(df.withColumn(name, F.struct(F.lit(0).cast("bigint").alias("file"),
                                                        F.monotonically_increasing_id().alias("index"))), "rows")


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint when ``rows * row_bytes`` is in bounds."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def id_remainder(doc_id, n: int) -> int:
    """crc32 of the id written as text, modulo ``n`` (a null id counts as '')."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def crc_remainder(column: str, n: int):
    """``id_remainder`` as a column."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def trim() -> None:
    """Give freed memory back to the system; Python workers outlive their tasks."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(run):
    """``run``, a function over Arrow batches, with :func:`trim` at the end of the task."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def add_columns(df: DataFrame, inputs: list[str], added: str, start, drop: list[str] = ()) -> DataFrame:
    """``df`` with the columns of the DDL ``added``, computed in Arrow batches.

    ``start()`` runs once per task and returns ``f``; ``f`` gets the columns
    ``inputs`` of a batch as Python lists and returns one list per new column.
    Every other column passes through untouched (nulls and wide ids included),
    except those in ``drop`` and those that a new column replaces.
    """
    new = T.StructType.fromDDL(added)
    passed = [f for f in df.schema.fields if f.name not in drop and f.name not in new.names]
    schema = T.StructType(passed + new.fields)
    types = [f.type for f in to_arrow_schema(new)]
    names = [f.name for f in passed]

    def run(batches):
        f = start()
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                b = batch.slice(i, SLICE)
                made = f(*[b.column(c).to_pylist() for c in inputs])
                for k in range(0, b.num_rows, PART):
                    part = b.slice(k, PART)
                    arrays = [part.column(c) for c in names] + [pa.array(x[k:k + PART], t) for x, t in zip(made, types)]
                    yield pa.RecordBatch.from_arrays(arrays, names=[x.name for x in schema])
                trim()

    return df.mapInArrow(trimmed(run), schema)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer (wrapping)."""
    x = (x + np.uint64(salt)) * _C1
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))
