"""Per-key table helpers: one-job size checks and bounded joins."""

from pyspark.sql import functions as F

from trafficlens.operators.dims import flag_join, join_dim, null_safe_join, release_all, scope, sizes


def test_sizes_measures_every_table_in_one_job(spark):
    text = spark.range(100).withColumn("t", F.lpad(F.col("id").cast("string"), 5000, "x"))
    tables = {
        "ten": spark.range(10),
        "empty": spark.range(0),
        "grouped": spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(),
        "text": text,
    }
    with scope():
        kept, small = sizes(tables, max_rows=9)
        assert small == {"ten": False, "empty": True, "grouped": True, "text": False}
        kept, small = sizes(tables, max_bytes=100_000)
        assert small == {"ten": True, "empty": True, "grouped": True, "text": False}
        assert kept["ten"].storageLevel.useMemory and not kept["text"].storageLevel.useMemory
    assert not kept["ten"].storageLevel.useMemory  # released with the scope
    assert sizes({}) == ({}, {})


def test_null_safe_join(spark):
    rows = spark.createDataFrame([(1, None), (2, "\x00null"), (3, "a"), (4, "b")], "i int, k string")
    dim = spark.createDataFrame([(None, 10), ("\x00null", 20), ("a", 30)], "k string, v int")
    for small in (True, False):
        got = sorted((r.i, r.v) for r in null_safe_join(rows, dim, ["k"], small).collect())
        assert got == [(1, 10), (2, 20), (3, 30), (4, None)]


def test_bounded_joins_same_rows_either_way(spark):
    rows = spark.range(200).withColumn("k", F.col("id") % 13)
    dim = spark.range(13).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 10)
    keys = spark.range(0, 13, 3).withColumnRenamed("id", "k")

    def run(**kw):
        d = flag_join(join_dim(rows, dim, "k", **kw), keys, "k", "flag", **kw)
        return sorted(tuple(r) for r in d.select("id", "v", "flag").collect())

    want = sorted((i, (i % 13) * 10, (i % 13) % 3 == 0) for i in range(200))
    assert run() == want                        # counted, broadcast
    assert run(max_broadcast_rows=0) == want    # counted, shuffle join
    assert run(small=True) == want              # measured before, no job
    assert run(small=False) == want
    release_all()
