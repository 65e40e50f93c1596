"""Connected components of a link table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, write_table

#: Edges of a task; fewer partitions than the session's are used while there are few edges.
PER_TASK = 16_384


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """``links`` (a, b) -> ``node, root``: every linked node and the smallest node of its component.

    Each round makes every node point to the smallest node among its neighbours
    (first its larger, then its smaller ones); edges live in written tables, and
    only their number and a checksum come to the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v <> u").distinct()
    edges = write_table(edges, name)
    measure = [F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))]
    state = edges.agg(*measure).first()
    while True:
        tasks = max(1, -(-state[0] // PER_TASK))
        few = lambda df, n=tasks: df.coalesce(n)
        both = few(edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u"))))
        low = few(both.groupBy("v").agg(F.min("u").alias("m"))).withColumn("m", F.least("m", "v"))
        # large star: the larger neighbours of v point to the smallest
        large = few(few(both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))).distinct())
        # small star: v and its smaller neighbours point to the smallest
        least = few(large.groupBy("v").agg(F.min("u").alias("m")))
        small = few(large.join(least, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
                    .unionByName(least.select("v", F.col("m").alias("u"))))
        old, edges = edges, write_table(few(small.distinct()), name)
        discard(old)
        now = edges.agg(*measure).first()
        if now == state:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        state = now
