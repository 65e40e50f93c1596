"""Small frames for the tests of this folder."""

from trafficlens.session import ship_package

ship_package()

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("score", "size", "draw", "bin", "target", "taken", "ids", "node", "row", "rank", "n_lines", "gone", "kept", "__row")


def docs(spark, rows, clashing=False):
    """Documents from (doc_id, text[, lang[, source]]); with extra columns whose names clash on request."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        for c in CLASHING:
            from pyspark.sql import functions as F
            df = df.withColumn(c, F.lit("x"))
    return df
