"""A count-based classifier beside logistic regression (M8, M9): naive Bayes in closed form.

A request is the set of its true flags and of its path's tokens.  With ``N_c``
training rows of class ``c``, of which ``n_tc`` have feature ``t``::

    log prior(c)     = ln((N_c + 1) / (N + classes))
    log weight(t, c) = ln((n_tc + 1) / (T_c + V)),  T_c = sum over t of n_tc, V = number of features

Training is one aggregate over the rows (flags: a bounded number of counts) and
one over the path tokens, a table that stays distributed.  Serving adds constant
weights for the flags to a per-path sum, computed once per distinct path and
joined back behind the usual size check.  Tokens never seen in training do not
count.  The class of the highest sum wins, ties in the fixed order of classes;
the confidence is its share after ``exp``.  A row with a null flag is ``error``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.fixed import CLASSES, ERROR_CLASS
from ..operators.dims import join_dim, materialize
from .model import BOOL_FEATURES

#: Flags that depend on the request itself, not on statistics over the log.
REQUEST_FLAGS = [f for f in BOOL_FEATURES if f not in (
    "ip_is_known_bad", "is_high_risk_country", "is_high_risk_asn", "potential_dos", "potential_scanner",
    "during_traffic_spike", "from_coordinated_asn", "to_high_error_path")]

TOKEN_SPLIT = r"[/?&=.\-_]+"
SUMS = [f"_s{i}" for i in range(len(CLASSES))]


def path_tokens(path: str = "path") -> Column:
    """The distinct lower-case tokens of a path."""
    parts = F.split(F.lower(F.coalesce(F.col(path), F.lit(""))), TOKEN_SPLIT)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


@dataclass
class CountsModel:
    prior: list[float]  # per class
    flags: dict[str, list[float]]  # weight per class
    tokens: DataFrame  # token, one weight column per class

    def tables(self) -> DataFrame:
        """``classification, feature, log_weight`` of every feature and class."""
        spark = self.tokens.sparkSession
        fixed = [("prior", *self.prior)] + [(f"flag:{f}", *w) for f, w in self.flags.items()]
        rows = spark.createDataFrame(fixed, ["feature", *SUMS]).unionByName(
            self.tokens.select(F.concat(F.lit("path:"), F.col("token")).alias("feature"), *SUMS))
        stack = ", ".join(f"'{c}', {s}" for c, s in zip(CLASSES, SUMS))
        return rows.selectExpr("feature", f"stack({len(CLASSES)}, {stack}) as (classification, log_weight)")

    def classify(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``classification``, ``confidence`` and the M5 flags."""
        paths = (rows.select("path").distinct().withColumn("token", F.explode(path_tokens()))
                 .join(self.tokens, "token").groupBy("path").agg(*[F.sum(s).alias(s) for s in SUMS]))
        d = join_dim(rows, paths, "path")
        valid = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in self.flags], F.lit(True))

        def score(i: int) -> Column:
            flags = [F.when(F.col(f), F.lit(w[i])).otherwise(F.lit(0.0)) for f, w in self.flags.items()]
            return reduce(lambda a, b: a + b, flags, F.lit(self.prior[i]) + F.coalesce(F.col(SUMS[i]), F.lit(0.0)))

        d = d.withColumn("_scores", F.array(*[score(i) for i in range(len(CLASSES))]))
        best = F.array_max("_scores")
        share = 1.0 / F.aggregate("_scores", F.lit(0.0), lambda acc, x: acc + F.exp(x - best))
        name = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), F.array_position("_scores", best).cast("int"))
        d = d.withColumns({"classification": F.when(valid, name).otherwise(F.lit(ERROR_CLASS)),
                           "confidence": F.when(valid, share).otherwise(F.lit(0.0))})
        return d.withColumns({"is_legitimate": L.is_legitimate(), "is_human": L.is_human()}).drop("_scores", *SUMS)


def fit(labeled: DataFrame, flags: list[str] = REQUEST_FLAGS) -> CountsModel:
    """M8: count the labelled rows (those of one of the four classes)."""
    from math import log
    d = labeled.where(F.col("classification").isin(CLASSES)).select("classification", "path", *flags)
    of = [F.col("classification") == c for c in CLASSES]
    one = d.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(of)],
                *[F.count_if(c & F.col(f)).alias(f"{f}{i}") for f in flags for i, c in enumerate(of)]).first()
    counts = materialize(d.withColumn("token", F.explode(path_tokens())).groupBy("token").agg(
        *[F.count_if(c).alias(s) for c, s in zip(of, SUMS)]))
    sums = counts.agg(F.count(F.lit(1)).alias("v"), *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in SUMS]).first()
    n = [one[f"n{i}"] for i in range(len(CLASSES))]
    size = [sum(one[f"{f}{i}"] for f in flags) + sums[SUMS[i]] + len(flags) + sums["v"] for i in range(len(CLASSES))]
    weight = lambda k, i: log((k + 1) / size[i])
    tokens = counts.select("token", *[F.ln((F.col(s) + 1) / F.lit(float(size[i]))).alias(s) for i, s in enumerate(SUMS)])
    return CountsModel([log((k + 1) / (sum(n) + len(CLASSES))) for k in n],
                       {f: [weight(one[f"{f}{i}"], i) for i in range(len(CLASSES))] for f in flags}, tokens)
