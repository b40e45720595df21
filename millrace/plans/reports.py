"""Every metric of an evaluator family from one pass over the scored frame.

An evaluator answers one metric and reads the data once for it. The reports reduce the
frame to a bounded aggregate (a confusion table, or one row of sums) in a single job and
derive all metrics from that. They answer (metric, label, value); label is null where
the metric is not by label.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONG = ["metric", "label", "value"]


def multiclass(
    df: DataFrame,
    prediction: str = "prediction",
    label: str = "label",
    weight: str | None = None,
    beta: float = 1.0,
) -> DataFrame:
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    confusion = df.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("pred")
    ).agg(F.sum(w).alias("w"))
    # one row per (side, class): what was true, what was said, and where both agree
    sides = confusion.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"), F.col("w").alias("actual"), F.lit(0.0).alias("said"),
                    F.when(F.col("label") == F.col("pred"), F.col("w")).otherwise(0.0).alias("tp"),
                ),
                F.struct(
                    F.col("pred").alias("class"), F.lit(0.0).alias("actual"), F.col("w").alias("said"),
                    F.lit(0.0).alias("tp"),
                ),
            )
        )
    )
    per = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("said").alias("said"), F.sum("tp").alias("tp")
    )
    # a row per class by now, so one window over all of them is small
    everything = Window.partitionBy()
    per = per.withColumn("n", F.sum("actual").over(everything)).filter("actual > 0").select(
        "class", "actual", "n", "tp",
        (F.col("actual") / F.col("n")).alias("share"),
        F.when(F.col("said") > 0, F.col("tp") / F.col("said")).otherwise(0.0).alias("precision"),
        (F.col("tp") / F.col("actual")).alias("recall"),
        F.coalesce(
            F.try_divide(F.col("said") - F.col("tp"), F.col("n") - F.col("actual")), F.lit(0.0)
        ).alias("fpr"),
    )

    def f_measure(b: float) -> Column:
        p, r = F.col("precision"), F.col("recall")
        return F.when(p + r > 0, (1 + b * b) * p * r / (b * b * p + r)).otherwise(0.0)

    by_label = {
        "truePositiveRateByLabel": F.col("recall"),
        "falsePositiveRateByLabel": F.col("fpr"),
        "precisionByLabel": F.col("precision"),
        "recallByLabel": F.col("recall"),
        "fMeasureByLabel": f_measure(beta),
    }
    overall = {
        "f1": F.sum(F.col("share") * f_measure(1.0)),
        "accuracy": F.sum(F.col("tp")) / F.max("n"),
        "weightedPrecision": F.sum(F.col("share") * F.col("precision")),
        "weightedRecall": F.sum(F.col("share") * F.col("recall")),
        "weightedTruePositiveRate": F.sum(F.col("share") * F.col("recall")),
        "weightedFalsePositiveRate": F.sum(F.col("share") * F.col("fpr")),
        "weightedFMeasure": F.sum(F.col("share") * f_measure(beta)),
        "hammingLoss": F.lit(1.0) - F.sum(F.col("tp")) / F.max("n"),
    }
    labelled = per.select("class", F.inline(_pairs(by_label))).select(
        "metric", F.col("class").alias("label"), "value"
    )
    totals = per.agg(*[c.alias(n) for n, c in overall.items()])
    return labelled.unionByName(_long(totals))


def log_loss(
    df: DataFrame, probability: str, label: str = "label", weight: str | None = None,
    eps: float = 1e-15,
) -> DataFrame:
    """``probability`` is an array column."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    p = F.col(probability)[F.col(label).cast("int")]
    p = F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps))
    return _long(df.agg((F.sum(-w * F.log(p)) / F.sum(w)).alias("logLoss")))


def regression(
    df: DataFrame,
    prediction: str = "prediction",
    label: str = "label",
    weight: str | None = None,
    through_origin: bool = False,
) -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    # moments about the mean come from aggregates that keep them stable for any offset
    if weight is None:
        mean_y, mean_p, spread_p = F.avg(y), F.avg(p), F.var_pop(p)
        base = F.var_pop(y)
    else:
        both = array_to_vector(F.array(y, p))
        s = Summarizer.metrics("mean", "variance").summary(both, w)
        mean, var = vector_to_array(s["mean"]), vector_to_array(s["variance"])
        total, freedom = F.sum(w), F.sum(w) - F.sum(w * w) / F.sum(w)
        mean_y, mean_p = mean[0], mean[1]
        spread_p = var[1] * freedom / total
        # the total variation of a weighted r2 counts the weight of one row less, as Spark does
        base = var[0] * (total - 1.0) / total
    around = spread_p + (mean_p - mean_y) * (mean_p - mean_y)
    n = F.sum(w)
    mse = F.sum(w * (y - p) * (y - p)) / n
    if through_origin:
        base = F.sum(w * y * y) / n
    totals = df.agg(
        F.sqrt(mse).alias("rmse"), mse.alias("mse"), (1.0 - mse / base).alias("r2"),
        (F.sum(w * F.abs(y - p)) / n).alias("mae"), around.alias("var"),
    )
    return _long(totals)


def multilabel(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Over sets: repeated values in an array count once."""
    said, true = F.array_distinct(F.col(prediction)), F.array_distinct(F.col(label))
    rows = df.select(
        said.alias("said"), true.alias("true"),
        F.size(F.array_intersect(said, true)).cast("double").alias("both"),
        F.size(said).cast("double").alias("n_said"), F.size(true).cast("double").alias("n_true"),
    )
    per = rows.select(
        F.inline(
            F.concat(
                F.transform("true", lambda c: F.struct(
                    c.alias("class"), F.lit(1.0).alias("actual"), F.lit(0.0).alias("claimed"),
                    F.array_contains("said", c).cast("double").alias("tp"))),
                F.transform("said", lambda c: F.struct(
                    c.alias("class"), F.lit(0.0).alias("actual"), F.lit(1.0).alias("claimed"),
                    F.lit(0.0).alias("tp"))),
            )
        )
    ).groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("claimed").alias("claimed"), F.sum("tp").alias("tp")
    )
    both, n_said, n_true = F.col("both"), F.col("n_said"), F.col("n_true")
    equal = (both == n_said) & (both == n_true)
    totals = rows.agg(
        F.avg(equal.cast("double")).alias("subsetAccuracy"),
        F.avg(F.coalesce(F.try_divide(both, n_said + n_true - both), F.lit(0.0))).alias("accuracy"),
        F.avg(n_said + n_true - 2 * both).alias("_wrong"),
        F.avg(F.coalesce(F.try_divide(both, n_said), F.lit(0.0))).alias("precision"),
        F.avg(F.coalesce(F.try_divide(both, n_true), F.lit(0.0))).alias("recall"),
        F.avg(F.coalesce(F.try_divide(2 * both, n_said + n_true), F.lit(0.0))).alias("f1Measure"),
        (F.sum(both) / F.sum(n_said)).alias("microPrecision"),
        (F.sum(both) / F.sum(n_true)).alias("microRecall"),
        (2 * F.sum(both) / (F.sum(n_said) + F.sum(n_true))).alias("microF1Measure"),
    )
    width = per.filter("actual > 0").agg(F.lit(1).alias("_row"), F.count("*").alias("_width"))
    totals = totals.withColumn("_row", F.lit(1)).join(width, "_row")  # one row each
    totals = totals.withColumn("hammingLoss", F.expr("_wrong / _width"))
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("claimed")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("actual")), F.lit(0.0))
    labelled = per.select(
        "class",
        F.inline(_pairs({
            "precisionByLabel": p,
            "recallByLabel": r,
            "f1MeasureByLabel": F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)),
        })),
    ).select("metric", F.col("class").cast("double").alias("label"), "value")
    return labelled.unionByName(_long(totals.drop("_wrong", "_width", "_row")))


def ranking(
    df: DataFrame, ks: Sequence[int] = (10,), prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """Ranking metrics; the ``AtK`` ones for each cut-off, with the cut-off as label."""
    rows = df.select(F.col(prediction).alias("p"), F.array_distinct(F.col(label)).alias("t"))
    rows = rows.withColumn("m", F.size("t")).withColumn(
        # positions (from 1) at which the ranking hits the truth
        "hits",
        F.filter(
            F.transform("p", lambda x, i: F.when(F.array_contains("t", x), i + 1)),
            lambda h: h.isNotNull(),
        ),
    )

    def precision_sum(hits: Column) -> Column:
        ratios = F.transform(hits, lambda h, i: (i + 1).cast("double") / h)
        return F.aggregate(ratios, F.lit(0.0), lambda a, x: a + x)

    def gain(positions: Column) -> Column:
        return F.aggregate(
            positions, F.lit(0.0), lambda a, h: a + 1.0 / F.log(h.cast("double") + 1.0)
        )

    whole = rows.agg(
        F.avg(F.when(F.col("m") > 0, precision_sum(F.col("hits")) / F.col("m")).otherwise(0.0)).alias(
            "meanAveragePrecision"
        )
    )
    parts = [_long(whole)]
    at_k = []
    for k in ks:
        near = F.filter("hits", _at_most(k))
        best = F.sequence(F.lit(1), F.least(F.col("m"), F.lit(k)))
        some = F.col("m") > 0
        at_k += [
            F.avg(F.when(some, precision_sum(near) / F.least(F.col("m"), F.lit(k))).otherwise(0.0))
            .alias(f"meanAveragePrecisionAtK:{k}"),
            F.avg(F.when(some, F.size(near) / F.lit(float(k))).otherwise(0.0)).alias(f"precisionAtK:{k}"),
            F.avg(F.when(some, gain(near) / gain(best)).otherwise(0.0)).alias(f"ndcgAtK:{k}"),
            F.avg(F.when(some, F.size(near) / F.col("m")).otherwise(0.0)).alias(f"recallAtK:{k}"),
        ]
    cut = _long(rows.agg(*at_k)).select(
        F.split_part(F.col("metric"), F.lit(":"), F.lit(1)).alias("metric"),
        F.split_part(F.col("metric"), F.lit(":"), F.lit(2)).cast("double").alias("label"),
        "value",
    )
    return reduce(DataFrame.unionByName, [*parts, cut])


def _at_most(k: int):
    # made apart from the loop: a lambda of two arguments would be given the position too
    return lambda position: position <= k


def _pairs(named: dict[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("metric"), c.alias("value")) for n, c in named.items()])


def _long(totals: DataFrame) -> DataFrame:
    """A one-row frame of metrics as (metric, label=null, value) rows."""
    named = {n: F.col(f"`{n}`").cast("double") for n in totals.columns}
    return totals.select(F.inline(_pairs(named))).select(
        "metric", F.lit(None).cast("double").alias("label"), "value"
    )
