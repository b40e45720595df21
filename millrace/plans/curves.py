"""Curves of a scored two-class frame, complete at any number of distinct scores.

Rows are counted by score, the counts are totalled from the best score down without a
one-task window, and every curve is read off those totals. Nothing is binned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_totals


def score_counts(df: DataFrame, score: str | Column, label: str | Column, weight: str | Column | None = None) -> DataFrame:
    """(threshold, tp, fp, positives, negatives): a row for each distinct score, weights of
    the labels 1 and 0 that score at least that much, and of all."""
    score, label, weight = (
        F.lit(1.0) if c is None else F.col(c) if isinstance(c, str) else c for c in (score, label, weight)
    )
    rows = df.select(score.alias("threshold"), label.cast("double").alias("label"), weight.cast("double").alias("weight"))
    up = F.when(F.col("label") > 0.5, F.col("weight")).otherwise(0.0)
    counted = rows.groupBy("threshold").agg(F.sum(up).alias("p"), F.sum(F.col("weight") - up).alias("n")).checkpoint()
    whole = counted.agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"))
    upto = running_totals(counted, [F.col("threshold").desc()], {"tp": "p", "fp": "n"})
    return upto.select("threshold", "tp", "fp").join(F.broadcast(whole))  # one row


def roc(counts: DataFrame) -> DataFrame:
    """(FPR, TPR) from (0, 0) to (1, 1), a point for each score between."""
    ends = counts.sparkSession.range(2).select(F.col("id").cast("double").alias("FPR"), F.col("id").cast("double").alias("TPR"))
    points = counts.select((F.col("fp") / F.col("negatives")).alias("FPR"), (F.col("tp") / F.col("positives")).alias("TPR"))
    return points.unionByName(ends)


def _precision() -> Column:
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def precision_recall(counts: DataFrame) -> DataFrame:
    """(recall, precision): a point for each score, and recall 0 at the first one's precision."""
    points = counts.select("threshold", (F.col("tp") / F.col("positives")).alias("recall"), _precision().alias("precision"))
    first = points.agg(F.max_by("precision", "threshold").alias("precision")).select(F.lit(0.0).alias("recall"), "precision")
    return points.select("recall", "precision").unionByName(first)


def by_threshold(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    """(threshold, f_measure, precision, recall) at every score."""
    precision, recall = _precision(), F.col("tp") / F.col("positives")
    both = beta * beta * precision + recall
    return counts.select(
        "threshold",
        F.when(both == 0, 0.0).otherwise((1 + beta * beta) * precision * recall / both).alias("f_measure"),
        precision.alias("precision"), recall.alias("recall"),
    )
