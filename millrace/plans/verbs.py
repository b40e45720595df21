"""fit, transform, evaluate and the staged forms of them."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame

from ..functions.frames import small_frame
from ..functions.tables import attribute, plain
from .tuning import Search, SearchResult


def pipeline(stages: Sequence[Any]) -> Pipeline:
    """Estimators, transformers, fitted models and nested pipelines, run in order."""
    for position, stage in enumerate(stages):
        if not isinstance(stage, (Estimator, Transformer)):
            raise TypeError(
                f"stage {position} is a {type(stage).__name__}; "
                "a stage is an estimator, a transformer or a fitted model"
            )
    return Pipeline(stages=list(stages))


def fit(estimator: Any, df: DataFrame) -> Any:
    """Train. A fitted pipeline stage after the last estimator never sees the data."""
    if isinstance(estimator, (Estimator, Search)):
        return estimator.fit(df)
    raise TypeError(f"{type(estimator).__name__} is not something to fit")


def transform(stage: Any, df: DataFrame) -> DataFrame:
    """Append the output columns of a transformer or model; lazy.

    A search result scores with its winner.
    """
    if isinstance(stage, SearchResult):
        stage = stage.best_model
    if not isinstance(stage, Transformer):
        raise TypeError(f"{type(stage).__name__} does not transform; fit it first")
    return stage.transform(df)


def evaluate(evaluator: Evaluator, df: DataFrame) -> DataFrame:
    """(metric, value) of an already scored frame, one row."""
    value = float(evaluator.evaluate(df))
    row = [(evaluator.getMetricName(), value)]
    return small_frame(df.sparkSession, row, "metric string, value double")


def larger_better(evaluator: Evaluator) -> bool:
    return evaluator.isLargerBetter()


def summary(model: Model) -> Any:
    """Training metrics of a model; a loaded model has none (use ``evaluate_model``)."""
    if not getattr(model, "hasSummary", False):
        raise ValueError(f"{type(model).__name__} {model.uid} has no training summary")
    found = model.summary  # a property of some models and a method of others
    return found() if callable(found) else found


def evaluate_model(model: Model, df: DataFrame) -> Any:
    """The summary of a model on new data."""
    return model.evaluate(df)


def assign_clusters(helper: Any, edges: DataFrame) -> DataFrame:
    """Power iteration clustering of an edge list -> (id, cluster)."""
    return helper.assignClusters(edges)


def find_frequent_sequential_patterns(helper: Any, sequences: DataFrame) -> DataFrame:
    """PrefixSpan over an ``array<array<T>>`` column -> (sequence, freq)."""
    return helper.findFrequentSequentialPatterns(sequences)


__all__ = [
    "assign_clusters", "attribute", "evaluate", "evaluate_model",
    "find_frequent_sequential_patterns", "fit", "larger_better", "pipeline", "plain", "summary",
    "transform",
]
