"""Machine-learning analytics over DataFrames: features, models, evaluation, statistics,
similarity, patterns and tuned searches, with learned state published as tables."""

from . import functions, operators, plans, sources, streaming
from .functions.tables import attribute, plain, trees
from .plans.scoring import columns, score
from .plans.tuning import best_index, cross_validator, fold_by_key, param_grid, train_validation_split
from .plans.verbs import (
    assign_clusters,
    evaluate,
    evaluate_model,
    find_frequent_sequential_patterns,
    fit,
    larger_better,
    pipeline,
    summary,
    transform,
)
from .sources import load, save, table

__all__ = [
    "assign_clusters", "attribute", "best_index", "columns", "cross_validator", "evaluate",
    "evaluate_model", "find_frequent_sequential_patterns", "fit", "fold_by_key", "functions",
    "larger_better", "load", "operators", "param_grid", "pipeline", "plain", "plans", "save",
    "score", "sources", "streaming", "summary", "table", "train_validation_split", "transform",
    "trees",
]
