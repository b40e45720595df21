"""Every registered query with its SQL check."""

from . import (
    aggregates,
    clusters,
    estimators,
    evaluators,
    fits,
    invariants,
    patterns,
    predictors,
    searches,
    states,
    summaries,
    transformers,
)
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "aggregates", "clusters", "estimators", "evaluators", "fits", "invariants", "patterns", "predictors", "searches", "states", "summaries", "transformers"]
