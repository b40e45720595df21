"""Grid search by cross-validation or by one train / validation split.

The checks that go wrong quietly are made loudly: a grid entry that belongs to no stage
is refused before the first fit, and a metric that is not finite stops the search. The
answer is a table of the search besides the winner, refitted on all rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param
from pyspark.ml.tuning import (
    CrossValidator,
    CrossValidatorModel,
    TrainValidationSplit,
    TrainValidationSplitModel,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import small_frame
from ..operators.base import param_names, snake

ParamMap = dict[Param, Any]


def param_grid(*axes: tuple[Any, dict[str, Sequence[Any]]]) -> list[ParamMap]:
    """Every combination over ``(operator, {param: values})`` axes; the last varies fastest."""
    choices: list[list[tuple[Param, Any]]] = []
    for op, values in axes:
        known = param_names(type(op))
        for name, options in values.items():
            if snake(name) not in known:
                raise TypeError(f"{type(op).__name__} has no param {name!r}")
            if not list(options):
                raise ValueError(f"no values to try for {name!r}")
            choices.append([(op.getParam(known[snake(name)]), option) for option in options])
    return [dict(combination) for combination in itertools.product(*choices)]


def best_index(metrics: Sequence[float], larger_is_better: bool) -> int:
    """Position of the best metric; a tie goes to the first."""
    best = max(metrics) if larger_is_better else min(metrics)
    return list(metrics).index(best)


def mean_and_spread(values: Sequence[float]) -> tuple[float, float]:
    """Mean and population standard deviation, safe for huge metrics; equal ones spread 0."""
    largest = max(abs(v) for v in values)
    if largest == 0.0 or min(values) == max(values):
        return float(values[0]), 0.0
    scale = 2.0 ** (math.frexp(largest)[1] - 1)  # itself no overflow at any metric
    scaled = np.asarray(values, dtype=float) / scale
    return float(scaled.mean() * scale), float(scaled.std() * scale)


@dataclass
class SearchResult:
    best_model: Model
    best: int
    avg_metrics: list[float]
    std_metrics: list[float]
    param_maps: list[ParamMap]
    fitted: Any  # the Spark model of the search, for saving
    sub_models: list[list[Model]] | None = None

    def table(self, spark) -> DataFrame:
        """(grid_id, params, avg_metric, std_metric, is_best), one row per param map."""
        rows = [
            (i, {f"{p.parent}.{p.name}": str(v) for p, v in m.items()}, a, s, i == self.best)
            for i, (m, a, s) in enumerate(zip(self.param_maps, self.avg_metrics, self.std_metrics))
        ]
        return small_frame(
            spark,
            rows,
            "grid_id int, params map<string,string>, avg_metric double, "
            "std_metric double, is_best boolean",
        )


@dataclass
class Search:
    """Shared part of the two searches; subclasses say how rows are cut."""

    estimator: Estimator
    grid: list[ParamMap]
    evaluator: Evaluator
    seed: int = 42
    parallelism: int = 1
    collect_sub_models: bool = False
    storage: StorageLevel = field(default_factory=lambda: StorageLevel.MEMORY_AND_DISK)

    def fit(self, df: DataFrame) -> SearchResult:
        check_grid(self.estimator, self.grid)
        per_fold: list[list[float]] = []
        kept: list[list[Model]] = []
        # one copy for all folds: every cut is a filter over it
        shared = self._drawn(df).persist(self.storage)
        try:
            for number, (train, validation) in enumerate(self._cuts(shared)):
                metrics, models = self._score(train, validation)
                for position, metric in enumerate(metrics):
                    if not math.isfinite(metric):
                        raise ValueError(
                            f"{self.evaluator.getMetricName()} is {metric} for grid entry "
                            f"{position} on fold {number}: the search cannot rank it"
                        )
                per_fold.append(metrics)
                kept.append(models)
            averages, spreads = map(list, zip(*[mean_and_spread(list(m)) for m in zip(*per_fold)]))
            best = best_index(averages, self.evaluator.isLargerBetter())
            winner = self.estimator.fit(shared.drop(self._draw), self.grid[best])
        finally:
            shared.unpersist()
        sub_models = kept if self.collect_sub_models else None
        fitted = self._fitted(winner, averages, spreads, sub_models)
        return SearchResult(winner, best, averages, spreads, self.grid, fitted, sub_models)

    def _score(self, train: DataFrame, validation: DataFrame) -> tuple[list[float], list[Model]]:
        def one(param_map: ParamMap) -> tuple[float, Model | None]:
            model = self.estimator.fit(train, param_map)
            metric = float(self.evaluator.evaluate(model.transform(validation)))
            return metric, model if self.collect_sub_models else None

        if self.parallelism > 1:
            with ThreadPool(min(self.parallelism, len(self.grid))) as pool:
                done = pool.map(one, self.grid)
        else:
            done = [one(m) for m in self.grid]
        return [d[0] for d in done], [d[1] for d in done if d[1] is not None]

    @property
    def _draw(self) -> str:
        return f"{self.estimator.uid}_rand"

    def _drawn(self, df: DataFrame) -> DataFrame:
        # one draw for all folds: a draw per fold would let train and validation overlap
        return df.withColumn(self._draw, F.rand(self.seed))

    def _cuts(self, df: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
        """(train, validation) pairs of a frame that ``_drawn`` made."""
        raise NotImplementedError

    def _fitted(self, winner, averages, spreads, sub_models):
        raise NotImplementedError


@dataclass
class CrossValidation(Search):
    num_folds: int = 3
    fold_col: str | None = None

    def _drawn(self, df):
        return df if self.fold_col is not None else super()._drawn(df)

    def _cuts(self, df):
        if self.num_folds < 2:
            raise ValueError("num_folds must be 2 or more")
        if self.fold_col is not None:
            counted = {r[0]: r[1] for r in df.groupBy(self.fold_col).count().limit(self.num_folds + 1).collect()}
            if set(counted) != set(range(self.num_folds)):
                raise ValueError(
                    f"{self.fold_col} must hold every fold 0..{self.num_folds - 1} and no other value"
                )
            for fold in range(self.num_folds):
                inside = F.col(self.fold_col) == fold
                yield df.filter(~inside), df.filter(inside)
            return
        for fold in range(self.num_folds):
            low, high = fold / self.num_folds, (fold + 1) / self.num_folds
            inside = (F.col(self._draw) >= low) & (F.col(self._draw) < high)
            yield df.filter(~inside).drop(self._draw), df.filter(inside).drop(self._draw)

    def operator(self) -> CrossValidator:
        """The same search as Spark's own estimator, e.g. to save it unfitted."""
        op = CrossValidator(
            estimator=self.estimator, estimatorParamMaps=self.grid, evaluator=self.evaluator,
            numFolds=self.num_folds, seed=self.seed, parallelism=self.parallelism,
            collectSubModels=self.collect_sub_models,
        )
        return op if self.fold_col is None else op.setFoldCol(self.fold_col)

    def _fitted(self, winner, averages, spreads, sub_models):
        model = CrossValidatorModel(winner, averages, sub_models, spreads)
        return self.operator()._copyValues(model)


@dataclass
class TrainValidation(Search):
    train_ratio: float = 0.75

    def _cuts(self, df):
        held = F.col(self._draw) >= self.train_ratio
        yield df.filter(~held).drop(self._draw), df.filter(held).drop(self._draw)

    def operator(self) -> TrainValidationSplit:
        return TrainValidationSplit(
            estimator=self.estimator, estimatorParamMaps=self.grid, evaluator=self.evaluator,
            trainRatio=self.train_ratio, seed=self.seed, parallelism=self.parallelism,
            collectSubModels=self.collect_sub_models,
        )

    def _fitted(self, winner, averages, spreads, sub_models):
        flat = sub_models[0] if sub_models else None
        return self.operator()._copyValues(TrainValidationSplitModel(winner, averages, flat))


def cross_validator(estimator, grid, evaluator, **rules: Any) -> CrossValidation:
    return CrossValidation(estimator, grid, evaluator, **rules)


def train_validation_split(estimator, grid, evaluator, **rules: Any) -> TrainValidation:
    return TrainValidation(estimator, grid, evaluator, **rules)


def fold_by_key(folds: int, *keys: str | Column) -> Column:
    """A fold number from a hash of key columns: the same cut on every run and cluster."""
    return F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int")


def check_grid(estimator: Estimator, grid: Sequence[ParamMap]) -> None:
    if not grid:
        raise ValueError("the grid is empty")
    owners = set(_uids(estimator))
    for param_map in grid:
        for param in param_map:
            if param.parent not in owners:
                raise ValueError(
                    f"grid param {param.name!r} belongs to {param.parent}, "
                    f"which is neither {estimator.uid} nor a stage of it"
                )


def _uids(estimator: Any) -> Iterator[str]:
    yield estimator.uid
    if isinstance(estimator, Pipeline):
        for stage in estimator.getStages():
            yield from _uids(stage)
