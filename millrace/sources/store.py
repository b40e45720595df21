"""Saving and loading operators, models, staged models and searches.

Spark's own writers and readers do the work, so what is written here loads anywhere
Spark ML runs. Paths may be on any filesystem the cluster reaches.
"""

from __future__ import annotations

from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import CrossValidatorModel, TrainValidationSplitModel

from ..plans.tuning import Search, SearchResult


def save(thing: Any, path: str, overwrite: bool = False, **options: str) -> None:
    """``options`` go to the writer, e.g. ``persistSubModels="true"``."""
    if isinstance(thing, SearchResult):
        thing = thing.fitted
    elif isinstance(thing, Search):
        thing = thing.operator()
    writer = thing.write()
    for name, value in options.items():
        writer = writer.option(name, value)
    (writer.overwrite() if overwrite else writer).save(path)


def load(cls: type, path: str) -> Any:
    """Load as ``cls``; a folder that holds another class is refused."""
    saved = _saved_class(path)
    if saved is not None and saved.rsplit(".", 1)[-1] != cls.__name__:
        raise ValueError(f"{path} holds a {saved.rsplit('.', 1)[-1]}, not a {cls.__name__}")
    thing = cls.load(path)
    if isinstance(thing, Pipeline):
        _check_stages(thing.getStages(), path)
    elif isinstance(thing, PipelineModel):
        _check_stages(thing.stages, path)
    elif isinstance(thing, CrossValidatorModel) and not thing.avgMetrics:
        raise ValueError(f"the search in {path} carries no metrics")
    elif isinstance(thing, TrainValidationSplitModel) and not thing.validationMetrics:
        raise ValueError(f"the search in {path} carries no metrics")
    return thing


def _check_stages(stages, path: str) -> None:
    if any(stage is None or not stage.uid for stage in stages):
        raise ValueError(f"a stage saved in {path} has no uid")


def _saved_class(path: str) -> str | None:
    """The class named in the saved metadata, a one-line JSON file."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    row = (
        SparkSession.getActiveSession().read.text(f"{path.rstrip('/')}/metadata")
        .select(F.get_json_object("value", "$.class").alias("c"))
        .first()
    )
    return row["c"] if row else None
