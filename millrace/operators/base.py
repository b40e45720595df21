"""Uniform constructors for the Spark ML operators.

``constructor(cls)`` answers a function taking keyword params in snake_case (or in
Spark's own camelCase) and returning a configured ``pyspark.ml`` object. The params
come from the class itself, so a wrong name is refused up front together with the list
of names that would have worked, and only params that were given are set.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.ml import Estimator, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params


def snake(name: str) -> str:
    """``maxBlockSizeInMB`` -> ``max_block_size_in_mb``; snake_case passes through."""
    out = ""
    for before, letter, after in zip(" " + name, name, name[1:] + " "):
        # a capital begins a word, unless it stands inside or at the end of a run of capitals
        starts = letter.isupper() and before not in " _" and not (before.isupper() and not after.islower())
        out += "_" * starts + letter.lower()
    return out


def param_names(cls: type[Params]) -> dict[str, str]:
    """snake_case name -> Spark name for every param the class declares."""
    declared = (getattr(cls, n, None) for n in dir(cls))
    return {snake(p.name): p.name for p in declared if isinstance(p, Param)}


def kind_of(cls: type[Params]) -> str:
    if issubclass(cls, Evaluator):
        return "evaluator"
    if issubclass(cls, Estimator):
        return "estimator"
    if issubclass(cls, Transformer):
        return "transformer"
    return "helper"


def configure(op: Params, **params: Any) -> Params:
    """Set params on an operator in place; a param set before is replaced."""
    known = param_names(type(op))
    settings = {}
    for name, value in params.items():
        key = snake(name)
        if key not in known:
            raise TypeError(
                f"{type(op).__name__} has no param {name!r}; known: {', '.join(sorted(known))}"
            )
        settings[known[key]] = value
    return op._set(**settings)


def constructor(cls: type[Params]) -> Callable[..., Any]:
    def build(**params: Any) -> Any:
        return configure(cls(), **params)

    build.__name__ = build.__qualname__ = snake(cls.__name__)
    build.__doc__ = f"{cls.__name__}({', '.join(sorted(param_names(cls)))})"
    build.operator = cls
    build.kind = kind_of(cls)
    return build
