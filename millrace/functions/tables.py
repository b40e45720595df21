"""Learned state as tables.

``attribute(model, name)`` reads anything a fitted model or a summary knows and answers
a DataFrame of plain types: a vector is (idx, value), a matrix (i, j, value), a scalar a
one-row frame. State that grows with rows or entities is a frame in Spark already and
stays one; the rest is bounded by features x classes and is shipped from the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

import numpy as np
from pyspark.ml import Model
from pyspark.ml.linalg import Matrix, SparseVector, Vector
from pyspark.ml import Model
from pyspark.ml.linalg import MatrixUDT, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.base import snake
from .frames import small_frame

VECTOR = "idx int, value double"
MATRIX = "i int, j int, value double"


def vector_frame(spark: SparkSession, values: Iterable[float]) -> DataFrame:
    return small_frame(spark, [(i, float(v)) for i, v in enumerate(values)], VECTOR)


def matrix_frame(spark: SparkSession, matrix: Matrix | Iterable[Iterable[float]]) -> DataFrame:
    rows = matrix.toArray() if isinstance(matrix, Matrix) else matrix
    cells = [(i, j, float(v)) for i, row in enumerate(rows) for j, v in enumerate(row)]
    return small_frame(spark, cells, MATRIX)


def plain(df: DataFrame) -> DataFrame:
    """The frame with vector and matrix columns opened into arrays, nested ones too."""
    return df.select(*[_opened(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def _opened(column, kind):
    if _is(kind, VectorUDT):
        raw = F.unwrap_udt(column)
        dense = raw["values"]
        sparse = F.transform(
            F.sequence(F.lit(0), raw["size"] - 1),
            lambda i: F.coalesce(
                F.try_element_at(raw["values"], F.nullif(F.array_position(raw["indices"], i), F.lit(0)).cast("int")),
                F.lit(0.0),
            ),
        )
        return F.when(raw["type"] == 1, dense).otherwise(sparse)
    if _is(kind, MatrixUDT):
        return F.unwrap_udt(column)["values"]
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.UserDefinedType, T.StructType)):
        return F.transform(column, lambda x: _opened(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.struct(*[_opened(column[f.name], f.dataType).alias(f.name) for f in kind])
    return column


def _is(kind: T.DataType, udt: type) -> bool:
    # a mixture's components still come as the older types of the same name
    return isinstance(kind, T.UserDefinedType) and type(kind).__name__ == udt.__name__


def attribute(model: Any, name: str, *args: Any) -> DataFrame:
    """One piece of learned state as a DataFrame; ``name`` in snake_case or as Spark says."""
    spark = SparkSession.getActiveSession()
    special = _SPECIAL.get(snake(name))
    value = special(model, *args) if special and not _has(model, name) else _read(model, name, args)
    return as_frame(spark, value, snake(name))


def as_frame(spark: SparkSession, value: Any, name: str = "value") -> DataFrame:
    if isinstance(value, DataFrame):
        return plain(value)
    if isinstance(value, Matrix):
        return matrix_frame(spark, value)
    if isinstance(value, (Vector, np.ndarray)) and np.ndim(np.asarray(_dense(value))) == 1:
        return vector_frame(spark, _dense(value))
    if isinstance(value, np.ndarray):
        return matrix_frame(spark, value)
    if isinstance(value, dict):
        rows = [(int(f), float(k), int(i)) for f, m in value.items() for k, i in m.items()]
        return small_frame(spark, rows, "feature int, category double, idx int")
    if isinstance(value, (list, tuple)):
        return _list_frame(spark, list(value))
    if isinstance(value, bool):
        return small_frame(spark, [(value,)], f"`{name}` boolean")
    if isinstance(value, int):
        return small_frame(spark, [(value,)], f"`{name}` bigint")
    if isinstance(value, float):
        return small_frame(spark, [(value,)], f"`{name}` double")
    if isinstance(value, str):
        return small_frame(spark, [(value,)], f"`{name}` string")
    if isinstance(value, Model) and _has(value, "topics_matrix"):  # a topic model is its terms by topics
        return matrix_frame(spark, value.topicsMatrix())
    raise TypeError(f"{name} is a {type(value).__name__}, which has no table form")


def learned_model(model: Any, name: str) -> Any:
    """A model that another one knows, such as the local form of a distributed topic model.

    Its state is read by ``attribute`` like any other's; ``attribute(model, name)`` itself answers
    its main table.
    """
    value = _read(model, name, ())
    if not isinstance(value, Model):
        raise TypeError(f"{name} of {type(model).__name__} is no model")
    return value


def _list_frame(spark: SparkSession, values: list) -> DataFrame:
    if not values:
        return small_frame(spark, [], VECTOR)
    head = values[0]
    if isinstance(head, (list, tuple)) and head and isinstance(head[0], str):
        cells = [(i, j, v) for i, row in enumerate(values) for j, v in enumerate(row)]
        return small_frame(spark, cells, "i int, j int, value string")
    if isinstance(head, (list, tuple, np.ndarray, Vector)):
        return matrix_frame(spark, [_dense(v) for v in values])
    kind = "string" if isinstance(head, str) else "double"
    cast = str if kind == "string" else float
    return small_frame(spark, [(i, cast(v)) for i, v in enumerate(values)], f"idx int, value {kind}")


def _dense(value):
    return value.toArray() if isinstance(value, (Vector, SparseVector)) else value


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(r.capitalize() for r in rest)


def _resolve(model: Any, name: str) -> str | None:
    """The member of ``model`` that ``name`` means, whatever its capitals."""
    folded = snake(name).replace("_", "")
    for member in dir(type(model)):
        if member.replace("_", "").lower() == folded and not member.startswith("_"):
            return member
    for member in dir(type(model)):
        if member.lower() == "get" + folded:
            return member
    return None


def _has(model: Any, name: str) -> bool:
    return _resolve(model, name) is not None


def _read(model: Any, name: str, args: tuple) -> Any:
    member = _resolve(model, name)
    if member is None:
        known = sorted(snake(m) for m in dir(type(model)) if not m.startswith("_"))
        raise AttributeError(f"{type(model).__name__} has no {name!r}; known: {', '.join(known)}")
    value = getattr(model, member)
    return value(*args) if callable(value) else value


def _cluster_center_matrix(model):
    return [list(c) for c in model.clusterCenters()]


def _category_maps(model):
    return model.categoryMaps


def _resolved_formula(model):
    return str(model)


def _coefficients_with_statistics(model):
    """(feature, coefficient, std_error, t_value, p_value), the intercept last."""
    summary = model.summary
    estimates = list(model.coefficients) + ([model.intercept] if model.getFitIntercept() else [])
    names = [str(i) for i in range(len(model.coefficients))] + ["(intercept)"]
    rows = [
        (n, float(c), float(s), float(t), float(p))
        for n, c, s, t, p in zip(
            names, estimates, summary.coefficientStandardErrors, summary.tValues, summary.pValues
        )
    ]
    spark = SparkSession.getActiveSession()
    return small_frame(
        spark, rows, "feature string, coefficient double, std_error double, t_value double, p_value double"
    )


def _trees(model):
    """One row per member tree of an ensemble."""
    rows = [
        (i, float(w), t.depth, t.numNodes)
        for i, (t, w) in enumerate(zip(model.trees, model.treeWeights))
    ]
    return small_frame(
        SparkSession.getActiveSession(), rows, "tree int, weight double, depth int, num_nodes int"
    )


_SPECIAL = {
    "cluster_center_matrix": _cluster_center_matrix,
    "category_maps_df": _category_maps,
    "resolved_formula_string": _resolved_formula,
    "coefficients_with_statistics": _coefficients_with_statistics,
}


def trees(model: Any) -> DataFrame:
    """(tree, weight, depth, num_nodes), one row per member tree of an ensemble."""
    return _trees(model)
