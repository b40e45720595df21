"""Vectors as columns: assembling, opening, and the weighted vector aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The metrics of the vector summary, as Spark names them.
METRICS = (
    "mean", "sum", "variance", "std", "count", "numNonZeros", "max", "min", "normL2", "normL1",
)


def assemble(
    df: DataFrame,
    inputs: Sequence[str],
    output: str = "features",
    keep: Sequence[str] | None = None,
    invalid: str = "error",
) -> DataFrame:
    """One vector column from numeric columns; only ``keep`` (default all) stays beside it.

    Numbers are cast to double first: several operators refuse a DECIMAL.
    """
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(df.dtypes)
    for name in inputs:
        if types[name].startswith("decimal") or types[name] in numeric - {"double"}:
            df = df.withColumn(name, F.col(name).cast("double"))
    out = VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=invalid).transform(df)
    return out if keep is None else out.select(*keep, output)


def sparse_entries(vector: str | Column) -> Column:
    """The stored entries of a vector as ``array<struct<idx:int,value:double>>``.

    Reads the fields of the stored form, so a sparse vector with 2^18 slots costs its
    non-zeros and is never made dense.
    """
    raw = F.unwrap_udt(F.col(vector) if isinstance(vector, str) else vector)
    indices = F.coalesce(
        raw["indices"], F.sequence(F.lit(0), F.size(raw["values"]) - 1)
    )
    # the dense branch of an empty vector would otherwise count down from 0 to -1
    indices = F.when(F.size(raw["values"]) == 0, F.array().cast("array<int>")).otherwise(indices)
    return F.zip_with(
        indices, raw["values"], lambda i, v: F.struct(i.alias("idx"), v.alias("value"))
    )


def explode_vector(df: DataFrame, vector: str, keys: Sequence[str]) -> DataFrame:
    """(keys..., idx, value), one row per stored entry; narrow, no shuffle."""
    return df.select(*keys, F.inline(sparse_entries(vector)))


def components(vector: str, names: Sequence[str], start: int = 0) -> list[Column]:
    """The first components of a dense vector as plain double columns."""
    opened = vector_to_array(F.col(vector))
    return [opened[start + i].alias(n) for i, n in enumerate(names)]


def summary(features: str, metrics: Sequence[str] = METRICS, weight: str | None = None) -> Column:
    """One struct with a field per metric, for ``agg`` with or without ``groupBy``."""
    names = [spark_metric(m) for m in metrics]
    builder = Summarizer.metrics(*names)
    return builder.summary(F.col(features), F.lit(1.0) if weight is None else F.col(weight))


def spark_metric(name: str) -> str:
    """snake_case or Spark spelling of a metric -> Spark spelling; unknown names raise."""
    folded = {m.lower(): m for m in METRICS}
    try:
        return folded[name.replace("_", "").lower()]
    except KeyError:
        raise ValueError(f"unknown metric {name!r}; known: {', '.join(METRICS)}") from None


def _shortcut(metric: str):
    def aggregate(features: str, weight: str | None = None) -> Column:
        return summary(features, [metric], weight)[metric]

    aggregate.__name__ = metric
    aggregate.__doc__ = f"The {metric} of every component of a vector column, weighted on request."
    return aggregate


mean, total, variance, std = (_shortcut(m) for m in ("mean", "sum", "variance", "std"))
count, num_nonzeros = _shortcut("count"), _shortcut("numNonZeros")
maximum, minimum = _shortcut("max"), _shortcut("min")
norm_l2, norm_l1 = _shortcut("normL2"), _shortcut("normL1")

SHORTCUTS = {
    "mean": mean, "sum": total, "variance": variance, "std": std, "count": count,
    "num_nonzeros": num_nonzeros, "max": maximum, "min": minimum,
    "norm_l2": norm_l2, "norm_l1": norm_l1,
}

__all__ = [
    "METRICS", "SHORTCUTS", "array_to_vector", "assemble", "components", "count",
    "explode_vector", "maximum", "mean", "minimum", "norm_l1", "norm_l2", "num_nonzeros",
    "spark_metric", "sparse_entries", "std", "summary", "total", "variance", "vector_to_array",
]
