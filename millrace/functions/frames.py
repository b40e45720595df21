"""Small results of the driver as frames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_TYPES = {
    "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "map<string,string>": pa.map_(pa.string(), pa.string()),
}


def small_frame(spark: SparkSession, rows: Iterable[Sequence[Any]], schema: str) -> DataFrame:
    """Rows as a frame kept in the plan itself: no task is started to make it.

    ``schema`` is ``"name type, name type"``. Spark cuts a list of rows into as many
    partitions as the cluster has cores, which for a table of a few rows is all overhead.
    """
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(list(c), _TYPES[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return spark.createDataFrame(pa.table(arrays, names=[name.strip("`") for name, _ in fields]))
