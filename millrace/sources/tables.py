"""Reading training and scoring frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One parquet table; naming the columns keeps the scan to them."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df if columns is None else df.select(*columns)


#: A fixed number, so that what is learned from the parts does not change with the cluster's size.
PARTS = 8


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A frame that comes in fewer than ``PARTS`` partitions, cut into so many by ``keys``.

    For work that is heavy per row or repeated (tokenizing, training). A table of many
    files has partitions enough and passes as it is, without a shuffle.
    """
    return df if df.rdd.getNumPartitions() >= PARTS else df.repartition(PARTS, *keys)


def numbers_from_text(text: str | Column, separator: str = ",") -> Column:
    """A vector carried as text ("0.1,0.2") as ``array<double>``."""
    column = F.col(text) if isinstance(text, str) else text
    return F.split(column, separator).cast("array<double>")
