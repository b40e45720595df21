"""Running totals over a globally ordered table, without a one-partition window.

``SUM(x) OVER (ORDER BY k)`` puts every row into one task. Here the rows are range
partitioned, every partition is totalled, the totals of the partitions before are added
as an offset (one row per partition, so small), and the window runs inside partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root


def running_totals(
    df: DataFrame, order: Sequence[Column], totals: dict[str, str | Column]
) -> DataFrame:
    """``df`` plus one column per entry of ``totals``: the sum up to and with the row.

    ``order`` must identify rows uniquely (aggregate equal keys first): unique keys are
    what lets the range partitioner balance them, however skewed the raw rows were.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    rows = df.select("*", *[_column(v).alias(f"_add_{n}") for n, v in totals.items()]).checkpoint()
    parts = (
        rows.repartitionByRange(*order)
        .withColumn("_part", F.spark_partition_id())
        # the partition number must not change when a lost task is run again
        .checkpoint()
    )
    sums = parts.groupBy("_part").agg(*[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in totals])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_part",
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in totals],
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = parts.join(F.broadcast(offsets), "_part")  # one row per range partition
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_{n}") + F.sum(f"_add_{n}").over(inside)).alias(n) for n in totals],
    )


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """(probability, value): the smallest value up to which that share of the rows lies, nulls and NaN apart.

    No rank error, and no task or driver that holds the column: what is ordered are its distinct values
    with counts, in as many parts as the range partitioner makes.
    """
    known = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    counted = known.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("_n"))
    upto = running_totals(counted, [F.col("value")], {"_upto": "_n"}).checkpoint()
    total = F.broadcast(upto.agg(F.max("_upto").alias("_total")))  # one row
    wanted = [F.min(F.when(F.col("_upto") >= F.ceil(F.lit(float(p)) * F.col("_total")), F.col("value"))).alias(f"q{i}")
              for i, p in enumerate(probabilities)]
    found = upto.crossJoin(total).agg(*wanted)
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), F.col(f"q{i}").alias("value")) for i, p in enumerate(probabilities)])))


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(idx, value, rank): the mean rank of each distinct value of each column, equal
    values sharing theirs. One pass over the rows; what is ordered is their distinct
    values with counts, so a value that fills a third of the rows is one row of it."""
    cells = F.array(*[F.struct(F.lit(i).alias("idx"), F.col(c).alias("value")) for i, c in enumerate(columns)])
    counted = df.select(F.inline(cells)).groupBy("idx", "value").agg(F.count("*").alias("_n"))
    upto = running_totals(counted, [F.col("idx"), F.col("value")], {"_upto": "_n"})
    # the totals run on from column to column; each begins where the one before ended
    starts = upto.groupBy("idx").agg(F.min(F.col("_upto") - F.col("_n")).alias("_start"))
    rank = F.col("_upto") - F.col("_start") - (F.col("_n") - 1) / 2.0
    return upto.join(F.broadcast(starts), "idx").select("idx", "value", rank.alias("rank"))  # a row per column


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
