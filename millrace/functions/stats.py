"""Statistical tests and correlation, answered as plain tables."""

from __future__ import annotations

from pyspark.ml.stat import ChiSquareTest, Correlation, KolmogorovSmirnovTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import average_ranks
from .tables import matrix_frame
from .vectors import assemble, vector_to_array


def chi_square_test(df: DataFrame, features: str, label: str, flatten: bool = False) -> DataFrame:
    """Pearson independence of each (categorical) feature and the label.

    ``flatten`` gives a row per feature; otherwise one row of arrays.
    """
    tested = ChiSquareTest.test(df, features, label, flatten)
    if flatten:
        return tested
    return tested.select(
        vector_to_array("pValues").alias("pValues"),
        "degreesOfFreedom",
        vector_to_array("statistics").alias("statistics"),
    )


def correlation(df: DataFrame, features: str, method: str = "pearson") -> DataFrame:
    """(i, j, value) of the correlation matrix of a vector column."""
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unknown correlation {method!r}; known: pearson, spearman")
    (matrix,) = Correlation.corr(df.select(features), features, method).first()
    return matrix_frame(df.sparkSession, matrix)


def rank_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Spearman over plain columns as (i, j, value), made for heavily tied data.

    Ranks come from the distinct values with their counts, so a value held by a third of
    the rows is one row of the ranking; the table itself is never sorted. A null is
    refused, as it is in a vector.
    """
    refused = F.raise_error(F.lit("rank correlation of a null value")).cast("double")
    ranked = df.select(*[F.coalesce(F.col(c).cast("double"), refused).alias(c) for c in columns])
    ranks = average_ranks(ranked, columns).checkpoint()
    for i, c in enumerate(columns):
        own = ranks.filter(F.col("idx") == i).select(F.col("value").alias(c), F.col("rank").alias(f"_rank_{c}"))
        ranked = ranked.join(own, c)
    vectors = assemble(ranked, [f"_rank_{c}" for c in columns], keep=[])
    return correlation(vectors, "features")


def kolmogorov_smirnov_test(
    df: DataFrame, column: str, distribution: str = "norm", *params: float
) -> DataFrame:
    """One sample, two sided, against a normal distribution (mean and sd as params)."""
    if distribution != "norm":
        raise ValueError(f"unknown distribution {distribution!r}; known: norm")
    return KolmogorovSmirnovTest.test(df, column, distribution, *params)
