import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import stats
from millrace.functions.vectors import (
    METRICS, SHORTCUTS, array_to_vector, assemble, explode_vector, spark_metric, sparse_entries, summary,
    vector_to_array,
)
from millrace.plans.ordered import average_ranks, running_totals


def test_running_totals_cross_partitions(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")).repartition(9)
    expected = dict(zip(range(999, -1, -1), itertools.accumulate(k % 7 for k in range(999, -1, -1))))
    out = running_totals(df, [F.col("k").desc()], {"upto": "v"})
    assert {r.k: r.upto for r in out.collect()} == expected


def test_average_ranks_share_ties(spark):
    df = spark.createDataFrame([(x, -x) for x in [5.0] * 300 + [1.0, 2.0, 2.0, 9.0]], "x double, y double")
    ranks = {(r.idx, r.value): r["rank"] for r in average_ranks(df, ["x", "y"]).collect()}
    assert ranks == {
        (0, 1.0): 1.0, (0, 2.0): 2.5, (0, 5.0): 153.5, (0, 9.0): 304.0,
        (1, -9.0): 1.0, (1, -5.0): 151.5, (1, -2.0): 302.5, (1, -1.0): 304.0}


def test_rank_correlation_equals_the_sorting_one(spark):
    draw = np.random.default_rng(1)
    rows = [(float(a), float(a + b), float(c)) for a, b, c in draw.integers(0, 6, size=(400, 3))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    mine = {(r.i, r.j): r.value for r in stats.rank_correlation(df, ["a", "b", "c"]).collect()}
    theirs = stats.correlation(assemble(df, ["a", "b", "c"]), "features", "spearman")
    assert mine == pytest.approx({(r.i, r.j): r.value for r in theirs.collect()})


def test_unknown_choices_are_refused(spark, vectors):
    with pytest.raises(ValueError, match="pearson, spearman"):
        stats.correlation(vectors, "features", "kendall")
    with pytest.raises(ValueError, match="norm"):
        stats.kolmogorov_smirnov_test(vectors, "x1", "uniform")
    with pytest.raises(ValueError, match="normL1"):
        spark_metric("median")


def test_chi_square_forms(spark, points):
    df = assemble(points, ["idx", "censor"])
    flat = stats.chi_square_test(df, "features", "label", flatten=True).orderBy("featureIndex").collect()
    (wide,) = stats.chi_square_test(df, "features", "label").collect()
    assert [r.statistic for r in flat] == pytest.approx(wide.statistics)
    assert [r.degreesOfFreedom for r in flat] == list(wide.degreesOfFreedom) == [1, 1]


def test_normal_sample_is_not_refused(spark):
    df = spark.range(2000).select(F.randn(7).alias("x"))
    row = stats.kolmogorov_smirnov_test(df, "x", "norm", 0.0, 1.0).first()
    assert row.pValue > 0.01 and 0 < row.statistic < 0.05


def test_either_metric_spelling(spark):
    assert spark_metric("num_nonzeros") == spark_metric("numNonZeros") == "numNonZeros"
    assert set(map(spark_metric, SHORTCUTS)) == set(METRICS)


def test_weighted_summary_by_group(spark, vectors):
    out = vectors.groupBy("category").agg(summary("features", ["mean", "count"], "weight").alias("s"))
    rows = {r.category: r.s for r in out.collect()}
    pdf = vectors.select("category", "x1", "weight").toPandas()
    for name, part in pdf.groupby("category"):
        assert rows[name]["mean"][0] == pytest.approx(np.average(part.x1, weights=part.weight))
        assert rows[name]["count"] == len(part)


def test_shortcuts_agree_with_the_summary(spark, vectors):
    whole = vectors.agg(summary("features").alias("s")).first().s
    for name, aggregate in SHORTCUTS.items():
        value = vectors.agg(aggregate("features").alias("v")).first().v
        assert value == whole[spark_metric(name)]


def test_sparse_vectors_stay_sparse(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(0, Vectors.sparse(262144, [3, 70000], [1.0, 2.0])), (1, Vectors.dense([4.0, 0.0])),
         (2, Vectors.sparse(5, [], [])), (3, Vectors.dense([]))], ["id", "v"])
    got = {(r.id, r.idx): r.value for r in explode_vector(df, "v", ["id"]).collect()}
    assert got == {(0, 3): 1.0, (0, 70000): 2.0, (1, 0): 4.0, (1, 1): 0.0}
    assert [r.n for r in df.select(F.size(sparse_entries("v")).alias("n")).collect()] == [2, 2, 0, 0]


def test_array_functions(spark):
    df = spark.createDataFrame([([0.1, 2.0],)], "a array<double>")
    vector = df.select(array_to_vector("a").alias("v"))
    assert vector.select(vector_to_array("v").alias("a")).first().a == [0.1, 2.0]
    narrow = vector.select(vector_to_array("v", "float32").alias("a"))
    assert narrow.dtypes == [("a", "array<float>")] and narrow.first().a[0] == pytest.approx(0.1, abs=1e-7)
    with pytest.raises(Exception):
        vector.select(vector_to_array("v", "int8")).collect()


def test_rank_correlation_refuses_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (2.0, 1.0)], "a double, b double")
    with pytest.raises(Exception, match="null value"):
        stats.rank_correlation(df, ["a", "b"]).collect()
