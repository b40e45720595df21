"""The one-pass reports answer what the evaluators answer."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.vectors import array_to_vector
from millrace.operators import evaluation
from millrace.plans import reports


def _values(df):
    return {(r.metric, r.label): r.value for r in df.collect()}


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(7)
    rows = [
        (float(draw.choice([0, 0, 0, 1, 2])), float(draw.choice([0, 1, 1, 3])), float(draw.randint(1, 4)),
         [0.2, 0.5, 0.3])
        for _ in range(200)
    ]
    return spark.createDataFrame(rows, "label double, prediction double, w double, p array<double>").withColumn(
        "probability", array_to_vector("p")).persist()


@pytest.mark.parametrize("weight", [None, "w"])
def test_multiclass(scored, weight):
    got = _values(reports.multiclass(scored, weight=weight, beta=0.5))
    rules = {"weight_col": weight} if weight else {}
    for (metric, label), value in got.items():
        op = evaluation.multiclass_classification_evaluator(
            metric_name=metric, beta=0.5, metric_label=label or 0.0, **rules)
        assert op.evaluate(scored) == pytest.approx(value, abs=1e-12), (metric, label)
    assert len(got) == 8 + 5 * 3  # a class that is only ever predicted has no label metrics


@pytest.mark.parametrize("weight", [None, "w"])
def test_log_loss(scored, weight):
    rules = {"weight_col": weight} if weight else {}
    op = evaluation.multiclass_classification_evaluator(metric_name="logLoss", **rules)
    assert _values(reports.log_loss(scored, "p", weight=weight))[("logLoss", None)] == pytest.approx(op.evaluate(scored))


@pytest.mark.parametrize("weight", [None, "w"])
@pytest.mark.parametrize("origin", [False, True])
def test_regression(scored, weight, origin):
    rules = {"weight_col": weight} if weight else {}
    for (metric, _), value in _values(reports.regression(scored, weight=weight, through_origin=origin)).items():
        op = evaluation.regression_evaluator(metric_name=metric, through_origin=origin, **rules)
        assert op.evaluate(scored) == pytest.approx(value, rel=1e-9), metric


def test_multilabel(spark):
    draw = random.Random(3)
    pick = lambda: sorted(float(x) for x in draw.sample(range(5), draw.randint(1, 4)))
    df = spark.createDataFrame([(pick(), pick()) for _ in range(60)], "prediction array<double>, label array<double>")
    got = _values(reports.multilabel(df))
    assert {m for m, _ in got} == {
        "subsetAccuracy", "accuracy", "hammingLoss", "precision", "recall", "f1Measure", "microPrecision",
        "microRecall", "microF1Measure", "precisionByLabel", "recallByLabel", "f1MeasureByLabel"}
    for (metric, label), value in got.items():
        op = evaluation.multilabel_classification_evaluator(metric_name=metric, metric_label=label or 0.0)
        assert op.evaluate(df) == pytest.approx(value, abs=1e-12), (metric, label)


def test_ranking(spark):
    draw = random.Random(5)
    rows = [
        ([float(x) for x in draw.sample(range(8), draw.randint(1, 8))],
         [float(x) for x in draw.sample(range(8), draw.randint(1, 5))]) for _ in range(40)
    ]
    df = spark.createDataFrame(rows, "prediction array<double>, label array<double>")
    for (metric, k), value in _values(reports.ranking(df, ks=[1, 3, 10])).items():
        op = evaluation.ranking_evaluator(metric_name=metric, k=int(k or 10))
        assert op.evaluate(df) == pytest.approx(value, abs=1e-12), (metric, k)


def test_a_report_is_one_aggregate(spark):
    df = spark.range(9).selectExpr("double(id) AS label", "id * 2.0D AS prediction")
    plan = reports.regression(df)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange SinglePartition") == 1 and "UDF" not in text


def test_exact_area_has_half_ties(spark):
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5), (1.0, 0.9), (0.0, 0.1)], "label double, s double")
    op = evaluation.binary_classification_evaluator(raw_prediction_col="s", num_bins=0)
    assert op.evaluate(df) == pytest.approx((1 + 1 + 1 + 0.5) / 4)


def test_silhouette_of_clear_groups(spark):
    df = spark.createDataFrame([(0.0, 0), (0.1, 0), (9.0, 1), (9.1, 1)], "x double, prediction int").withColumn(
        "features", array_to_vector(F.array("x")))
    assert evaluation.clustering_evaluator().evaluate(df) > 0.99
