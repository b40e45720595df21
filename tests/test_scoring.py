"""Every expression form gives what the model's own transform gives."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.functions.vectors import assemble, vector_to_array
from millrace.operators import classification, clustering, feature, regression
from millrace.plans import scoring
from millrace.plans.scoring import columns, score

INPUTS = ["l_quantity", "l_price", "l_discount"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    return df.select(
        F.monotonically_increasing_id().alias("id"), "l_quantity", (F.col("l_extendedprice") / 1000).alias("l_price"),
        "l_discount", (F.col("l_quantity") > 25).cast("double").alias("half"),
        F.floor(F.col("l_quantity") / 17.0).cast("double").alias("third"),
    ).persist()


@pytest.fixture(scope="module")
def features(rows):
    return assemble(rows, INPUTS).persist()


def _compare(model, rows, features, out, scalar=False):
    column = F.array(F.col(out)) if scalar else vector_to_array(out)
    theirs = {r.id: r.v for r in model.transform(features).select("id", column.alias("v")).collect()}
    mine = score(model, rows, INPUTS, ["id"])
    names = [out] if scalar else [n for n in mine.columns if n.startswith(f"{out}_")]
    ours = {r["id"]: [r[n] for n in names] for r in mine.collect()}
    assert len(ours) == len(theirs) > 1000
    for key in ours:
        np.testing.assert_allclose(ours[key], theirs[key], rtol=1e-10, atol=1e-10)


@pytest.mark.parametrize("make", [
    lambda: feature.standard_scaler(input_col="features", output_col="o", with_mean=True),
    lambda: feature.standard_scaler(input_col="features", output_col="o", with_std=False, with_mean=True),
    lambda: feature.min_max_scaler(input_col="features", output_col="o", min=-1.0, max=3.0),
    lambda: feature.max_abs_scaler(input_col="features", output_col="o"),
    lambda: feature.robust_scaler(input_col="features", output_col="o", with_centering=True),
    lambda: feature.robust_scaler(input_col="features", output_col="o", lower=0.1, upper=0.9),
    lambda: feature.pca(input_col="features", output_col="o", k=2),
    lambda: feature.variance_threshold_selector(output_col="o", variance_threshold=1.0),
])
def test_fitted_vector_outputs(rows, features, make):
    _compare(make().fit(features), rows, features, "o")


@pytest.mark.parametrize("make", [
    lambda: feature.normalizer(input_col="features", output_col="o"),
    lambda: feature.normalizer(input_col="features", output_col="o", p=1.0),
    lambda: feature.normalizer(input_col="features", output_col="o", p=3.0),
    lambda: feature.normalizer(input_col="features", output_col="o", p=math.inf),
    lambda: feature.elementwise_product(input_col="features", output_col="o", scaling_vec=Vectors.dense(1.0, 0.0, -2.0)),
    lambda: feature.vector_slicer(input_col="features", output_col="o", indices=[2, 0]),
])
def test_unfitted_vector_outputs(spark, rows, features, make):
    _compare(make(), rows, features, "o")


@pytest.mark.parametrize("make", [
    lambda: regression.linear_regression(label_col="l_price"),
    lambda: regression.linear_regression(label_col="l_price", fit_intercept=False),
    lambda: regression.generalized_linear_regression(label_col="l_price", family="poisson"),
    lambda: regression.generalized_linear_regression(label_col="l_price", family="gamma", link="log"),
    lambda: regression.generalized_linear_regression(label_col="half", family="binomial", link="cloglog", reg_param=0.1),
    lambda: regression.aft_survival_regression(label_col="l_price", censor_col="half", max_iter=5),
    lambda: classification.linear_svc(label_col="half", max_iter=5),
    lambda: classification.logistic_regression(label_col="half", max_iter=5, threshold=0.3),
    lambda: classification.logistic_regression(label_col="third", max_iter=5),
    lambda: classification.logistic_regression(label_col="third", max_iter=5, thresholds=[0.2, 0.5, 0.4]),
    lambda: classification.naive_bayes(label_col="third"),
    lambda: clustering.k_means(k=4, seed=1),
])
def test_predictions(rows, features, make):
    _compare(make().fit(features), rows, features, "prediction", scalar=True)


def test_probabilities(rows, features):
    for label in ("half", "third"):
        model = classification.logistic_regression(label_col=label, max_iter=5).fit(features)
        _compare(model, rows, features, "probability")
        _compare(model, rows, features, "rawPrediction")


def test_constant_dimension_is_put_in_the_middle(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    model = feature.min_max_scaler(input_col="features", output_col="o").fit(assemble(df, ["a", "b"]))
    assert [r.o_1 for r in score(model, df, ["a", "b"]).collect()] == [0.5, 0.5]


def test_zero_vector_is_left_alone(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "a double, b double")
    out = score(feature.normalizer(input_col="f", output_col="o"), df, ["a", "b"]).first()
    assert tuple(out) == (0.0, 0.0)


def test_bucket_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.5,), (1.4,), (4.0,)], "x double")
    op = feature.bucketizer(input_col="x", output_col="b", splits=[0.0, 1.5, 4.0])
    assert [r.b for r in score(op, df, ["x"], ["x"]).collect()] == [r.b for r in op.transform(df).collect()]


@pytest.mark.parametrize("bad", [9.0, float("nan"), None])
def test_bucket_outside_the_splits_fails(spark, bad):
    df = spark.createDataFrame([(bad,)], "x double")
    op = feature.bucketizer(input_col="x", output_col="b", splits=[0.0, 1.5, 4.0])
    with pytest.raises(Exception, match="outside"):
        score(op, df, ["x"]).collect()


def test_imputer_forms(spark):
    df = spark.createDataFrame([(1.0, 7.0), (None, -1.0), (3.0, 7.0), (float("nan"), 5.0)], "a double, b double")
    nan = feature.imputer(input_col="a", output_col="o").fit(df)
    assert [r.o for r in score(nan, df, ["a"]).collect()] == [1.0, 2.0, 3.0, 2.0]
    minus = feature.imputer(input_cols=["b"], output_cols=["o"], missing_value=-1.0, strategy="mode").fit(df)
    assert [r.o for r in score(minus, df, ["b"]).collect()] == [7.0, 7.0, 7.0, 5.0]


def test_no_column_form_is_said(vectors):
    with pytest.raises(TypeError, match="use transform"):
        columns(classification.decision_tree_classifier().fit(vectors), ["x1", "x2"])


def test_scored_plan_keeps_the_scan_narrow_and_generated(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    model = regression.linear_regression(label_col="l_tax").fit(assemble(df, ["l_quantity", "l_discount"]))
    out = score(model, df.filter("l_quantity > 10"), ["l_quantity", "l_discount"])
    plan = out._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double>" in plan
    assert "GreaterThan(l_quantity,10.0)" in plan
    assert "UDF" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("make", [
    lambda: classification.linear_svc(label_col="half", max_iter=5),
    lambda: classification.logistic_regression(label_col="half", max_iter=5),
    lambda: classification.logistic_regression(label_col="third", max_iter=5),
    lambda: classification.logistic_regression(label_col="third", max_iter=5, thresholds=[0.2, 0.5, 0.4]),
])
def test_nan_as_transform_and_null_stays_null(spark, features, make):
    model = make().fit(features)
    nan = float("nan")
    odd = spark.createDataFrame([(nan, 1.0, 2.0), (1.0, nan, 2.0), (3.0, 4.0, nan)], ", ".join(f"{c} double" for c in INPUTS))
    theirs = [r.prediction for r in model.transform(odd.select(vector_of(INPUTS).alias("features"))).collect()]
    assert [r.prediction for r in score(model, odd, INPUTS).collect()] == theirs
    null = spark.createDataFrame([(None, 1.0, 2.0)], odd.schema)
    assert score(model, null, INPUTS).first().prediction is None


def test_no_cluster_for_nan_and_null(spark, features):
    model = clustering.k_means(k=4, seed=1).fit(features)
    odd = spark.createDataFrame([(float("nan"), 1.0, 2.0), (None, 1.0, 2.0)], ", ".join(f"{c} double" for c in INPUTS))
    assert [r.prediction for r in score(model, odd, INPUTS).collect()] == [None, None]


def vector_of(names):
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(F.array(*names))


def test_binarizer_with_nan_and_null(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (None,)], "x double")
    op = feature.binarizer(input_col="x", output_col="b", threshold=1.0)
    assert [r.b for r in score(op, df, ["x"]).collect()] == [r.b for r in op.transform(df).collect()] == [0.0, 1.0, 0.0]


@pytest.mark.parametrize("classes,width", [(3, 3), (10, 16), (10, 64)])
def test_both_forms_agree_at_many_classes(spark, classes, width):
    draw = np.random.default_rng(classes)
    names = [f"x{i}" for i in range(width)]
    rows = [(float(k % classes), *draw.normal(size=width).tolist()) for k in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in ["label", *names])).persist()
    model = classification.logistic_regression(max_iter=3).fit(assemble(df, names, keep=["label"]))
    wide = score(model, df, names, ["x0"]).orderBy("x0").collect()
    theirs = score(model, df, names, ["x0"], form="vector").orderBy("x0").collect()
    assert [r.prediction for r in wide] == [r.prediction for r in theirs]
    np.testing.assert_allclose([tuple(r) for r in wide], [tuple(r) for r in theirs], rtol=1e-9)


def test_unknown_form(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError, match="form"):
        score(feature.binarizer(input_col="x", output_col="b"), df, ["x"], form="other")


def test_wide_classifiers_go_by_vectors_and_nulls_stay_null(spark, monkeypatch):
    df = spark.range(60).select((F.col("id") % 4).cast("double").alias("label"), *[
        F.when(F.col("id") != 7 + i, F.sin(F.col("id") * (i + 1))).alias(f"x{i}") for i in range(5)])
    names = [f"x{i}" for i in range(5)]
    model = classification.logistic_regression(max_iter=5).fit(assemble(df.na.fill(0.0), names, keep=["label"]))
    assert not scoring.wide(model, 5)
    monkeypatch.setattr(scoring, "WIDE", 19)
    assert scoring.wide(model, 5)
    order = lambda rows: sorted(map(str, rows))
    whole = score(model, df, names, ["label"])
    rounded = lambda out: out.select(*[F.round(c, 9).alias(c) for c in sorted(out.columns)])
    assert order(rounded(whole).collect()) == order(rounded(score(model, df, names, ["label"], form="columns")).collect())
    assert whole.where("prediction IS NULL").count() == 5
