import pytest

from millrace import operators as op
from millrace.operators import classification, clustering, evaluation, feature, fpm, recommendation, regression
from millrace.plans.verbs import (
    assign_clusters, evaluate, find_frequent_sequential_patterns, fit, larger_better, pipeline, transform,
)


def test_every_operator_has_a_constructor():
    names = op.names()
    kinds = [getattr(op.GROUPS[g], n).kind for n, g in names.items()]
    assert len(names) == 68
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "estimator": 42, "transformer": 18, "evaluator": 6, "helper": 2,
    }


@pytest.mark.parametrize("name,count", [
    ("gbt_classifier", 25), ("als", 18), ("sql_transformer", 1), ("logistic_regression", 21),
    ("word2vec", 10), ("power_iteration_clustering", 6), ("prefix_span", 4), ("ranking_evaluator", 4),
])
def test_params_are_those_of_the_class(name, count):
    build = getattr(op.GROUPS[op.names()[name]], name)
    assert len(op.param_names(build.operator)) == count


def test_every_constructor_builds(spark):
    for name, group in op.names().items():
        build = getattr(op.GROUPS[group], name)
        assert type(build()) is build.operator


def test_snake_names():
    assert [op.snake(n) for n in ("maxBlockSizeInMB", "minDF", "maxLocalProjDBSize", "k")] == [
        "max_block_size_in_mb", "min_df", "max_local_proj_db_size", "k",
    ]


def test_either_spelling_and_only_given_params_are_set(spark):
    a, b = feature.count_vectorizer(min_df=2.0), feature.count_vectorizer(minDF=2.0)
    assert a.getMinDF() == b.getMinDF() == 2.0
    assert a.isSet("minDF") and not a.isSet("vocabSize")


def test_unknown_param_is_refused_with_the_known_ones(spark):
    with pytest.raises(TypeError, match="num_tree.*num_trees"):
        classification.random_forest_classifier(num_tree=3)


def test_whole_floats_are_ints_and_fractions_are_not(spark):
    assert clustering.k_means(k=3.0).getK() == 3
    with pytest.raises(TypeError):
        clustering.k_means(k=2.5)


def test_setting_again_replaces(spark):
    est = clustering.k_means(k=3)
    assert op.configure(est, k=5).getK() == 5


@pytest.mark.parametrize("build,params", [
    (classification.decision_tree_classifier, {}),
    (classification.fm_classifier, {"max_iter": 2}),
    (classification.gbt_classifier, {"max_iter": 2}),
    (classification.linear_svc, {"max_iter": 2}),
    (classification.logistic_regression, {"max_iter": 2, "weight_col": "weight"}),
    (classification.multilayer_perceptron_classifier, {"layers": [2, 2], "max_iter": 2}),
    (classification.naive_bayes, {"model_type": "gaussian"}),
    (classification.random_forest_classifier, {"num_trees": 2}),
    (clustering.bisecting_k_means, {"k": 2}),
    (clustering.gaussian_mixture, {"k": 2}),
    (clustering.k_means, {"k": 2}),
    (regression.aft_survival_regression, {"label_col": "survival", "max_iter": 3}),
    (regression.decision_tree_regressor, {}),
    (regression.fm_regressor, {"max_iter": 2}),
    (regression.gbt_regressor, {"max_iter": 2}),
    (regression.generalized_linear_regression, {"family": "gaussian"}),
    (regression.isotonic_regression, {}),
    (regression.linear_regression, {}),
    (regression.random_forest_regressor, {"num_trees": 2}),
])
def test_predictors_fit_and_add_a_prediction(vectors, build, params):
    out = transform(fit(build(**params), vectors), vectors)
    assert "prediction" in out.columns and out.count() == vectors.count()


def test_leaf_and_variance_columns(vectors):
    model = regression.decision_tree_regressor(leaf_col="leaf", variance_col="spread").fit(vectors)
    assert {"leaf", "spread"} <= set(model.transform(vectors).columns)


def test_helpers_answer_frames(spark):
    edges = spark.createDataFrame(
        [(0, 1, 1.0), (1, 2, 1.0), (3, 4, 1.0), (2, 0, 1.0)], "src long, dst long, weight double"
    )
    clusters = assign_clusters(clustering.power_iteration_clustering(k=2, weight_col="weight"), edges)
    assert dict(clusters.dtypes) == {"id": "bigint", "cluster": "int"} and clusters.count() == 5
    sequences = spark.createDataFrame(
        [([["a"], ["b"]],), ([["a"], ["c"], ["b"]],), ([["b"]],)], "sequence array<array<string>>"
    )
    found = find_frequent_sequential_patterns(fpm.prefix_span(min_support=0.6), sequences)
    got = {tuple(tuple(i) for i in r.sequence): r.freq for r in found.collect()}
    assert got == {(("a",),): 2, (("b",),): 3, (("a",), ("b",)): 2}


def test_repeated_items_fail_the_mining(spark):
    df = spark.createDataFrame([(["x", "x"],)], "items array<string>")
    with pytest.raises(Exception, match="unique"):
        fpm.fp_growth(min_support=0.5).fit(df).freqItemsets.collect()


def test_directions(spark):
    make = evaluation.multiclass_classification_evaluator
    up = {m: larger_better(make(metric_name=m)) for m in (
        "f1", "accuracy", "weightedFalsePositiveRate", "falsePositiveRateByLabel", "logLoss", "hammingLoss")}
    assert up == {"f1": True, "accuracy": True, "weightedFalsePositiveRate": False,
                  "falsePositiveRateByLabel": False, "logLoss": False, "hammingLoss": False}
    assert [larger_better(evaluation.regression_evaluator(metric_name=m)) for m in
            ("rmse", "mse", "mae", "r2", "var")] == [False, False, False, True, True]
    assert not larger_better(evaluation.multilabel_classification_evaluator(metric_name="hammingLoss"))
    assert larger_better(evaluation.ranking_evaluator()) and larger_better(evaluation.clustering_evaluator())


def test_evaluate_is_a_row(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0)], "label double, prediction double")
    out = evaluate(evaluation.regression_evaluator(metric_name="mae"), df)
    assert [tuple(r) for r in out.collect()] == [("mae", 0.5)]


def test_a_stage_must_be_one(spark):
    with pytest.raises(TypeError, match="stage 1"):
        pipeline([feature.tokenizer(input_col="t", output_col="w"), "not a stage"])
    with pytest.raises(TypeError, match="fit it first"):
        transform(clustering.k_means(), None)


def test_stages_nest_and_fitted_ones_pass(spark, points):
    indexed = feature.string_indexer(input_col="category", output_col="c").fit(points)
    inner = pipeline([feature.vector_assembler(input_cols=["x1", "c"], output_col="features")])
    model = pipeline([indexed, inner, regression.linear_regression()]).fit(points)
    assert model.stages[0].uid == indexed.uid
    assert "prediction" in model.transform(points).columns


def test_data_stops_at_the_last_estimator(spark, points):
    """A stage after it is carried untouched, even one that could not run on the data."""
    late = feature.sql_transformer(statement="SELECT no_such_column FROM __THIS__")
    stages = pipeline([
        feature.vector_assembler(input_cols=["x1"], output_col="features"), regression.linear_regression(), late,
    ])
    model = stages.fit(points)
    assert model.stages[-1].uid == late.uid


def test_prebuilt_models(spark, texts):
    colours = spark.createDataFrame([("red",), ("green",), ("blue",)], "colour string")
    model = feature.string_indexer_from_labels(["green", "red"], "colour", "i", "keep")
    assert {r.colour: r.i for r in model.transform(colours).collect()} == {"green": 0.0, "red": 1.0, "blue": 2.0}
    counter = feature.count_vectorizer_from_vocabulary(["a", "d"], "words", "tf", binary=True)
    assert [list(r.tf.toArray()) for r in counter.transform(texts).orderBy("id").collect()] == [
        [1, 0], [1, 1], [0, 1], [1, 0]]


def test_stop_words_of_a_language(spark):
    assert len(feature.default_stop_words()) == 181
    assert "und" in feature.default_stop_words("german")


def test_decimals_are_cast_at_the_edge(spark):
    from millrace.functions.vectors import assemble

    df = spark.sql("SELECT 0.5 AS d, 1 AS i, true AS b")
    row = assemble(df, ["d", "i", "b"]).first()
    assert list(row.features.toArray()) == [0.5, 1.0, 1.0]


def test_recommendation_needs_ratings(spark):
    df = spark.createDataFrame([(0, 0, 4.0), (0, 1, 2.0), (1, 1, 3.0), (1, 2, 4.0)], "user int, item int, rating float")
    model = recommendation.als(rank=2, max_iter=2, seed=1).fit(df)
    assert model.rank == 2 and model.userFactors.count() == 2
