"""Learned state of every model class comes out as plain tables."""

import pytest
from pyspark.ml.linalg import MatrixUDT, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import UserDefinedType

from millrace.functions.tables import attribute, plain, trees
from millrace.operators import classification, clustering, feature, fpm, recommendation, regression
from millrace.plans.verbs import evaluate_model, summary


def _all(model, *names):
    frames = [attribute(model, n) if isinstance(n, str) else attribute(model, *n) for n in names]
    for name, df in zip(names, frames):
        assert not any(isinstance(f.dataType, UserDefinedType) for f in df.schema), name
        assert df.count() > 0, name
    return frames


def test_linear_models(vectors):
    _all(regression.linear_regression(max_iter=3).fit(vectors), "coefficients", "intercept", "scale", "num_features")
    _all(classification.linear_svc(max_iter=3).fit(vectors), "coefficients", "intercept", "num_classes")
    _all(classification.logistic_regression(max_iter=3).fit(vectors), "coefficients", "coefficient_matrix",
         "intercept", "intercept_vector", "num_classes")
    _all(regression.generalized_linear_regression(family="gaussian", reg_param=0.1).fit(vectors), "coefficients", "intercept")
    _all(regression.aft_survival_regression(label_col="survival", max_iter=3).fit(vectors), "coefficients", "intercept", "scale")
    _all(regression.isotonic_regression().fit(vectors), "boundaries", "predictions")


def test_factor_and_net_models(vectors):
    _all(classification.fm_classifier(max_iter=2).fit(vectors), "factors", "linear", "intercept")
    _all(regression.fm_regressor(max_iter=2).fit(vectors), "factors", "linear", "intercept")
    _all(classification.multilayer_perceptron_classifier(layers=[2, 2], max_iter=2).fit(vectors), "weights")
    _all(classification.naive_bayes(model_type="gaussian").fit(vectors), "pi", "theta", "sigma")


def test_tree_models(vectors):
    _all(classification.decision_tree_classifier().fit(vectors), "depth", "num_nodes", "feature_importances")
    _all(regression.decision_tree_regressor().fit(vectors), "depth", "num_nodes", "feature_importances")
    for build in (classification.random_forest_classifier, regression.random_forest_regressor):
        model = build(num_trees=3).fit(vectors)
        _all(model, "total_num_nodes", "tree_weights", "feature_importances", "get_num_trees")
        assert trees(model).count() == 3
    boosted = classification.gbt_classifier(max_iter=2).fit(vectors)
    _all(boosted, "tree_weights", ("evaluate_each_iteration", vectors))
    _all(regression.gbt_regressor(max_iter=2).fit(vectors), ("evaluate_each_iteration", vectors, "squared"))
    assert [r.weight for r in trees(boosted).orderBy("tree").collect()] == [1.0, 0.1]


def test_cluster_models(vectors):
    for build in (clustering.k_means, clustering.bisecting_k_means):
        model = build(k=2, seed=1).fit(vectors)
        (centres,) = _all(model, "cluster_center_matrix")
        assert centres.count() == 4
        _all(summary(model), "cluster_sizes", "cluster", "predictions", "k", "num_iter", "training_cost")
    mixture = clustering.gaussian_mixture(k=2, seed=1).fit(vectors)
    _all(mixture, "weights", "gaussians_df")
    _all(summary(mixture), "probability", "log_likelihood", "cluster_sizes")


def test_topic_models(texts):
    counted = feature.count_vectorizer(input_col="words", output_col="features").fit(texts).transform(texts)
    shared = ("estimated_doc_concentration", ("describe_topics", 2), "topics_matrix", "vocab_size", "is_distributed",
              ("log_likelihood", counted), ("log_perplexity", counted))
    _all(clustering.lda(k=2, max_iter=2, seed=1).fit(counted), *shared)
    em = clustering.lda(k=2, max_iter=2, optimizer="em", seed=1).fit(counted)
    _all(em, *shared, "training_log_likelihood", "log_prior")
    _all(em.toLocal(), *shared)


def test_feature_models(spark, points, vectors, texts):
    _all(feature.standard_scaler(input_col="features", output_col="o").fit(vectors), "mean", "std")
    _all(feature.min_max_scaler(input_col="features", output_col="o").fit(vectors), "original_min", "original_max")
    _all(feature.max_abs_scaler(input_col="features", output_col="o").fit(vectors), "max_abs")
    _all(feature.robust_scaler(input_col="features", output_col="o").fit(vectors), "median", "range")
    _all(feature.pca(input_col="features", output_col="o", k=1).fit(vectors), "pc", "explained_variance")
    _all(feature.imputer(input_col="x1", output_col="o").fit(points), "surrogate_df")
    _all(feature.string_indexer(input_col="category", output_col="o").fit(points), "labels", "labels_array")
    _all(feature.one_hot_encoder(input_col="idx", output_col="o").fit(points), "category_sizes")
    (maps,) = _all(feature.vector_indexer(input_col="features", output_col="o").fit(vectors), "category_maps_df")
    assert maps.columns == ["feature", "category", "idx"]
    (text,) = _all(feature.r_formula(formula="label ~ x1 + category").fit(points), "resolved_formula_string")
    assert "x1" in text.first()[0]
    for op in (
        feature.chi_sq_selector(output_col="o", num_top_features=1),
        feature.univariate_feature_selector(output_col="o", feature_type="continuous", label_type="categorical",
                                            selection_threshold=1.0),
        feature.variance_threshold_selector(output_col="o"),
    ):
        _all(op.fit(vectors), "selected_features")
    counter = feature.count_vectorizer(input_col="words", output_col="tf").fit(texts)
    _all(counter, "vocabulary")
    _all(feature.idf(input_col="tf", output_col="o").fit(counter.transform(texts)), "idf", "doc_freq", "num_docs")
    w2v = feature.word2vec(input_col="words", output_col="o", min_count=1, vector_size=3, seed=1).fit(texts)
    (words,) = _all(w2v, "get_vectors")
    _all(w2v, ("find_synonyms", "a", 2))
    from pyspark.ml.linalg import Vectors

    _all(w2v, ("find_synonyms", Vectors.dense(words.first().vector), 2))


def test_pattern_and_factor_tables(spark):
    baskets = spark.createDataFrame([(["a", "b"],), (["a", "b", "c"],), (["a"],)], "items array<string>")
    model = fpm.fp_growth(min_support=0.5, min_confidence=0.6).fit(baskets)
    sets, rules = _all(model, "freq_itemsets", "association_rules")
    assert rules.columns == ["antecedent", "consequent", "confidence", "lift", "support"] and sets.count() == 3
    ratings = spark.createDataFrame([(0, 0, 4.0), (0, 1, 2.0), (1, 1, 3.0)], "user int, item int, rating float")
    als = recommendation.als(rank=2, max_iter=2, seed=1).fit(ratings)
    users = ratings.select("user").distinct()
    _all(als, "user_factors", "item_factors", "rank", ("recommend_for_all_users", 1), ("recommend_for_all_items", 1),
         ("recommend_for_user_subset", users, 1), ("recommend_for_item_subset", ratings.select("item"), 1))


COMMON = ("accuracy", "labels", "precision_by_label", "recall_by_label", ("f_measure_by_label", 1.0),
          "true_positive_rate_by_label", "false_positive_rate_by_label", "weighted_precision", "weighted_recall",
          ("weighted_f_measure", 2.0), "weighted_true_positive_rate", "weighted_false_positive_rate", "predictions")
CURVES = ("roc", "pr", "area_under_roc", "f_measure_by_threshold", "precision_by_threshold", "recall_by_threshold")
TRAINED = ("objective_history", "total_iterations")


@pytest.mark.parametrize("build,names", [
    (lambda: classification.logistic_regression(max_iter=3), CURVES + TRAINED),
    (lambda: classification.linear_svc(max_iter=3), CURVES + TRAINED),
    (lambda: classification.fm_classifier(max_iter=2), CURVES + TRAINED),
    (lambda: classification.random_forest_classifier(num_trees=2), CURVES),
    (lambda: classification.multilayer_perceptron_classifier(layers=[2, 2], max_iter=3), TRAINED),
])
def test_classification_summaries(vectors, build, names):
    model = build().fit(vectors)
    _all(summary(model), *COMMON, *names)
    _all(evaluate_model(model, vectors), *COMMON, *[n for n in names if n not in TRAINED])


def test_more_than_two_classes_have_no_curves(vectors):
    three = vectors.withColumn("label", F.col("label") + F.col("idx"))
    s = summary(classification.logistic_regression(max_iter=3).fit(three))
    _all(s, *COMMON, *TRAINED)
    with pytest.raises(AttributeError, match="no 'roc'"):
        attribute(s, "roc")


def test_regression_summaries(vectors):
    model = regression.linear_regression(solver="normal").fit(vectors)
    names = ("r2", "r2adj", "mean_absolute_error", "mean_squared_error", "root_mean_squared_error", "explained_variance",
             "residuals", "deviance_residuals", "coefficient_standard_errors", "t_values", "p_values",
             "degrees_of_freedom", "num_instances", "predictions")
    _all(summary(model), *names, "objective_history", "total_iterations")
    _all(evaluate_model(model, vectors), *[n for n in names if n not in (
        "coefficient_standard_errors", "t_values", "p_values")])
    glm = regression.generalized_linear_regression(family="gaussian").fit(vectors)
    names = ("aic", "deviance", "null_deviance", "dispersion", "rank", "degrees_of_freedom",
             "residual_degree_of_freedom", "residual_degree_of_freedom_null", "num_instances", "predictions",
             *[("residuals", kind) for kind in ("deviance", "pearson", "working", "response")])
    _all(summary(glm), *names, "num_iterations", "solver", "coefficient_standard_errors", "t_values", "p_values")
    _all(evaluate_model(glm, vectors), *names)
    (table,) = _all(glm, "coefficients_with_statistics")
    assert [r.feature for r in table.collect()] == ["0", "1", "(intercept)"]


def test_unknown_attribute_lists_the_known(vectors):
    model = clustering.k_means(k=2, seed=1).fit(vectors)
    with pytest.raises(AttributeError, match="cluster_centers"):
        attribute(model, "centres")


def test_plain_opens_every_vector(spark):
    from pyspark.ml.linalg import Matrices, Vectors

    df = spark.createDataFrame(
        [(Vectors.sparse(4, [1, 3], [5.0, 7.0]), Matrices.dense(2, 1, [1.0, 2.0]), [Vectors.dense([1.0])], ("x", Vectors.dense([2.0])))],
        _schema())
    row = plain(df).first()
    assert list(row.v) == [0.0, 5.0, 0.0, 7.0] and list(row.m) == [1.0, 2.0]
    assert [list(x) for x in row.vs] == [[1.0]] and list(row.s.v) == [2.0]


def _schema():
    from pyspark.sql import types as T

    return T.StructType([
        T.StructField("v", VectorUDT()), T.StructField("m", MatrixUDT()), T.StructField("vs", T.ArrayType(VectorUDT())),
        T.StructField("s", T.StructType([T.StructField("n", T.StringType()), T.StructField("v", VectorUDT())])),
    ])
