import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import DistributedLDAModel, KMeansModel, LocalLDAModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Binarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, TrainValidationSplitModel
from pyspark.sql import functions as F

from millrace.operators import classification, clustering, evaluation, feature, regression
from millrace.plans.tuning import cross_validator, param_grid, train_validation_split
from millrace.plans.verbs import evaluate_model, pipeline, summary
from millrace.session import scratch_path
from millrace.sources import load, numbers_from_text, save, spread


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test")


def test_operators_keep_their_params(spark, path):
    save(feature.binarizer(input_col="a", output_col="b", threshold=3.0), path)
    assert load(Binarizer, path).getThreshold() == 3.0
    save(evaluation.regression_evaluator(metric_name="mae"), path, overwrite=True)
    assert load(RegressionEvaluator, path).getMetricName() == "mae"


def test_saving_twice_needs_overwrite(spark, path):
    save(feature.binarizer(), path)
    with pytest.raises(Exception, match="already exists|overwrite"):
        save(feature.binarizer(), path)


def test_a_loaded_model_scores_the_same_and_has_no_summary(vectors, path):
    model = classification.logistic_regression(max_iter=5).fit(vectors)
    save(model, path)
    again = load(LogisticRegressionModel, path)
    assert again.transform(vectors).collect() == model.transform(vectors).collect()
    with pytest.raises(ValueError, match="no training summary"):
        summary(again)
    assert evaluate_model(again, vectors).accuracy == summary(model).accuracy


def test_the_class_must_match(vectors, path):
    save(clustering.k_means(k=2, seed=1).fit(vectors), path)
    with pytest.raises(ValueError, match="KMeansModel, not a LogisticRegressionModel"):
        load(LogisticRegressionModel, path)
    assert load(KMeansModel, path).getK() == 2


def test_topic_models_of_both_kinds(texts, spark):
    counted = feature.count_vectorizer(input_col="words", output_col="features").fit(texts).transform(texts)
    for optimizer, cls in (("online", LocalLDAModel), ("em", DistributedLDAModel)):
        path = scratch_path(spark, "lda")
        save(clustering.lda(k=2, max_iter=2, optimizer=optimizer, seed=1).fit(counted), path)
        assert load(cls, path).isDistributed() == (optimizer == "em")


def test_staged_fits(points, path):
    stages = pipeline([feature.vector_assembler(input_cols=["x1", "x2"], output_col="features"),
                       regression.linear_regression()])
    save(stages, path)
    assert [s.uid for s in load(Pipeline, path).getStages()] == [s.uid for s in stages.getStages()]
    model = stages.fit(points)
    save(model, path, overwrite=True)
    assert load(PipelineModel, path).transform(points).collect() == model.transform(points).collect()


def test_searches(vectors, path):
    op = regression.linear_regression(solver="normal")
    search = cross_validator(op, param_grid((op, {"reg_param": [0.0, 2.0]})), evaluation.regression_evaluator(),
                             num_folds=2, fold_col="fold", collect_sub_models=True)
    save(search, path)
    assert load(CrossValidator, path).getNumFolds() == 2
    found = search.fit(vectors.withColumn("fold", F.col("idx").cast("int")))
    save(found, path, overwrite=True, persistSubModels="true")
    again = load(CrossValidatorModel, path)
    assert again.avgMetrics == pytest.approx(found.avg_metrics)  # Spark's format has no place for the spread
    assert [len(f) for f in again.subModels] == [2, 2]
    assert list(again.bestModel.coefficients) == list(found.best_model.coefficients)


def test_split_searches(vectors, path):
    op = regression.linear_regression(solver="normal")
    found = train_validation_split(op, param_grid((op, {"reg_param": [0.0, 2.0]})), evaluation.regression_evaluator(),
                                   train_ratio=0.5, seed=4).fit(vectors)
    save(found, path)
    assert load(TrainValidationSplitModel, path).validationMetrics == pytest.approx(found.avg_metrics)


def test_a_search_without_metrics_is_refused(vectors, path):
    model = regression.linear_regression().fit(vectors)
    op = regression.linear_regression()
    shell = CrossValidator(estimator=op, estimatorParamMaps=[{}], evaluator=evaluation.regression_evaluator())
    save(shell._copyValues(CrossValidatorModel(model, [], None, [])), path)
    with pytest.raises(ValueError, match="no metrics"):
        load(CrossValidatorModel, path)


def test_an_unfitted_operator_loads_unfitted(spark, path):
    save(classification.logistic_regression(reg_param=0.5), path)
    assert load(LogisticRegression, path).getRegParam() == 0.5


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("1,2.5,-3",)], "t string")
    assert df.select(numbers_from_text("t").alias("a")).first().a == [1.0, 2.5, -3.0]


def test_spread_leaves_wide_frames_alone(spark):
    wide, thin = spark.range(0, 100, 1, 50), spark.range(0, 100, 1, 1)
    assert spread(wide) is wide
    assert spread(thin, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(thin).count() == 100
