"""Evaluators: one number from a scored frame."""

from pyspark.ml import evaluation as ml

from .base import constructor

binary_classification_evaluator = constructor(ml.BinaryClassificationEvaluator)
clustering_evaluator = constructor(ml.ClusteringEvaluator)
multiclass_classification_evaluator = constructor(ml.MulticlassClassificationEvaluator)
multilabel_classification_evaluator = constructor(ml.MultilabelClassificationEvaluator)
ranking_evaluator = constructor(ml.RankingEvaluator)
regression_evaluator = constructor(ml.RegressionEvaluator)
