"""Classifiers: fit on (features, label), score to prediction / probability columns."""

from pyspark.ml import classification as ml

from .base import constructor

decision_tree_classifier = constructor(ml.DecisionTreeClassifier)
fm_classifier = constructor(ml.FMClassifier)
gbt_classifier = constructor(ml.GBTClassifier)
linear_svc = constructor(ml.LinearSVC)
logistic_regression = constructor(ml.LogisticRegression)
multilayer_perceptron_classifier = constructor(ml.MultilayerPerceptronClassifier)
naive_bayes = constructor(ml.NaiveBayes)
random_forest_classifier = constructor(ml.RandomForestClassifier)
