"""Regressors: fit on (features, label), score to a prediction column."""

from pyspark.ml import regression as ml

from .base import constructor

aft_survival_regression = constructor(ml.AFTSurvivalRegression)
decision_tree_regressor = constructor(ml.DecisionTreeRegressor)
fm_regressor = constructor(ml.FMRegressor)
gbt_regressor = constructor(ml.GBTRegressor)
generalized_linear_regression = constructor(ml.GeneralizedLinearRegression)
isotonic_regression = constructor(ml.IsotonicRegression)
linear_regression = constructor(ml.LinearRegression)
random_forest_regressor = constructor(ml.RandomForestRegressor)
