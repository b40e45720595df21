import math

import pytest
from pyspark.sql import functions as F

from millrace.functions.vectors import assemble
from millrace.operators import classification, clustering, evaluation, feature, regression
from millrace.plans.tuning import (
    best_index, check_grid, cross_validator, fold_by_key, mean_and_spread, param_grid, train_validation_split,
)
from millrace.plans.verbs import pipeline, transform


@pytest.fixture(scope="module")
def line(spark):
    df = spark.range(60).select(
        F.col("id"), F.col("id").cast("double").alias("x"),
        (F.col("id") * 2.0 + 1 + F.sin("id")).alias("label"), (F.col("id") % 3).alias("fold"),
    )
    return assemble(df, ["x"]).persist()


def _named(grid):
    return [{p.name: v for p, v in m.items()} for m in grid]


def test_the_last_param_varies_fastest(spark):
    op = regression.linear_regression()
    grid = param_grid((op, {"reg_param": [0.0, 1.0], "max_iter": [1, 2, 3]}))
    assert _named(grid)[:4] == [
        {"regParam": 0.0, "maxIter": 1}, {"regParam": 0.0, "maxIter": 2}, {"regParam": 0.0, "maxIter": 3},
        {"regParam": 1.0, "maxIter": 1}]
    assert len(grid) == 6


def test_a_grid_may_span_operators(spark):
    a, b = feature.hashing_tf(), regression.linear_regression()
    grid = param_grid((a, {"num_features": [4, 8]}), (b, {"reg_param": [0.1]}))
    assert [{p.parent for p in m} for m in grid] == [{a.uid, b.uid}] * 2


def test_bad_grids_are_refused(spark):
    op = regression.linear_regression()
    with pytest.raises(ValueError, match="no values"):
        param_grid((op, {"reg_param": []}))
    with pytest.raises(TypeError, match="no param"):
        param_grid((op, {"regparm": [1]}))
    with pytest.raises(ValueError, match="empty"):
        check_grid(op, [])


def test_a_stray_grid_is_refused_before_any_fit(spark, line):
    op, other = regression.linear_regression(), regression.linear_regression()
    search = cross_validator(op, param_grid((other, {"reg_param": [0.0]})), evaluation.regression_evaluator())
    with pytest.raises(ValueError, match="neither"):
        search.fit(line)


def test_a_stage_inside_a_stage_owns_its_params(spark):
    op = regression.linear_regression()
    check_grid(pipeline([pipeline([op])]), param_grid((op, {"reg_param": [0.0]})))


@pytest.mark.parametrize("metrics,larger,best", [
    ([1.0, 3.0, 3.0], True, 1), ([2.0, 1.0, 1.0], False, 1), ([5.0, 5.0], True, 0), ([5.0], False, 0)])
def test_ties_go_to_the_first(metrics, larger, best):
    assert best_index(metrics, larger) == best


def test_mean_and_spread():
    assert mean_and_spread([1.0, 3.0]) == (2.0, 1.0)  # population spread
    mean, spread = mean_and_spread([1e160, 3e160])
    assert mean == pytest.approx(2e160) and spread == pytest.approx(1e160) and math.isfinite(spread)
    assert mean_and_spread([0.1, 0.1, 0.1]) == (0.1, 0.0)
    assert mean_and_spread([0.0, 0.0]) == (0.0, 0.0)
    assert mean_and_spread([-2.0, 2.0]) == (0.0, 2.0)


def test_a_metric_that_is_not_finite_stops_the_search(spark, line):
    flat = line.withColumn("label", F.lit(1.0))
    op = regression.linear_regression(max_iter=1)
    search = cross_validator(
        op, param_grid((op, {"fit_intercept": [True]})), evaluation.regression_evaluator(metric_name="r2"),
        fold_col="fold")
    with pytest.raises(ValueError, match="r2 is"):
        search.fit(flat)


def test_fold_column_must_hold_every_fold(spark, line):
    op = regression.linear_regression()
    grid = param_grid((op, {"reg_param": [0.0]}))
    for bad in (F.lit(0), F.col("id") % 4, (F.col("id") % 3) + 1):
        with pytest.raises(ValueError, match="every fold"):
            cross_validator(op, grid, evaluation.regression_evaluator(), fold_col="fold").fit(line.withColumn("fold", bad))


def test_folds_part_the_rows_once(spark, line):
    op = regression.linear_regression()
    search = cross_validator(op, param_grid((op, {"reg_param": [0.0]})), evaluation.regression_evaluator(), num_folds=4)
    seen = []
    for train, validation in search._cuts(search._drawn(line)):
        a, b = {r.id for r in train.collect()}, {r.id for r in validation.collect()}
        assert not a & b and len(a | b) == 60
        seen += sorted(b)
    assert sorted(seen) == list(range(60))


def test_one_split_holds_the_rest_back(spark, line):
    op = regression.linear_regression()
    search = train_validation_split(op, param_grid((op, {"reg_param": [0.0]})), evaluation.regression_evaluator(), train_ratio=0.6)
    ((train, validation),) = search._cuts(search._drawn(line))
    assert train.count() + validation.count() == 60 and 15 < validation.count() < 35


def test_metrics_equal_sparks_own_search(spark, line):
    op = regression.linear_regression(solver="normal")
    grid = param_grid((op, {"reg_param": [0.0, 50.0]}))
    search = cross_validator(op, grid, evaluation.regression_evaluator(), fold_col="fold", num_folds=3)
    ours = search.fit(line)
    theirs = search.operator().fit(line)
    assert ours.avg_metrics == pytest.approx(theirs.avgMetrics)
    assert ours.std_metrics == pytest.approx(theirs.stdMetrics)
    assert ours.best == 0 and list(ours.best_model.coefficients) == pytest.approx(list(theirs.bestModel.coefficients))


def test_the_winner_scores_and_is_fitted_on_all_rows(spark, line):
    op = regression.linear_regression(solver="normal")
    found = cross_validator(op, param_grid((op, {"reg_param": [0.0, 9.0]})), evaluation.regression_evaluator(),
                            parallelism=2, fold_col="fold").fit(line)
    assert list(found.best_model.coefficients) == pytest.approx(list(op.fit(line).coefficients))
    assert "prediction" in transform(found, line).columns
    table = found.table(spark).collect()
    assert [r.is_best for r in table] == [True, False] and table[1].params == {f"{op.uid}.regParam": "9.0"}


def test_sub_models_are_kept_only_on_request(spark, line):
    op = regression.linear_regression(solver="normal")
    grid = param_grid((op, {"reg_param": [0.0, 1.0]}))
    plain = cross_validator(op, grid, evaluation.regression_evaluator(), num_folds=2).fit(line)
    kept = cross_validator(op, grid, evaluation.regression_evaluator(), num_folds=2, collect_sub_models=True).fit(line)
    assert plain.sub_models is None and [len(f) for f in kept.sub_models] == [2, 2]


def test_nothing_stays_cached(spark, line):
    op = regression.linear_regression(solver="normal")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    cross_validator(op, param_grid((op, {"reg_param": [0.0]})), evaluation.regression_evaluator(), num_folds=2).fit(line)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_fold_by_key_is_the_same_whatever_the_partitioning(spark):
    df = spark.range(1000)
    cut = fold_by_key(5, "id").alias("f")
    a = {r.id: r.f for r in df.select("id", cut).collect()}
    b = {r.id: r.f for r in df.repartition(13).select("id", cut).collect()}
    assert a == b and set(a.values()) == set(range(5))


def test_other_estimators_search_too(spark, vectors):
    op = clustering.k_means(seed=1)
    found = train_validation_split(
        op, param_grid((op, {"k": [2, 3]})), evaluation.clustering_evaluator(), train_ratio=0.8, seed=3)
    assert found.operator().getTrainRatio() == 0.8
    tree = classification.decision_tree_classifier()
    model = cross_validator(tree, param_grid((tree, {"max_depth": [1, 2]})),
                            evaluation.multiclass_classification_evaluator(metric_name="accuracy"),
                            num_folds=2, fold_col="fold").fit(vectors.withColumn("fold", F.col("idx").cast("int")))
    assert model.best == 0


def test_spread_at_the_edge_of_doubles():
    from millrace.plans.tuning import mean_and_spread

    mean, spread = mean_and_spread([2.0**1023, 1.5 * 2.0**1022])
    assert mean == 1.75 * 2.0**1022 and spread == 0.25 * 2.0**1022
