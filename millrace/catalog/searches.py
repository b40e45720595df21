"""Tuned searches, and saving them."""

from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import functions as F

from ..functions.vectors import assemble
from ..operators import classification, evaluation, feature, regression
from ..plans.tuning import best_index, cross_validator, fold_by_key, param_grid, train_validation_split
from ..plans.verbs import pipeline
from ..session import scratch_path
from ..sources import load, save, table
from .inputs import TEXT_SIZES_SQL, embedded, text_sizes
from .registry import query, round_all

FOLDS_SQL = f"""
WITH d AS ({TEXT_SIZES_SQL}),
k AS (SELECT unnest([0, 1, 2]) AS fold),
f AS (SELECT fold, regr_slope(n_chars, n_words) AS b, regr_intercept(n_chars, n_words) AS a,
             sum(n_words * n_chars) / sum(n_words * n_words) AS b0 FROM d JOIN k ON doc_id % 3 <> fold GROUP BY fold),
e AS (SELECT fold, sqrt(avg(pow(n_chars - a - b * n_words, 2))) AS r1, sqrt(avg(pow(n_chars - b0 * n_words, 2))) AS r0
      FROM d JOIN f ON doc_id % 3 = fold GROUP BY fold),
g AS (SELECT 0 AS grid_id, avg(r1) AS m, stddev_pop(r1) AS s FROM e UNION ALL SELECT 1, avg(r0), stddev_pop(r0) FROM e)
"""


def _folds(spark, sf):
    df = text_sizes(spark, sf).withColumn("fold", (F.col("doc_id") % 3).cast("int"))
    return assemble(df, ["n_words"], keep=["doc_id", "n_words", "n_chars", "fold"])


def _line_search():
    op = regression.linear_regression(label_col="n_chars", solver="normal")
    grid = param_grid((op, {"fit_intercept": [True, False]}))
    judge = evaluation.regression_evaluator(label_col="n_chars")
    return cross_validator(op, grid, judge, num_folds=3, fold_col="fold")


@query(FOLDS_SQL + """
SELECT grid_id::INT AS grid_id, round(m, 4) AS avg_metric, round(s, 4) AS std_metric,
       m = (SELECT min(m) FROM g) AS is_best FROM g""")
def cross_validation(spark, sf):
    """Folds given by a column: with an intercept or without."""
    found = _line_search().fit(_folds(spark, sf)).table(spark)
    return round_all(found.drop("params"), ["avg_metric", "std_metric"], 4)


@query(FOLDS_SQL + """
, w AS (SELECT CASE WHEN (SELECT m FROM g WHERE grid_id = 0) <= (SELECT m FROM g WHERE grid_id = 1)
                    THEN regr_slope(n_chars, n_words) ELSE sum(n_words * n_chars) / sum(n_words * n_words) END AS b,
               CASE WHEN (SELECT m FROM g WHERE grid_id = 0) <= (SELECT m FROM g WHERE grid_id = 1)
                    THEN regr_intercept(n_chars, n_words) ELSE 0 END AS a FROM d)
SELECT doc_id, round(a + b * n_words, 4) AS prediction FROM d, w""")
def cross_validation_winner(spark, sf):
    """The winner, refitted on every row, scores all of them; saved and read back first."""
    df = _folds(spark, sf)
    found = _line_search().fit(df)
    path = scratch_path(spark, "search")
    save(found, path)
    model = load(CrossValidatorModel, path)
    return round_all(model.transform(df).select("doc_id", "prediction"), ["prediction"], 4)


@query("""
SELECT (a * 4 + b * 2 + c)::INT AS grid_id, [1, 2][a + 1]::INT AS degree, [0.0, 0.1][b + 1]::DOUBLE AS reg,
       (c = 0) AS intercept
FROM (SELECT unnest([0, 1]) AS a) x, (SELECT unnest([0, 1]) AS b) y, (SELECT unnest([0, 1]) AS c) z""")
def grid_over_stages(spark, sf):
    """A grid over params of two stages, each entry tried on the documents."""
    widen = feature.polynomial_expansion(input_col="features", output_col="wide")
    op = regression.linear_regression(features_col="wide", label_col="n_chars")
    grid = param_grid((widen, {"degree": [1, 2]}), (op, {"reg_param": [0.0, 0.1], "fit_intercept": [True, False]}))
    judge = evaluation.regression_evaluator(label_col="n_chars")
    search = cross_validator(pipeline([widen, op]), grid, judge, num_folds=2, fold_col="half", parallelism=4)
    df = _folds(spark, sf).withColumn("half", (F.col("doc_id") % 2).cast("int"))
    found = search.fit(df).table(spark)
    own, other = widen.uid, op.uid
    return found.select(
        "grid_id", F.col("params").getItem(f"{own}.degree").cast("int").alias("degree"),
        F.col("params").getItem(f"{other}.regParam").cast("double").alias("reg"),
        (F.col("params").getItem(f"{other}.fitIntercept") == "True").alias("intercept"),
    )


@query()
def train_validation_search(spark, sf):
    df = embedded(spark, sf)
    op = classification.logistic_regression(max_iter=10)
    grid = param_grid((op, {"reg_param": [0.01, 0.3]}))
    judge = evaluation.multiclass_classification_evaluator(metric_name="accuracy")
    return train_validation_split(op, grid, judge, train_ratio=0.75, seed=42).fit(df).table(spark)


@query(FOLDS_SQL + "SELECT (CASE WHEN min(m) FILTER (grid_id = 0) <= min(m) FILTER (grid_id = 1) THEN 0 ELSE 1 END)::INT AS best FROM g")
def best_of_search(spark, sf):
    found = _line_search().fit(_folds(spark, sf))
    return spark.range(1).select(F.lit(best_index(found.avg_metrics, False)).alias("best"))


@query("SELECT count(*) AS n, true AS every_fold_used FROM documents")
def folds_by_key(spark, sf):
    """A fold from a hash of the key: no draw, so train and validation cannot drift apart."""
    df = table(spark, sf, "documents", ["doc_id"]).withColumn("fold", fold_by_key(3, "doc_id"))
    return df.agg(F.count("*").alias("n"), (F.count_distinct("fold") == 3).alias("every_fold_used"))
