"""Evaluators: one metric at a time by the operator, and all at once by the reports."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import array_to_vector
from ..operators import evaluation
from ..plans import reports
from ..plans.verbs import evaluate, larger_better
from ..sources import table
from .inputs import JUDGED_SQL, TYPE_RANKS_SQL, TYPE_SETS_SQL, embedded, judged, type_ranks
from .registry import query, round_all

def _each(make, metrics, df, label=None, **params):
    """One row per metric, each from its own evaluator run over the cached frame."""
    df = df.persist()
    try:
        frames = [evaluate(make(metric_name=m, **params), df) for m in metrics]
    finally:
        df.unpersist()
    rows = reduce(DataFrame.unionByName, frames)
    return round_all(
        rows.select("metric", F.lit(label).cast("double").alias("label"), "value"), ["value"]
    )


BINARY_SQL = f"""
WITH j AS ({JUDGED_SQL}),
g AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM j GROUP BY score),
c AS (SELECT score, p, n, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER () AS tp, sum(n) OVER () AS tn
      FROM g WINDOW w AS (ORDER BY score DESC)),
s AS (SELECT *, cp / tp AS r, cp / (cp + cn) AS pr, lag(cp / tp) OVER (ORDER BY score DESC) AS r0,
             lag(cp / (cp + cn)) OVER (ORDER BY score DESC) AS pr0 FROM c)
"""


@query(BINARY_SQL + """
SELECT 'areaUnderROC' AS metric, NULL::DOUBLE AS label, round(sum(n * (cp - p + p / 2)) / max(tp * tn), 6) AS value FROM s
UNION ALL
SELECT 'areaUnderPR', NULL, round(sum((r - coalesce(r0, 0)) * (pr + coalesce(pr0, pr)) / 2), 6) FROM s""")
def binary_classification_evaluator(spark, sf):
    """Exact areas: no bins, so every distinct score is a point of the curve."""
    return _each(
        evaluation.binary_classification_evaluator, ["areaUnderROC", "areaUnderPR"], judged(spark, sf),
        raw_prediction_col="score", num_bins=0,
    )


MULTICLASS_SQL = f"""
WITH j AS ({JUDGED_SQL}),
k AS (SELECT label, sum(weight) AS actual, (SELECT sum(weight) FROM j) AS n,
             (SELECT sum(weight) FROM j x WHERE x.pred = y.label) AS said,
             sum(weight) FILTER (pred = label) AS tp FROM j y GROUP BY label),
m AS (SELECT label, actual / n AS share, coalesce(tp, 0) AS tp, n, coalesce(tp / said, 0) AS p, coalesce(tp, 0) / actual AS r,
             (coalesce(said, 0) - coalesce(tp, 0)) / (n - actual) AS fpr FROM k),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1,
             CASE WHEN p + r > 0 THEN 5 * p * r / (4 * p + r) ELSE 0 END AS f2 FROM m)
"""
OVERALL = {
    "f1": "sum(share * f1)", "accuracy": "sum(tp) / max(n)", "weightedPrecision": "sum(share * p)",
    "weightedRecall": "sum(share * r)", "weightedTruePositiveRate": "sum(share * r)",
    "weightedFalsePositiveRate": "sum(share * fpr)", "weightedFMeasure": "sum(share * f2)",
    "hammingLoss": "1 - sum(tp) / max(n)",
}
BY_LABEL = {
    "truePositiveRateByLabel": "r", "falsePositiveRateByLabel": "fpr", "precisionByLabel": "p",
    "recallByLabel": "r", "fMeasureByLabel": "f2",
}


def _union(named, rule):
    return " UNION ALL ".join(rule(n, e) for n, e in named.items())


WHOLE_SQL = _union(OVERALL, lambda n, e: f"SELECT '{n}' AS metric, NULL::DOUBLE AS label, round({e}, 6) + 0.0 AS value FROM f")


@query(MULTICLASS_SQL + WHOLE_SQL + " UNION ALL " + _union(
    BY_LABEL, lambda n, e: f"SELECT '{n}', 1.0, round({e}, 6) FROM f WHERE label = 1"))
def multiclass_classification_evaluator(spark, sf):
    """Thirteen metrics of weighted rows; those by label for label 1."""
    df = judged(spark, sf)
    rules = {"weight_col": "weight", "beta": 2.0, "metric_label": 1.0}
    make = evaluation.multiclass_classification_evaluator
    whole = _each(make, list(OVERALL), df, **rules)
    return whole.unionByName(_each(make, list(BY_LABEL), df, 1.0, **rules))


@query(MULTICLASS_SQL + WHOLE_SQL + " UNION ALL " + _union(
    BY_LABEL, lambda n, e: f"SELECT '{n}', label, round({e}, 6) FROM f"))
def multiclass_report(spark, sf):
    """The same metrics for every label from one pass."""
    return round_all(reports.multiclass(judged(spark, sf), weight="weight", beta=2.0), ["value"])


LOG_LOSS_SQL = f"""
WITH j AS ({JUDGED_SQL})
SELECT 'logLoss' AS metric, NULL::DOUBLE AS label,
       round(sum(-weight * ln(CASE WHEN label = 1 THEN score / (score + 500) ELSE 500 / (score + 500) END)) / sum(weight), 6) AS value
FROM j"""


def _with_probability(spark, sf):
    p = F.col("score") / (F.col("score") + 500)
    return judged(spark, sf).withColumn("p", F.array(1.0 - p, p))


@query(LOG_LOSS_SQL)
def log_loss_evaluator(spark, sf):
    df = _with_probability(spark, sf).withColumn("probability", array_to_vector("p"))
    return _each(evaluation.multiclass_classification_evaluator, ["logLoss"], df, weight_col="weight")


@query(LOG_LOSS_SQL)
def log_loss_report(spark, sf):
    return round_all(reports.log_loss(_with_probability(spark, sf), "p", weight="weight"), ["value"])


MULTILABEL_SQL = TYPE_SETS_SQL + """,
b AS (SELECT *, len(list_intersect(p, t))::DOUBLE AS b, len(p)::DOUBLE AS np, len(t)::DOUBLE AS nt FROM ranks),
said AS (SELECT user_id, unnest(p) AS c FROM ranks), truth AS (SELECT user_id, unnest(t) AS c FROM ranks),
cls AS (SELECT c, count(*)::DOUBLE AS actual, (SELECT count(*) FROM said s WHERE s.c = truth.c)::DOUBLE AS claimed,
               (SELECT count(*) FROM said s JOIN truth u USING (user_id, c) WHERE s.c = truth.c)::DOUBLE AS tp
        FROM truth GROUP BY c)
"""
MULTILABEL = {
    "subsetAccuracy": "avg((b = np AND b = nt)::INT)", "accuracy": "avg(coalesce(b / nullif(np + nt - b, 0), 0))",
    "hammingLoss": "avg(np + nt - 2 * b) / (SELECT count(*) FROM cls)", "precision": "avg(coalesce(b / nullif(np, 0), 0))",
    "recall": "avg(coalesce(b / nullif(nt, 0), 0))", "f1Measure": "avg(coalesce(2 * b / nullif(np + nt, 0), 0))",
    "microPrecision": "sum(b) / sum(np)", "microRecall": "sum(b) / sum(nt)",
    "microF1Measure": "2 * sum(b) / (sum(np) + sum(nt))",
}
MULTILABEL_BY = {
    "precisionByLabel": "tp / claimed", "recallByLabel": "tp / actual",
    "f1MeasureByLabel": "2 * tp / (claimed + actual)",
}
MULTILABEL_WHOLE_SQL = _union(
    MULTILABEL, lambda n, e: f"SELECT '{n}' AS metric, NULL::DOUBLE AS label, round({e}, 6) AS value FROM b"
)
# a type all users share in the test data: 'view'
VIEW = ord("v") * 1000.0 + len("view")


def _label_sets(spark, sf):
    """Sorted, because the operator's subset accuracy compares arrays, not sets."""
    return type_ranks(spark, sf, whole=True).select(
        F.array_sort("prediction").alias("prediction"), F.array_sort("label").alias("label")
    )


@query(MULTILABEL_SQL + MULTILABEL_WHOLE_SQL + " UNION ALL " + _union(
    MULTILABEL_BY, lambda n, e: f"SELECT '{n}', c, round({e}, 6) FROM cls WHERE c = {VIEW}"))
def multilabel_classification_evaluator(spark, sf):
    df = _label_sets(spark, sf)
    make = evaluation.multilabel_classification_evaluator
    whole = _each(make, list(MULTILABEL), df)
    return whole.unionByName(_each(make, list(MULTILABEL_BY), df, VIEW, metric_label=VIEW))


@query(MULTILABEL_SQL + MULTILABEL_WHOLE_SQL + " UNION ALL " + _union(
    MULTILABEL_BY, lambda n, e: f"SELECT '{n}', c, round({e}, 6) FROM cls"))
def multilabel_report(spark, sf):
    return round_all(reports.multilabel(type_ranks(spark, sf, whole=True)), ["value"])


RANKING_SQL = TYPE_RANKS_SQL + """,
h AS (SELECT p, t, len(t) AS m, [i FOR i IN range(1, len(p) + 1) IF list_contains(t, p[i])] AS hits FROM ranks WHERE len(t) > 0),
x AS (SELECT *, [i FOR i IN hits IF i <= {k}] AS near FROM h),
v AS (SELECT *, coalesce(list_sum([j::DOUBLE / hits[j] FOR j IN range(1, len(hits) + 1)]), 0) / m AS ap,
             coalesce(list_sum([j::DOUBLE / near[j] FOR j IN range(1, len(near) + 1)]), 0) / least(m, {k}) AS apk,
             len(near) / {k}.0 AS pk, len(near)::DOUBLE / m AS rk,
             coalesce(list_sum([1 / ln(i + 1) FOR i IN near]), 0) / list_sum([1 / ln(i + 1) FOR i IN range(1, least(m, {k}) + 1)]) AS ndcg
      FROM x),
n AS (SELECT count(*)::DOUBLE AS n FROM ranks)
"""
AT_K = {"meanAveragePrecisionAtK": "apk", "precisionAtK": "pk", "ndcgAtK": "ndcg", "recallAtK": "rk"}


def _ranking_sql(k):
    parts = {"meanAveragePrecision": "ap"}
    return RANKING_SQL.format(k=k) + _union(
        parts | AT_K,
        lambda n, e: f"SELECT '{n}' AS metric, {'NULL' if n in parts else k}::DOUBLE AS label, "
        f"round((SELECT sum({e}) FROM v) / n, 6) AS value FROM n",
    )


@query(_ranking_sql(3))
def ranking_evaluator(spark, sf):
    """Types of a user ranked by one half month against those of the other."""
    df = type_ranks(spark, sf)
    make = evaluation.ranking_evaluator
    whole = _each(make, ["meanAveragePrecision"], df, k=3)
    return whole.unionByName(_each(make, list(AT_K), df, 3.0, k=3))


@query(_ranking_sql(3))
def ranking_report(spark, sf):
    return round_all(reports.ranking(type_ranks(spark, sf), ks=[3]), ["value"])


REGRESSION_SQL = """
WITH r AS (SELECT l_extendedprice AS y, l_quantity * 2100 AS p FROM lineitem),
a AS (SELECT avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae, var_pop(y) AS vy, avg(y * y) AS yy,
             var_pop(p) + pow(avg(p) - avg(y), 2) AS v FROM r)
"""
REGRESSION = {"rmse": "sqrt(mse)", "mse": "mse", "r2": "1 - mse / {base}", "mae": "mae", "var": "v"}
REGRESSION_DIGITS = {"rmse": 6, "mse": 0, "r2": 8, "mae": 6, "var": 0}


def _regression_sql(base):
    return REGRESSION_SQL + _union(REGRESSION, lambda n, e: (
        f"SELECT '{n}' AS metric, NULL::DOUBLE AS label, round({e.format(base=base)}, {REGRESSION_DIGITS[n]}) AS value FROM a"
    ))


def _priced(spark, sf):
    df = table(spark, sf, "lineitem", ["l_extendedprice", "l_quantity"])
    return df.select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 2100).alias("prediction"))


def _regression_rounded(df):
    value = F.col("value")
    for metric, digits in REGRESSION_DIGITS.items():
        value = F.when(F.col("metric") == metric, F.round("value", digits)).otherwise(value)
    return df.withColumn("value", value)


@query(_regression_sql("vy"))
def regression_evaluator(spark, sf):
    df = _priced(spark, sf).persist()
    try:
        frames = [
            evaluate(evaluation.regression_evaluator(metric_name=m), df).select(
                "metric", F.lit(None).cast("double").alias("label"), "value")
            for m in REGRESSION
        ]
    finally:
        df.unpersist()
    return _regression_rounded(reduce(DataFrame.unionByName, frames))


@query(_regression_sql("yy"))
def regression_report_through_origin(spark, sf):
    return _regression_rounded(reports.regression(_priced(spark, sf), through_origin=True))


@query("""
WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
y AS (SELECT label, d, sum(x) AS sx FROM e GROUP BY ALL),
q AS (SELECT vec_id, label, sum(x * x) AS xx FROM e GROUP BY ALL),
z AS (SELECT label, count(*) AS n, sum(xx) AS sxx FROM q GROUP BY label),
dots AS (SELECT e.vec_id, y.label AS other, sum(e.x * y.sx) AS dot FROM e JOIN y USING (d) GROUP BY ALL),
dist AS (SELECT vec_id, q.label, other, z.n,
                (z.n * xx + sxx - 2 * dot) / (CASE WHEN q.label = other THEN z.n - 1 ELSE z.n END) AS m
         FROM dots JOIN q USING (vec_id) JOIN z ON z.label = other),
ab AS (SELECT vec_id, min(m) FILTER (label = other) AS a, min(m) FILTER (label <> other) AS b FROM dist GROUP BY vec_id)
SELECT 'silhouette' AS metric, NULL::DOUBLE AS label, round(avg((b - a) / greatest(a, b)), 6) + 0.0 AS value FROM ab""")
def clustering_evaluator(spark, sf):
    df = embedded(spark, sf).withColumnRenamed("label", "prediction")
    return _each(evaluation.clustering_evaluator, ["silhouette"], df)


@query("""
WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
u AS (SELECT vec_id, label, d, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS x FROM e),
y AS (SELECT label, d, sum(x) AS sx FROM u GROUP BY ALL),
z AS (SELECT label, count(DISTINCT vec_id) AS n FROM u GROUP BY label),
dots AS (SELECT u.vec_id, u.label, y.label AS other, sum(u.x * y.sx) AS dot FROM u JOIN y USING (d) GROUP BY ALL),
dist AS (SELECT vec_id, dots.label, other,
                CASE WHEN dots.label = other THEN (n - dot) / (n - 1) ELSE 1 - dot / n END AS m
         FROM dots JOIN z ON z.label = other),
ab AS (SELECT vec_id, min(m) FILTER (label = other) AS a, min(m) FILTER (label <> other) AS b FROM dist GROUP BY vec_id)
SELECT 'silhouette' AS metric, NULL::DOUBLE AS label, round(avg((b - a) / greatest(a, b)), 6) + 0.0 AS value FROM ab""")
def clustering_evaluator_cosine(spark, sf):
    df = embedded(spark, sf).withColumnRenamed("label", "prediction")
    return _each(evaluation.clustering_evaluator, ["silhouette"], df, distance_measure="cosine")


@query(f"""
WITH j AS ({JUDGED_SQL}), a AS (SELECT avg((label = pred)::INT) AS accuracy FROM j)
SELECT unnest(['accuracy', 'hammingLoss']) AS metric, unnest([true, false]) AS larger_better,
       round(unnest([accuracy, 1 - accuracy]), 6) AS value FROM a""")
def metric_direction(spark, sf):
    """A metric beside whether larger is better, for whoever ranks by it."""
    df = judged(spark, sf)
    frames = []
    for metric in ("accuracy", "hammingLoss"):
        op = evaluation.multiclass_classification_evaluator(metric_name=metric)
        frames.append(evaluate(op, df).withColumn("larger_better", F.lit(larger_better(op))))
    return round_all(frames[0].unionByName(frames[1]), ["value"])
