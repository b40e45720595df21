"""What summaries and learned state say, beside SQL or beside the predictions that follow from them."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.tables import attribute
from ..functions.vectors import assemble, vector_to_array
from ..operators import classification, clustering, evaluation, regression
from ..plans.tuning import param_grid, train_validation_split
from ..plans.verbs import evaluate_model, summary
from ..sources import table
from .inputs import TEXT_SIZES_SQL, embedded
from .predictors import LINE_SQL, _lifetimes, _sized, poisson_summary
from .registry import query, rounded

SEED = 42

# a generalised fit's residuals and its criterion ---------------------------------------

POISSON_SQL = f"""
WITH d AS ({TEXT_SIZES_SQL}), m AS (SELECT lang, avg(n_words) AS m FROM d GROUP BY lang)
SELECT round(%s, 4) + 0.0 AS residual FROM d JOIN m USING (lang)"""


def _residual_query(kind: str, sql: str) -> None:
    def run(spark, sf):
        residuals = attribute(poisson_summary(spark, sf, 1e-12), "residuals", kind)
        return residuals.select(rounded(F.col(residuals.columns[0]), 4).alias("residual"))

    run.__doc__ = f"The {kind} residuals of a poisson fit, saturated in the language, of all documents."
    query(POISSON_SQL % sql, name=f"generalized_linear_regression_residuals_{kind}")(run)


_residual_query("response", "n_words - m")
_residual_query("working", "(n_words - m) / m")
_residual_query("deviance", "sign(n_words - m) * sqrt(greatest(0, 2 * (CASE WHEN n_words > 0 THEN n_words * ln(n_words / m) ELSE 0 END - (n_words - m))))")


@query(LINE_SQL + """
, s AS (SELECT sum(pow(n_chars - a - b * n_words, 2)) AS sse, count(*) AS n FROM d, f)
SELECT round(n * (ln(sse / n * 2 * pi()) + 1) + 2 + 2 * 2, 4) AS aic FROM s""")
def generalized_linear_regression_aic(spark, sf):
    """Akaike's criterion of a gaussian fit: two coefficients and the variance."""
    s = summary(regression.generalized_linear_regression(label_col="n_chars").fit(_sized(spark, sf)))
    return attribute(s, "aic").select(rounded("aic", 4).alias("aic"))


@query(LINE_SQL + """
, s AS (SELECT sqrt(sum(pow(n_chars - a - b * n_words, 2)) / (count(*) - 2)) AS sd, var_pop(n_words) * count(*) AS sxx,
               avg(n_words) AS mx, count(*) AS n FROM d, f)
SELECT unnest(['0', '(intercept)']) AS feature,
       round(unnest([b / (sd / sqrt(sxx)), a / (sd * sqrt(1.0 / n + mx * mx / sxx))]), 4) AS t_value FROM s, f""")
def linear_regression_t_values(spark, sf):
    """Each coefficient over its standard error."""
    model = regression.linear_regression(label_col="n_chars", solver="normal").fit(_sized(spark, sf))
    return attribute(model, "coefficients_with_statistics").select("feature", rounded("t_value", 4).alias("t_value"))


# a classifier on rows it has not seen --------------------------------------------------


@query("""
WITH d AS (SELECT l_linenumber AS line, (l_quantity + l_linenumber * 3 > 35)::INT AS y, l_orderkey % 2 AS part FROM lineitem),
t AS (SELECT line, CASE WHEN avg(y) > 0.5 THEN 1 ELSE 0 END AS p FROM d WHERE part = 1 GROUP BY line),
e AS (SELECT y, p FROM d JOIN t USING (line) WHERE part = 0)
SELECT count(*) AS n, round(avg((y = p)::INT), 8) AS accuracy,
       round(sum((y = 1 AND p = 1)::INT) / sum((y = 1)::INT)::DOUBLE, 8) AS recall_1,
       round(sum((y = 0 AND p = 1)::INT) / sum((y = 0)::INT)::DOUBLE, 8) AS false_positives_1 FROM e""")
def classifier_on_new_data(spark, sf):
    """Fitted on the lines of odd orders, judged on those of even ones."""
    df = table(spark, sf, "lineitem", ["l_linenumber", "l_quantity", "l_orderkey"])
    dummies = [f"n{i}" for i in range(2, 8)]
    df = df.select(
        (F.col("l_quantity") + F.col("l_linenumber") * 3 > 35).cast("double").alias("label"), (F.col("l_orderkey") % 2).alias("part"),
        *[(F.col("l_linenumber") == i).cast("double").alias(f"n{i}") for i in range(2, 8)])
    rows = assemble(df, dummies, keep=["label", "part"])
    model = classification.logistic_regression(max_iter=200, tol=1e-12).fit(rows.where("part = 1"))
    fresh = rows.where("part = 0")
    s = evaluate_model(model, fresh)
    return fresh.agg(F.count("*").alias("n")).select("n", *[
        rounded(F.lit(float(v)), 8).alias(name)
        for name, v in (("accuracy", s.accuracy), ("recall_1", s.recallByLabel[1]), ("false_positives_1", s.falsePositiveRateByLabel[1]))])


@query(LINE_SQL + """
SELECT 0::INT AS best, round(b, 6) AS coefficient, round(a, 4) AS intercept, 3::BIGINT AS tried FROM f""")
def train_validation_winner(spark, sf):
    """One cut of the rows: no penalty wins over heavy ones, and the winner is fitted on every row."""
    df = _sized(spark, sf)
    op = regression.linear_regression(label_col="n_chars", solver="normal")
    grid = param_grid((op, {"reg_param": [0.0, 1e5, 1e6]}))
    found = train_validation_split(op, grid, evaluation.regression_evaluator(label_col="n_chars"), train_ratio=0.75, seed=SEED).fit(df)
    scores = found.table(spark)
    best = scores.where("is_best").select(F.col("grid_id").cast("int").alias("best"))
    model = found.best_model
    return best.select(
        "best", rounded(F.lit(float(model.coefficients[0]))).alias("coefficient"), rounded(F.lit(float(model.intercept)), 4).alias("intercept"),
        F.lit(scores.count()).cast("bigint").alias("tried"))


# learned state -------------------------------------------------------------------------


@query("""
WITH x AS (SELECT (l_returnflag = 'N')::INT AS component, l_quantity + CASE WHEN l_returnflag = 'N' THEN 1000 ELSE 0 END AS x FROM lineitem),
g AS (SELECT component, avg(x) AS m, var_pop(x) AS v, count(*)::DOUBLE AS n FROM x GROUP BY component)
SELECT component, round(m, 4) AS mean, round(v, 4) AS variance, round(n / sum(n) OVER (), 6) AS weight,
       round(sum(n * ln(n / (SELECT count(*) FROM x)) - n / 2 * (ln(2 * pi()) + ln(v) + 1)) OVER (), 1) AS log_likelihood, true AS sure FROM g""")
def gaussian_mixture_of_two(spark, sf):
    """Two groups far apart: each component is its group's mean, variance and share, the likelihood has a closed form."""
    df = table(spark, sf, "lineitem", ["l_quantity", "l_returnflag"])
    df = assemble(df.select((F.col("l_quantity") + F.when(F.col("l_returnflag") == "N", 1000).otherwise(0)).alias("x")), ["x"])
    model = clustering.gaussian_mixture(k=2, max_iter=100, tol=1e-12, seed=SEED).fit(df)
    s = summary(model)
    weights = [float(w) for w in model.weights]
    low = min(range(2), key=lambda i: float(model.gaussians[i].mean[0]))
    order = F.when(F.monotonically_increasing_id() == low, 0).otherwise(1)  # two rows in the model's order
    state = attribute(model, "gaussians_df").coalesce(1).select(order.alias("component"), rounded(F.col("mean")[0], 4).alias("mean"), rounded(F.col("cov")[0], 4).alias("variance"))
    sure = attribute(s, "probability")
    sure = sure.select((F.array_max(sure.columns[0]) > 1 - 1e-9).alias("sure")).agg(F.bool_and("sure").alias("sure"))
    share = F.when(F.col("component") == 0, weights[low]).otherwise(weights[1 - low])
    return state.join(sure, F.lit(True)).withColumns({"weight": rounded(share), "log_likelihood": rounded(F.lit(float(s.logLikelihood)), 1)})


def _agreement(df, told: Column, own: Column):
    off = F.abs(told - own) / (1 + F.abs(told))
    return df.agg(F.count("*").alias("n"), (F.max(off) < 1e-9).alias("agree"))


@query("SELECT count(*) AS n, true AS agree FROM embeddings")
def factorization_state(spark, sf):
    """Intercept, weights and factors give the machine's predictions: pairs as half a square less squares."""
    df = embedded(spark, sf)
    model = regression.fm_regressor(factor_size=3, step_size=0.05, max_iter=10, seed=SEED).fit(df)
    x = vector_to_array(F.col("features"))
    weights = [float(w) for w in attribute(model, "linear").orderBy("idx").toPandas()["value"]]  # a number a feature
    factors = {(r.i, r.j): r.value for r in attribute(model, "factors").collect()}  # a few numbers a feature
    linear = F.aggregate(F.zip_with(x, F.array(*map(F.lit, weights)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    pairs = F.lit(0.0)
    for j in range(3):
        terms = F.zip_with(x, F.array(*[F.lit(factors[i, j]) for i in range(len(weights))]), lambda a, b: a * b)
        total = F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)
        pairs = pairs + (total * total - F.aggregate(terms, F.lit(0.0), lambda s, v: s + v * v)) / 2
    (intercept,) = attribute(model, "intercept").first()
    return _agreement(model.transform(df), F.col("prediction"), F.lit(intercept) + linear + pairs)


@query("SELECT count(*) AS n, true AS agree FROM embeddings")
def perceptron_state(spark, sf):
    """The weights, layer by layer, give the net's raw scores."""
    layers = [64, 3, 10]
    df = embedded(spark, sf)
    model = classification.multilayer_perceptron_classifier(layers=layers, max_iter=10, seed=SEED).fit(df)
    w = [float(v) for v in attribute(model, "weights").orderBy("idx").toPandas()["value"]]  # a number an edge of the net
    at, inputs = 0, [vector_to_array(F.col("features"))[i] for i in range(64)]
    for depth, (a, b) in enumerate(zip(layers, layers[1:])):
        # a layer is a matrix by columns, then an offset for each of its outputs
        outputs = []
        for k in range(b):
            total = F.lit(w[at + a * b + k])
            for i in range(a):
                total = total + F.lit(w[at + i * b + k]) * inputs[i]
            outputs.append(total)
        at += a * b + b
        if depth + 2 < len(layers):
            df = df.select("features", "label", *[(1 / (1 + F.exp(-o))).alias(f"h{k}") for k, o in enumerate(outputs)])
            inputs = [F.col(f"h{k}") for k in range(b)]
    df = df.select("features", "label", F.array(*outputs).alias("own"))
    scored = model.transform(df).withColumn("raw", vector_to_array("rawPrediction"))
    off = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.abs(F.col("raw")[i] - F.col("own")[i])))
    return scored.agg(F.count("*").alias("n"), (F.max(off) < 1e-6).alias("agree"))


@query("SELECT count(*) AS n, true AS agree, true AS rising FROM documents")
def survival_quantiles(spark, sf):
    """The p-th quantile is the prediction times the p-th quantile of a unit lifetime, to the scale's power."""
    shares = [0.25, 0.5, 0.75]
    df = assemble(_lifetimes(spark, sf), ["size"], keep=["doc_id", "label", "censor"])
    model = regression.aft_survival_regression(quantile_probabilities=shares, quantiles_col="quantiles").fit(df)
    (scale,) = attribute(model, "scale").first()
    out = model.transform(df).withColumn("q", vector_to_array("quantiles"))
    off = F.greatest(*[
        F.abs(F.col("q")[i] / (F.col("prediction") * F.lit(math.exp(scale * math.log(-math.log1p(-p))))) - 1) for i, p in enumerate(shares)])
    return out.agg(
        F.count("*").alias("n"), (F.max(off) < 1e-9).alias("agree"),
        F.bool_and((F.col("q")[0] < F.col("q")[1]) & (F.col("q")[1] < F.col("q")[2])).alias("rising"))


@query("""
SELECT count(*) AS n, 4::BIGINT AS clusters, true AS nearest, true AS centres_of_their_own FROM embeddings""")
def k_means_cosine(spark, sf):
    """By angle: every row is in the cluster whose centre it has the largest cosine with."""
    df = embedded(spark, sf)
    model = clustering.k_means(k=4, distance_measure="cosine", max_iter=30, seed=SEED).fit(df)
    cells = {(r.i, r.j): r.value for r in attribute(model, "cluster_center_matrix").collect()}  # k rows
    x = vector_to_array(F.col("features"))
    near = []
    for c in range(4):
        centre = [cells[c, i] for i in range(64)]
        size = math.sqrt(sum(v * v for v in centre))
        dot = F.aggregate(F.zip_with(x, F.array(*[F.lit(v / size) for v in centre]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        near.append(dot)
    told = F.array(*near)
    out = model.transform(df)
    return out.agg(
        F.count("*").alias("n"), F.count_distinct("prediction").alias("clusters"),
        F.bool_and(told[F.col("prediction")] >= F.array_max(told) - 1e-9).alias("nearest"),
    ).withColumn("centres_of_their_own", F.lit(len({tuple(round(cells[c, i], 9) for i in range(64)) for c in range(4)}) == 4))
