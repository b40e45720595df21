"""Classifiers and regressors, trained on whole tables.

Where a model's optimum has a closed form on the data it is given (one indicator per
group, one feature, a tree deep enough to part every value) SQL repeats it. The others
are checked by invariants in the tests.
"""

from pyspark.sql import functions as F

from ..functions.tables import attribute, trees
from ..functions.vectors import assemble, components, vector_to_array
from ..operators import classification, feature, regression
from ..plans.curves import by_threshold, precision_recall, roc, score_counts
from ..plans.scoring import columns, score
from ..plans.verbs import evaluate_model, pipeline, summary
from ..session import checkpoint_root, scratch_path
from ..sources import load, save, spread, table
from .inputs import TEXT_SIZES_SQL, WORDS_SQL, embedded, text_sizes, words
from .registry import query, round_all, rounded

SEED = 42
NUMBERS = range(1, 8)  # the line numbers of an order in the test tables
DUMMIES = [f"n{i}" for i in range(2, 8)]


# line numbers against return flags ----------------------------------------------------


def _line_classes(spark, sf):
    """(line, label): label 0, 1, 2 for the flags A, N, R."""
    df = table(spark, sf, "lineitem", ["l_linenumber", "l_returnflag", "l_extendedprice"])
    return spread(df, "l_extendedprice").select(
        F.col("l_linenumber").cast("double").alias("line"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0)
        .otherwise(2.0).alias("label"),
    )


def _line_dummies(df):
    """One indicator per line number but the first: a saturated design."""
    return df.select("*", *[(F.col("line") == i).cast("double").alias(f"n{i}") for i in NUMBERS[1:]])


def _pooled(df, *columns_):
    """Equal rows as one with their number as its weight: the same optimum from a handful
    of rows, combined before the shuffle."""
    return df.groupBy(*columns_).agg(F.count("*").cast("double").alias("weight"))


def _by_line(scored, *columns_):
    """The scored value of each line number: rows of one number share it."""
    return scored.groupBy("line").agg(*[F.max(c).alias(c) for c in columns_], F.count("*").alias("n"))


MAJORITY_SQL = """
WITH c AS (SELECT l_linenumber::DOUBLE AS line, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label,
                  count(*) AS k FROM lineitem GROUP BY ALL)
SELECT line, arg_max(label, k)::DOUBLE AS prediction, sum(k)::BIGINT AS n FROM c GROUP BY line"""

SHARE_SQL = """
SELECT l_linenumber::DOUBLE AS line, round(avg((l_returnflag = 'A')::INT), 4) AS probability_0,
       round(avg((l_returnflag = 'N')::INT), 4) AS probability_1,
       round(avg((l_returnflag = 'R')::INT), 4) AS probability_2, count(*) AS n
FROM lineitem GROUP BY l_linenumber"""

MEAN_SQL = """
SELECT l_linenumber::DOUBLE AS line, round(avg(l_extendedprice), 4) AS prediction, count(*) AS n
FROM lineitem GROUP BY l_linenumber"""


@query(MAJORITY_SQL)
def decision_tree_classifier(spark, sf):
    """Deep enough to part every line number, so a leaf answers the majority of one."""
    df = assemble(_line_classes(spark, sf), ["line"], keep=["line", "label"])
    model = classification.decision_tree_classifier(max_depth=10, seed=SEED).fit(df)
    return _by_line(model.transform(df), "prediction")


@query(MAJORITY_SQL)
def random_forest_classifier(spark, sf):
    """Every tree on all rows and features, so all of them agree."""
    checkpoint_root(spark)
    df = assemble(_line_classes(spark, sf), ["line"], keep=["line", "label"])
    op = classification.random_forest_classifier(
        num_trees=3, max_depth=10, bootstrap=False, feature_subset_strategy="all", seed=SEED
    )
    return _by_line(op.fit(df).transform(df), "prediction")


@query("""
SELECT l_linenumber::DOUBLE AS line,
       round(1 / (1 + exp(-2 * (2 * avg((l_returnflag = 'R')::INT) - 1))), 6) AS probability, count(*) AS n
FROM lineitem GROUP BY l_linenumber""")
def gbt_classifier(spark, sf):
    """The first tree of a boosted classifier: the mean of the signed label, through the link."""
    df = _line_classes(spark, sf).withColumn("label", (F.col("label") == 2).cast("double"))
    df = assemble(df, ["line"], keep=["line", "label"])
    model = classification.gbt_classifier(max_iter=1, max_depth=10, seed=SEED).fit(df)
    scored = model.transform(df).withColumn("probability", rounded(vector_to_array("probability")[1]))
    return _by_line(scored, "probability")


@query(SHARE_SQL)
def logistic_regression(spark, sf):
    """Multinomial and saturated: the fitted probabilities are the shares of the groups."""
    df = _line_classes(spark, sf)
    op = classification.logistic_regression(max_iter=200, tol=1e-12, weight_col="weight")
    pooled = _line_dummies(_pooled(df, "line", "label"))
    model = op.fit(assemble(pooled, DUMMIES, keep=["label", "weight"]))
    names = [f"probability_{i}" for i in range(3)]
    out = score(model, _line_dummies(df), DUMMIES, ["line"])
    return round_all(_by_line(out, *names), names, 4)


@query("""
SELECT l_linenumber::DOUBLE AS line, round(avg((l_returnflag = 'R')::INT), 4) AS probability_1, count(*) AS n
FROM lineitem GROUP BY l_linenumber""")
def logistic_regression_binomial(spark, sf):
    df = _line_classes(spark, sf).withColumn("label", (F.col("label") == 2).cast("double"))
    op = classification.logistic_regression(max_iter=200, tol=1e-12, family="binomial", weight_col="weight")
    pooled = _line_dummies(_pooled(df, "line", "label"))
    model = op.fit(assemble(pooled, DUMMIES, keep=["label", "weight"]))
    return round_all(_by_line(score(model, _line_dummies(df), DUMMIES, ["line"]), "probability_1"), ["probability_1"], 4)


@query(MEAN_SQL)
def decision_tree_regressor(spark, sf):
    df = assemble(_line_classes(spark, sf), ["line"], keep=["line", "price"])
    model = regression.decision_tree_regressor(label_col="price", max_depth=10, seed=SEED).fit(df)
    return round_all(_by_line(model.transform(df), "prediction"), ["prediction"], 4)


@query(MEAN_SQL)
def random_forest_regressor(spark, sf):
    checkpoint_root(spark)
    df = assemble(_line_classes(spark, sf), ["line"], keep=["line", "price"])
    op = regression.random_forest_regressor(
        label_col="price", num_trees=3, max_depth=10, bootstrap=False, feature_subset_strategy="all", seed=SEED
    )
    return round_all(_by_line(op.fit(df).transform(df), "prediction"), ["prediction"], 4)


@query(MEAN_SQL)
def gbt_regressor(spark, sf):
    """The first tree reaches the group means; later ones find nothing to correct."""
    checkpoint_root(spark)
    df = assemble(_line_classes(spark, sf), ["line"], keep=["line", "price"])
    model = regression.gbt_regressor(label_col="price", max_iter=2, max_depth=10, seed=SEED).fit(df)
    return round_all(_by_line(model.transform(df), "prediction"), ["prediction"], 4)


@query("""
WITH g AS (SELECT l_linenumber, var_pop(l_extendedprice) * count(*) AS sse, count(*) AS n FROM lineitem GROUP BY 1)
SELECT unnest([0, 1])::INT AS idx, round(sum(sse) / sum(n) / 1e6, 6) AS value FROM g""")
def gbt_loss_by_iteration(spark, sf):
    checkpoint_root(spark)
    df = assemble(_line_classes(spark, sf), ["line"], keep=["price"])
    model = regression.gbt_regressor(label_col="price", max_iter=2, max_depth=10, seed=SEED).fit(df)
    losses = attribute(model, "evaluate_each_iteration", df, "squared")
    return losses.select("idx", rounded(F.col("value") / 1e6).alias("value"))


@query("""
SELECT 1.0::DOUBLE AS importance, (2 * count(DISTINCT l_linenumber) - 1)::BIGINT AS num_nodes FROM lineitem""")
def tree_shape(spark, sf):
    """Importances and size of a tree with a leaf per line number."""
    df = assemble(_line_classes(spark, sf), ["line"], keep=["price"])
    model = regression.decision_tree_regressor(label_col="price", max_depth=10, seed=SEED).fit(df)
    importance = attribute(model, "feature_importances").select(F.lit(1).alias("one"), rounded("value").alias("importance"))
    return importance.join(attribute(model, "num_nodes").withColumn("one", F.lit(1)), "one").drop("one")


# embeddings against labels ------------------------------------------------------------


def _confusion(scored):
    return scored.groupBy("label", "prediction").agg(F.count("*").alias("n"))


@query()
def random_forest_members(spark, sf):
    """One row per tree of a bagged forest on the embeddings."""
    checkpoint_root(spark)
    model = classification.random_forest_classifier(num_trees=8, seed=SEED).fit(embedded(spark, sf))
    return trees(model)


@query()
def multilayer_perceptron_classifier(spark, sf):
    df = embedded(spark, sf)
    op = classification.multilayer_perceptron_classifier(layers=[64, 16, 10], max_iter=60, seed=SEED)
    return _confusion(op.fit(df).transform(df))


@query()
def multilayer_perceptron_weights(spark, sf):
    op = classification.multilayer_perceptron_classifier(layers=[64, 16, 10], max_iter=20, seed=SEED)
    return attribute(op.fit(embedded(spark, sf)), "weights")


def _halved(spark, sf):
    """embeddings with labels below five against the rest."""
    return embedded(spark, sf).withColumn("label", (F.col("label") < 5).cast("double"))


@query()
def linear_svc(spark, sf):
    df = _halved(spark, sf)
    return _confusion(classification.linear_svc(max_iter=50, reg_param=0.01).fit(df).transform(df))


@query()
def fm_classifier(spark, sf):
    df = _halved(spark, sf)
    op = classification.fm_classifier(factor_size=4, step_size=0.1, max_iter=50, seed=SEED)
    return _confusion(op.fit(df).transform(df))


@query()
def fm_factors(spark, sf):
    op = classification.fm_classifier(factor_size=4, step_size=0.05, max_iter=20, seed=SEED)
    return attribute(op.fit(_halved(spark, sf)), "factors")


@query()
def logistic_regression_bounded(spark, sf):
    """Coefficients held at or above zero; the table shows what is left of them."""
    from pyspark.ml.linalg import Matrices, Vectors

    op = classification.logistic_regression(
        max_iter=50, lower_bounds_on_coefficients=Matrices.dense(1, 64, [0.0] * 64),
        lower_bounds_on_intercepts=Vectors.dense([-10.0]),
    )
    return attribute(op.fit(_halved(spark, sf)), "coefficients")


# words against judgements -------------------------------------------------------------

#: Every word of the judged texts takes part. Sums over words are taken sparsely: a text's words only.
NB_SQL = f"""
WITH w AS (SELECT doc_id, quality AS y, {WORDS_SQL} AS w FROM documents JOIN labels USING (doc_id)),
x AS (SELECT doc_id, y, term, count(*)::DOUBLE AS x FROM (SELECT doc_id, y, unnest(w) AS term FROM w) GROUP BY ALL),
v AS (SELECT count(DISTINCT term) AS k FROM x),
pi AS (SELECT y AS i, ln((count(*) + 1) / ((SELECT count(*) FROM w) + 2.0)) AS v FROM w GROUP BY y),
terms AS (SELECT DISTINCT term FROM x), classes AS (SELECT DISTINCT y AS i FROM w),
"""
COUNTS_SQL = NB_SQL + """
c AS (SELECT y AS i, term, sum(x) AS s FROM x GROUP BY y, term),
ss AS (SELECT i, sum(s) AS ss FROM c GROUP BY i),
theta AS (SELECT i, term, ln((coalesce(s, 0) + 1) / (ss + k)) AS v
          FROM classes JOIN terms ON true JOIN ss USING (i) JOIN v ON true LEFT JOIN c USING (i, term))
"""
SCORED_SQL = """
, s AS (SELECT x.doc_id, theta.i, sum(x.x * theta.v) AS part FROM x JOIN theta ON theta.term = x.term GROUP BY ALL),
r AS (SELECT w.doc_id, pi.i, pi.v + coalesce(s.part, 0) AS raw FROM w JOIN pi ON true LEFT JOIN s ON s.doc_id = w.doc_id AND s.i = pi.i)
SELECT doc_id, (CASE WHEN max(raw) FILTER (i = 0) >= max(raw) FILTER (i = 1) THEN 0 ELSE 1 END)::DOUBLE AS prediction,
       round(max(raw) FILTER (i = 0), 4) AS raw_0, round(max(raw) FILTER (i = 1), 4) AS raw_1
FROM r GROUP BY doc_id"""


def _judged_terms(spark, sf, binary: bool = False):
    """Judged texts as counts of all their words, and the words in the order of the counts."""
    labels = table(spark, sf, "labels", ["doc_id", "quality"])
    df = words(spark, sf).join(labels, "doc_id")
    counter = feature.count_vectorizer(input_col="words", output_col="features", binary=binary, min_df=1.0, vocab_size=2**31 - 1).fit(df)
    counted = counter.transform(df).select("doc_id", "features", F.col("quality").cast("double").alias("label"))
    return counted, attribute(counter, "vocabulary").select(F.col("idx").alias("j"), F.col("value").alias("term"))


def _bayes_scores(spark, sf, model_type: str):
    df, _ = _judged_terms(spark, sf, model_type == "bernoulli")
    model = classification.naive_bayes(model_type=model_type).fit(df)
    out = model.transform(df).select("doc_id", "prediction", *components("rawPrediction", ["raw_0", "raw_1"]))
    return round_all(out, ["raw_0", "raw_1"], 4)


@query(COUNTS_SQL + SCORED_SQL)
def naive_bayes(spark, sf):
    """Quality by the counts of all words."""
    return _bayes_scores(spark, sf, "multinomial")


@query(NB_SQL + """
c AS (SELECT y AS i, term, count(*) AS s FROM x GROUP BY y, term), n AS (SELECT y AS i, count(*) AS n FROM w GROUP BY y),
p AS (SELECT i, term, (coalesce(s, 0) + 1) / (n + 2.0) AS p FROM classes JOIN terms ON true JOIN n USING (i) LEFT JOIN c USING (i, term)),
none AS (SELECT i, sum(ln(1 - p)) AS none FROM p GROUP BY i),
s AS (SELECT x.doc_id, p.i, sum(ln(p.p) - ln(1 - p.p)) AS part FROM x JOIN p ON p.term = x.term GROUP BY ALL),
r AS (SELECT w.doc_id, pi.i, pi.v + none + coalesce(s.part, 0) AS raw FROM w JOIN pi ON true JOIN none USING (i)
      LEFT JOIN s ON s.doc_id = w.doc_id AND s.i = pi.i)
SELECT doc_id, (CASE WHEN max(raw) FILTER (i = 0) >= max(raw) FILTER (i = 1) THEN 0 ELSE 1 END)::DOUBLE AS prediction,
       round(max(raw) FILTER (i = 0), 4) AS raw_0, round(max(raw) FILTER (i = 1), 4) AS raw_1
FROM r GROUP BY doc_id""")
def naive_bayes_bernoulli(spark, sf):
    """Quality by which words are there and which are not."""
    return _bayes_scores(spark, sf, "bernoulli")


@query(NB_SQL + """
c AS (SELECT y AS i, term, sum(x) AS s FROM x GROUP BY y, term), t AS (SELECT term, sum(s) AS s FROM c GROUP BY term),
o AS (SELECT i, term, t.s - coalesce(c.s, 0) + 1 AS o FROM classes JOIN t ON true LEFT JOIN c USING (i, term)),
l AS (SELECT i, term, ln(o / sum(o) OVER (PARTITION BY i)) AS l FROM o),
s AS (SELECT x.doc_id, l.i, sum(x.x * -l.l) AS part FROM x JOIN l ON l.term = x.term GROUP BY ALL),
z AS (SELECT w.doc_id, coalesce(max(part) FILTER (s.i = 0), 0) AS a, coalesce(max(part) FILTER (s.i = 1), 0) AS b
      FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
n AS (SELECT doc_id, a, b, greatest(a, b) + ln(1 + exp(-abs(a - b))) AS n FROM z)
SELECT doc_id, round(a - n, 4) + 0.0 AS raw_0, round(b - n, 4) + 0.0 AS raw_1 FROM n""")
def naive_bayes_complement(spark, sf):
    """Each class by the words of all others."""
    df, _ = _judged_terms(spark, sf)
    out = classification.naive_bayes(model_type="complement").fit(df).transform(df)
    return round_all(out.select("doc_id", *components("rawPrediction", ["raw_0", "raw_1"])), ["raw_0", "raw_1"], 4)


@query(COUNTS_SQL + "SELECT i::INT AS i, term, round(v, 8) AS value FROM theta")
def naive_bayes_theta(spark, sf):
    df, terms = _judged_terms(spark, sf)
    theta = attribute(classification.naive_bayes().fit(df), "theta")
    return round_all(theta.join(terms, "j").select("i", "term", "value"), ["value"], 8)


@query(NB_SQL + "one AS (SELECT 1) SELECT i::INT AS idx, round(v, 8) AS value FROM pi")
def naive_bayes_prior(spark, sf):
    df, _ = _judged_terms(spark, sf)
    return round_all(attribute(classification.naive_bayes().fit(df), "pi"), ["value"], 8)


@query("""
WITH v AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS i, unnest([0, 1])::INT AS j,
                  unnest([l_quantity, l_extendedprice / 1000]) AS x FROM lineitem)
SELECT i::INT AS i, j, round(avg(x), 6) AS mean, round(var_pop(x), 4) AS variance FROM v GROUP BY i, j""")
def naive_bayes_gaussian(spark, sf):
    """Means and variances by class."""
    df = table(spark, sf, "lineitem", ["l_quantity", "l_extendedprice", "l_returnflag"]).select(
        "l_quantity", (F.col("l_extendedprice") / 1000).alias("p"),
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("label"),
    )
    model = classification.naive_bayes(model_type="gaussian").fit(assemble(df, ["l_quantity", "p"], keep=["label"]))
    theta = attribute(model, "theta").withColumnRenamed("value", "mean")
    sigma = attribute(model, "sigma").withColumnRenamed("value", "variance")
    return theta.join(sigma, ["i", "j"]).select("i", "j", rounded("mean").alias("mean"), rounded("variance", 4).alias("variance"))


# words against characters -------------------------------------------------------------


def _sized(spark, sf, inputs=("n_words",)):
    return assemble(text_sizes(spark, sf), list(inputs), keep=["doc_id", "n_words", "n_chars", "lang"])


LINE_SQL = f"""
WITH d AS ({TEXT_SIZES_SQL}),
f AS (SELECT regr_slope(n_chars, n_words) AS b, regr_intercept(n_chars, n_words) AS a FROM d)
"""


@query(LINE_SQL + "SELECT doc_id, round(a + b * n_words, 4) AS prediction FROM d, f")
def linear_regression(spark, sf):
    """One feature by the normal equations; scored as an expression on the counts."""
    df = text_sizes(spark, sf)
    op = regression.linear_regression(label_col="n_chars", solver="normal")
    model = op.fit(assemble(df, ["n_words"], keep=["n_chars"]))
    return round_all(score(model, df, ["n_words"], ["doc_id"]), ["prediction"], 4)


@query(LINE_SQL + "SELECT round(b, 6) AS coefficient, round(a, 4) AS intercept FROM f")
def linear_regression_weights(spark, sf):
    op = regression.linear_regression(label_col="n_chars", solver="normal")
    model = op.fit(_sized(spark, sf))
    slope = attribute(model, "coefficients").select(F.col("value").alias("coefficient"), F.lit(1).alias("one"))
    start = attribute(model, "intercept").withColumn("one", F.lit(1))
    return slope.join(start, "one").select(
        rounded("coefficient").alias("coefficient"), rounded("intercept", 4).alias("intercept")
    )


@query(LINE_SQL + """
, r AS (SELECT n_chars - a - b * n_words AS e, n_chars AS y, n_words AS x FROM d, f),
s AS (SELECT sum(e * e) AS sse, sum(abs(e)) AS sae, count(*) AS n, var_pop(y) * count(*) AS sst,
             var_pop(x) * count(*) AS sxx FROM r)
SELECT round(1 - sse / sst, 8) AS r2, round(1 - (sse / (n - 2)) / (sst / (n - 1)), 8) AS r2adj,
       round(sqrt(sse / n), 6) AS rmse, round(sae / n, 6) AS mae, round(sqrt(sse / (n - 2) / sxx), 8) AS std_error,
       (n - 2)::BIGINT AS dof, n::BIGINT AS rows FROM s""")
def linear_regression_summary(spark, sf):
    """Training metrics, with the standard error of the slope from the normal solver."""
    op = regression.linear_regression(label_col="n_chars", solver="normal")
    s = summary(op.fit(_sized(spark, sf)))
    parts = {
        "r2": (s.r2, 8), "r2adj": (s.r2adj, 8), "rmse": (s.rootMeanSquaredError, 6),
        "mae": (s.meanAbsoluteError, 6), "std_error": (s.coefficientStandardErrors[0], 8),
    }
    one = spark.range(1)
    return one.select(
        *[rounded(F.lit(float(v)), d).alias(n) for n, (v, d) in parts.items()],
        F.lit(int(s.degreesOfFreedom)).cast("bigint").alias("dof"), F.lit(int(s.numInstances)).cast("bigint").alias("rows"),
    )


@query(LINE_SQL + "SELECT round(n_chars - a - b * n_words, 4) + 0.0 AS residuals FROM d, f")
def linear_regression_residuals(spark, sf):
    op = regression.linear_regression(label_col="n_chars", solver="normal")
    return round_all(attribute(summary(op.fit(_sized(spark, sf))), "residuals"), ["residuals"], 4)


@query(f"""
WITH d AS ({TEXT_SIZES_SQL}),
f AS (SELECT regr_slope(n_chars, n_words) FILTER (doc_id % 3 <> 0) AS b,
             regr_intercept(n_chars, n_words) FILTER (doc_id % 3 <> 0) AS a FROM d),
r AS (SELECT n_chars - a - b * n_words AS e, n_chars AS y FROM d, f WHERE doc_id % 3 = 0)
SELECT round(1 - sum(e * e) / (var_pop(y) * count(*)), 8) AS r2, round(sqrt(avg(e * e)), 6) AS rmse FROM r""")
def evaluation_on_new_data(spark, sf):
    """A model fitted on two thirds of the documents and judged on the others."""
    df = _sized(spark, sf)
    op = regression.linear_regression(label_col="n_chars", solver="normal")
    s = evaluate_model(op.fit(df.filter("doc_id % 3 <> 0")), df.filter("doc_id % 3 = 0"))
    return spark.range(1).select(
        rounded(F.lit(s.r2), 8).alias("r2"), rounded(F.lit(s.rootMeanSquaredError)).alias("rmse")
    )


@query()
def linear_regression_huber(spark, sf):
    op = regression.linear_regression(label_col="n_chars", loss="huber", epsilon=1.5, max_iter=100)
    model = op.fit(_sized(spark, sf))
    return attribute(model, "scale")


GLM_SQL = f"WITH d AS ({TEXT_SIZES_SQL}) SELECT lang, round(avg(n_words), 3) AS prediction, count(*) AS n FROM d%s GROUP BY lang"
LANGS = ["de", "es", "fr"]


def _lang_dummies(df):
    return df.select("*", *[(F.col("lang") == c).cast("double").alias(c) for c in LANGS])


def _glm_query(name, expression="n_words", **params):
    """Saturated in the language: whatever family and link, the fit is the group mean."""

    positive = params["family"] == "gamma"  # has no place for a zero

    def run(spark, sf):
        df = text_sizes(spark, sf, some=positive)
        # equal rows once, with their number: the fit goes over them many times
        pooled = _lang_dummies(df.groupBy("lang", "n_words").agg(F.count("*").cast("double").alias("weight")))
        op = regression.generalized_linear_regression(
            label_col="n_words", weight_col="weight", max_iter=100, tol=1e-10, **params
        )
        model = op.fit(assemble(pooled, LANGS, keep=["n_words", "weight"]))
        if params["family"] == "tweedie":
            scored = model.transform(assemble(pooled, LANGS, keep=["lang", "weight"]))
        else:
            scored = score(model, pooled, LANGS, ["lang", "weight"])
        out = scored.groupBy("lang").agg(F.max("prediction").alias("prediction"), F.sum("weight").cast("bigint").alias("n"))
        return round_all(out, ["prediction"], 3)

    query(GLM_SQL % (" WHERE n_words > 0" if positive else ""), name=name)(run)


_glm_query("generalized_linear_regression", family="gaussian", link="identity")
_glm_query("generalized_linear_regression_poisson", family="poisson", link="log")
_glm_query("generalized_linear_regression_gamma", family="gamma", link="log")
_glm_query("generalized_linear_regression_tweedie", family="tweedie", variance_power=1.5, link_power=0.0)


@query(f"""
WITH d AS ({TEXT_SIZES_SQL})
SELECT lang, round(avg((n_words > 100)::INT), 4) AS prediction, count(*) AS n FROM d GROUP BY lang""")
def generalized_linear_regression_binomial(spark, sf):
    df = _lang_dummies(text_sizes(spark, sf)).withColumn("long", (F.col("n_words") > 100).cast("double"))
    op = regression.generalized_linear_regression(
        label_col="long", family="binomial", link="logit", max_iter=100, tol=1e-10
    )
    model = op.fit(assemble(df, LANGS, keep=["long"]))
    scored = score(model, df, LANGS, ["lang"])
    out = scored.groupBy("lang").agg(F.max("prediction").alias("prediction"), F.count("*").alias("n"))
    return round_all(out, ["prediction"], 4)


@query(LINE_SQL + """
, s AS (SELECT sum(pow(n_chars - a - b * n_words, 2)) AS sse, var_pop(n_chars) * count(*) AS sst, count(*) AS n FROM d, f)
SELECT round(sse / 1e6, 6) AS deviance, round(sst / 1e6, 6) AS null_deviance, round(sse / (n - 2), 4) AS dispersion,
       (n - 2)::BIGINT AS dof, 2::BIGINT AS rank FROM s""")
def generalized_linear_regression_summary(spark, sf):
    model = regression.generalized_linear_regression(label_col="n_chars").fit(_sized(spark, sf))
    s = summary(model)
    return spark.range(1).select(
        rounded(F.lit(s.deviance / 1e6)).alias("deviance"),
        rounded(F.lit(s.nullDeviance / 1e6)).alias("null_deviance"),
        rounded(F.lit(s.dispersion), 4).alias("dispersion"),
        F.lit(s.residualDegreeOfFreedom).cast("bigint").alias("dof"), F.lit(s.rank).cast("bigint").alias("rank"),
    )


@query(LINE_SQL + """
, s AS (SELECT sqrt(sum(pow(n_chars - a - b * n_words, 2)) / (count(*) - 2)) AS sd, var_pop(n_words) * count(*) AS sxx,
               avg(n_words) AS mx, count(*) AS n FROM d, f)
SELECT unnest(['0', '(intercept)']) AS feature, round(unnest([b, a]), 4) AS coefficient,
       round(unnest([sd / sqrt(sxx), sd * sqrt(1.0 / n + mx * mx / sxx)]), 6) AS std_error FROM s, f""")
def generalized_linear_regression_coefficients(spark, sf):
    model = regression.generalized_linear_regression(label_col="n_chars").fit(_sized(spark, sf))
    out = attribute(model, "coefficients_with_statistics")
    return out.select("feature", rounded("coefficient", 4).alias("coefficient"), rounded("std_error").alias("std_error"))


def poisson_summary(spark, sf, tol):
    """What a poisson fit of the number of words, saturated in the language, says of every document.

    Texts are cut once and the fit goes over equal rows pooled with their number, not over all texts at every step.
    """
    checkpoint_root(spark)
    sizes = text_sizes(spark, sf).select("lang", "n_words").checkpoint()
    pooled = _lang_dummies(sizes.groupBy("lang", "n_words").agg(F.count("*").cast("double").alias("weight")))
    op = regression.generalized_linear_regression(
        label_col="n_words", weight_col="weight", family="poisson", max_iter=100, tol=tol)
    model = op.fit(assemble(pooled, LANGS, keep=["n_words", "weight"]).persist())
    every = _lang_dummies(sizes.withColumn("weight", F.lit(1.0)))
    return evaluate_model(model, assemble(every, LANGS, keep=["n_words", "weight"]))


@query(f"""
WITH d AS ({TEXT_SIZES_SQL}), m AS (SELECT lang, avg(n_words) AS m FROM d GROUP BY lang)
SELECT round((n_words - m) / sqrt(m), 4) + 0.0 AS residual FROM d JOIN m USING (lang)""")
def generalized_linear_regression_residuals(spark, sf):
    """Pearson residuals of a poisson fit."""
    s = poisson_summary(spark, sf, 1e-10)
    residuals = attribute(s, "residuals", "pearson")
    return residuals.select(rounded(F.col(residuals.columns[0]), 4).alias("residual"))


@query("""
WITH g AS (SELECT l_quantity AS x, avg(l_extendedprice) AS m, count(*)::DOUBLE AS w FROM lineitem GROUP BY 1),
c AS (SELECT x, w, sum(w) OVER o AS cw, sum(w * m) OVER o AS cs, w * m AS wm FROM g WINDOW o AS (ORDER BY x)),
b AS (SELECT lo.x AS lo, hi.x AS hi, (hi.cs - lo.cs + lo.wm) / (hi.cw - lo.cw + lo.w) AS a FROM c lo JOIN c hi ON lo.x <= hi.x),
i AS (SELECT c.x, lo, min(a) AS v FROM c JOIN b ON lo <= c.x AND hi >= c.x GROUP BY c.x, lo)
SELECT x AS l_quantity, round(max(v), 4) AS prediction FROM i GROUP BY x""")
def isotonic_regression(spark, sf):
    """The largest over starts of the smallest mean over ends, by quantity."""
    df = table(spark, sf, "lineitem", ["l_quantity", "l_extendedprice"])
    op = regression.isotonic_regression(features_col="l_quantity", label_col="l_extendedprice")
    # equal quantities pool anyway: a row per quantity, weighted by its count, is the same fit
    pooled = df.groupBy("l_quantity").agg(
        F.avg("l_extendedprice").alias("l_extendedprice"), F.count("*").cast("double").alias("w")
    )
    model = op.setWeightCol("w").fit(pooled)
    return round_all(model.transform(pooled).select("l_quantity", "prediction"), ["prediction"], 4)


@query()
def isotonic_boundaries(spark, sf):
    df = text_sizes(spark, sf).groupBy("n_words").agg(F.avg("n_chars").alias("n_chars"), F.count("*").cast("double").alias("w"))
    op = regression.isotonic_regression(features_col="n_words", label_col="n_chars", weight_col="w")
    model = op.fit(df)
    xs = attribute(model, "boundaries").withColumnRenamed("value", "boundary")
    return xs.join(attribute(model, "predictions"), "idx")


def _lifetimes(spark, sf):
    """documents as lifetimes: words until the end, one in three cut off."""
    return text_sizes(spark, sf).select(
        "doc_id", (F.col("n_words") + 1.0).alias("label"), (F.col("doc_id") % 3 > 0).cast("double").alias("censor"),
        (F.col("n_chars") / 1000.0).alias("size"),
    )


@query()
def aft_survival_regression(spark, sf):
    df = assemble(_lifetimes(spark, sf), ["size"], keep=["doc_id", "label", "censor"])
    op = regression.aft_survival_regression(quantile_probabilities=[0.25, 0.5, 0.75], quantiles_col="quantiles")
    out = op.fit(df).transform(df)
    return out.select("doc_id", "prediction", vector_to_array("quantiles").alias("quantiles"))


@query()
def fm_regressor(spark, sf):
    df = text_sizes(spark, sf).select(
        "doc_id", (F.col("n_words") / 1000.0).alias("w"), (F.col("n_chars") / 1000.0).alias("label")
    )
    df = assemble(df, ["w"], keep=["doc_id", "label"])
    op = regression.fm_regressor(factor_size=2, step_size=0.2, max_iter=60, seed=SEED)
    return op.fit(df).transform(df).select("doc_id", "label", "prediction")


# summaries of classifiers -------------------------------------------------------------


@query("""
WITH c AS (SELECT l_linenumber AS line, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label,
                  count(*)::DOUBLE AS k FROM lineitem GROUP BY ALL),
p AS (SELECT *, arg_max(label, k) OVER (PARTITION BY line) AS pred FROM c),
a AS (SELECT label, sum(k) AS actual, coalesce(sum(k) FILTER (pred = label), 0) AS tp FROM p GROUP BY label),
s AS (SELECT pred AS label, sum(k) AS said FROM p GROUP BY pred)
SELECT label::INT AS idx, round(coalesce(tp / said, 0), 6) AS precision, round(tp / actual, 6) AS recall,
       round((SELECT sum(tp) / sum(actual) FROM a), 6) AS accuracy FROM a LEFT JOIN s USING (label)""")
def classification_summary(spark, sf):
    """Training metrics by label of a multinomial fit."""
    df = _line_dummies(_pooled(_line_classes(spark, sf), "line", "label"))
    op = classification.logistic_regression(max_iter=200, tol=1e-12, weight_col="weight")
    s = summary(op.fit(assemble(df, DUMMIES, keep=["label", "weight"])))
    precision = attribute(s, "precision_by_label").withColumnRenamed("value", "precision")
    recall = attribute(s, "recall_by_label").withColumnRenamed("value", "recall")
    accuracy = s.accuracy
    return precision.join(recall, "idx").select(
        "idx", rounded("precision").alias("precision"), rounded("recall").alias("recall"),
        rounded(F.lit(accuracy)).alias("accuracy"),
    )


CURVE_SQL = f"""
WITH d AS (SELECT n_chars AS x, quality AS y FROM labels JOIN documents USING (doc_id)),
s AS (SELECT sign(corr(x, y)) AS s FROM d),
g AS (SELECT x * s AS x, sum(y) AS p, sum(1 - y) AS n FROM d, s GROUP BY 1),
c AS (SELECT sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS pp, sum(n) OVER () AS nn FROM g
      WINDOW w AS (ORDER BY x DESC))
"""


def _curves(spark, sf):
    labels = table(spark, sf, "labels", ["doc_id", "quality"])
    docs = table(spark, sf, "documents", ["doc_id", "n_chars"])
    df = labels.join(docs, "doc_id").select(
        F.col("quality").cast("double").alias("label"), (F.col("n_chars") / 1000.0).alias("x")
    )
    model = classification.logistic_regression(max_iter=100).fit(assemble(df, ["x"], keep=["label"]))
    # by the margin: probabilities of far scores may round to the same number
    return score_counts(score(model, df, ["x"], ["label"]), "rawPrediction_1", "label")


@query(CURVE_SQL + """
SELECT round(fp / nn, 6) AS "FPR", round(tp / pp, 6) AS "TPR" FROM c UNION ALL SELECT 0, 0 UNION ALL SELECT 1, 1""")
def roc_curve(spark, sf):
    return round_all(roc(_curves(spark, sf)), ["FPR", "TPR"])


@query(CURVE_SQL + """
SELECT round(tp / pp, 6) AS recall, round(tp / (tp + fp), 6) AS precision FROM c
UNION ALL SELECT 0, (SELECT round(tp / (tp + fp), 6) FROM c ORDER BY tp + fp LIMIT 1)""")
def precision_recall_curve(spark, sf):
    return round_all(precision_recall(_curves(spark, sf)), ["recall", "precision"])


@query(CURVE_SQL + """
SELECT round(coalesce(2 * tp / nullif(2 * tp + fp + pp - tp, 0), 0), 6) AS f_measure, round(tp / (tp + fp), 6) AS precision,
       round(tp / pp, 6) AS recall FROM c""")
def threshold_curves(spark, sf):
    """F-measure, precision and recall at every score."""
    return round_all(by_threshold(_curves(spark, sf)).drop("threshold"), ["f_measure", "precision", "recall"])


# staged -------------------------------------------------------------------------------


@query(LINE_SQL + "SELECT doc_id, round(a + b * n_words, 4) AS prediction FROM d, f")
def staged_regression(spark, sf):
    """Assembler, scaler and regression as one staged fit."""
    df = text_sizes(spark, sf)
    stages = pipeline([
        feature.vector_assembler(input_cols=["n_words"], output_col="raw"),
        feature.standard_scaler(input_col="raw", output_col="features", with_mean=True),
        regression.linear_regression(label_col="n_chars", solver="normal"),
    ])
    return round_all(stages.fit(df).transform(df).select("doc_id", "prediction"), ["prediction"], 4)


@query(LINE_SQL + "SELECT doc_id, round(a + b * n_words, 4) AS prediction FROM d, f")
def staged_regression_reloaded(spark, sf):
    """The staged model written to the shared folder, read back and applied."""
    from pyspark.ml import PipelineModel

    df = text_sizes(spark, sf)
    stages = pipeline([
        feature.vector_assembler(input_cols=["n_words"], output_col="features"),
        regression.linear_regression(label_col="n_chars", solver="normal"),
    ])
    path = scratch_path(spark, "staged")
    save(stages.fit(df), path)
    model = load(PipelineModel, path)
    return round_all(model.transform(df).select("doc_id", "prediction"), ["prediction"], 4)


@query("""
WITH r AS (SELECT l_returnflag, l_linenumber, l_extendedprice AS y, l_quantity AS x1, l_discount AS x2 FROM lineitem),
c AS (SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v11, var_pop(x2) AS v22, covar_pop(x1, x2) AS v12,
             covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2 FROM r),
b AS (SELECT *, (c1 * v22 - c2 * v12) / (v11 * v22 - v12 * v12) AS b1, (c2 * v11 - c1 * v12) / (v11 * v22 - v12 * v12) AS b2 FROM c),
p AS (SELECT l_returnflag, y, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p FROM r, b)
SELECT l_returnflag, count(*) AS n, round(avg(p), 4) AS mean_prediction, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 8) + 0.0 AS r2
FROM p GROUP BY l_returnflag""")
def price_model_by_flag(spark, sf):
    """Two features standardised and regressed, then judged by return flag: the flagship."""
    df = table(spark, sf, "lineitem", ["l_returnflag", "l_quantity", "l_discount", "l_extendedprice"])
    inputs = ["l_quantity", "l_discount"]
    scaler = feature.standard_scaler(input_col="features", output_col="s", with_mean=True).fit(
        assemble(df, inputs, keep=[])
    )
    # scaled by expressions, so only the regression itself needs a vector
    scaled = df.select("*", *[c.alias(n) for n, c in columns(scaler, inputs).items()])
    op = regression.linear_regression(label_col="l_extendedprice", solver="normal")
    model = op.fit(assemble(scaled, ["s_0", "s_1"], keep=["l_extendedprice"]))
    out = score(model, scaled, ["s_0", "s_1"], ["l_returnflag", "l_extendedprice"])
    error = F.col("l_extendedprice") - F.col("prediction")
    return out.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), rounded(F.avg("prediction"), 4).alias("mean_prediction"),
        rounded(F.sqrt(F.avg(error * error)), 4).alias("rmse"),
        rounded(1.0 - F.sum(error * error) / (F.var_pop("l_extendedprice") * F.count("*")), 8).alias("r2"),
    )
