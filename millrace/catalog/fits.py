"""Penalised and implicit fits, selection by error rates, topic state, streams and exact quantiles.

Where a fit has a closed form on the chosen inputs, SQL computes it; else the query works out on the
whole table the equations that only the right fit satisfies, and answers whether they hold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.tables import attribute, learned_model
from ..functions.vectors import array_to_vector, assemble, vector_to_array
from ..operators import classification, clustering, feature, recommendation, regression
from ..plans.ordered import exact_quantiles
from ..plans.verbs import assign_clusters, pipeline
from ..session import checkpoint_root, scratch_path
from ..sources import table
from ..streaming import score_folder
from .clusters import em_counts
from .inputs import KEYS, WORDS_SQL, rated, text_sizes, words
from .registry import query, rounded

SEED = 42

# streams -------------------------------------------------------------------------------


@query("""
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 2) AS prediction FROM lineitem, f""")
def streamed_prices(spark, sf):
    """All lines scored as a stream of files: each is read once, what was read stands in a checkpoint."""
    inputs = [*KEYS, "l_quantity", "l_extendedprice"]
    lines = table(spark, sf, "lineitem", inputs)
    vectors = lambda df: df.withColumn("v", array_to_vector(F.array("l_quantity")))
    stages = pipeline([
        feature.vector_assembler(input_cols=["v"], output_col="features"),
        regression.linear_regression(label_col="l_extendedprice", solver="normal"),
    ])
    model = stages.fit(vectors(lines))
    # a stream reads a folder: the table's own one, or that which its one file lies in
    folder, file = lines.inputFiles()[0].rsplit("/", 1)
    stream = spark.readStream.schema(lines.schema).option("pathGlobFilter", "*" if folder.endswith("lineitem.parquet") else file).parquet(folder)
    scored = score_folder(
        model, stream, scratch_path(spark, "scored"), scratch_path(spark, "stream-state"),
        [*KEYS, "prediction"], {"v": 1}, vectors)
    return scored.select(*KEYS, rounded("prediction", 2).alias("prediction"))


# penalised fits ------------------------------------------------------------------------

PENALTY, SHARE = 500.0, 0.75

#: With one input kept, its coefficient is a soft threshold; the others stay at zero if their
#: covariance with what is left over is under the threshold, or else the answer is no such row.
NET_SQL = f"""
WITH d AS (SELECT n_chars::DOUBLE AS y, len({WORDS_SQL})::DOUBLE AS x, (doc_id % 7)::DOUBLE AS u, (doc_id % 11)::DOUBLE AS v FROM documents),
s AS (
    SELECT covar_pop(y, x) AS c, var_pop(x) AS vx, stddev_samp(x) AS sx, stddev_samp(y) AS sy, covar_pop(u, y) AS cu, covar_pop(u, x) AS ux,
           stddev_samp(u) AS su, covar_pop(v, y) AS cv, covar_pop(v, x) AS xv, stddev_samp(v) AS sv FROM d
), w AS (
    SELECT *, (c - {PENALTY * SHARE} * sx) / (vx + {PENALTY * (1 - SHARE)} * sx * sx / sy) AS w FROM s
)
SELECT idx, round(CASE WHEN idx = 0 THEN w ELSE 0 END, 4) AS coefficient
FROM w, (SELECT unnest([0, 1, 2])::INT AS idx)
WHERE w > 0 AND abs(cu - w * ux) <= {PENALTY * SHARE} * su AND abs(cv - w * xv) <= {PENALTY * SHARE} * sv"""


@query(NET_SQL)
def elastic_net(spark, sf):
    """Length by words and two numbers that say nothing, under both penalties: these get exactly nothing."""
    df = text_sizes(spark, sf).withColumns({f"by_{k}": (F.col("doc_id") % k).cast("double") for k in (7, 11)})
    df = assemble(df, ["n_words", "by_7", "by_11"], keep=["n_chars"])
    op = regression.linear_regression(
        label_col="n_chars", reg_param=PENALTY, elastic_net_param=SHARE, solver="l-bfgs", max_iter=500, tol=1e-14)
    return attribute(op.fit(df), "coefficients").select("idx", rounded("value", 4).alias("coefficient"))


@query("""
SELECT unnest([0, 1, 2, 3])::INT AS idx, unnest([false, true, true, true]) AS zero, true AS stationary""")
def logistic_lasso(spark, sf):
    """Large lines by quantity and three columns that say nothing, under an L1 penalty.

    At the optimum the mean of input times error is the penalty times the input's deviation, with
    the coefficient's sign, and not above that where the coefficient is zero.
    """
    names, penalty = ["l_quantity", "l_discount", "l_tax", "l_linenumber"], 0.05
    df = table(spark, sf, "lineitem", [*names, "l_partkey"]).select(
        (F.col("l_quantity") + F.col("l_partkey") % 20 > 35).cast("double").alias("label"), *[F.col(n).cast("double").alias(n) for n in names])
    op = classification.logistic_regression(reg_param=penalty, elastic_net_param=1.0, max_iter=500, tol=1e-12)
    model = op.fit(assemble(df, names, keep=["label"]))
    w = [float(x) for x in model.coefficients]
    margin = sum((F.col(n) * F.lit(x) for n, x in zip(names, w)), F.lit(float(model.intercept)))
    error = F.col("label") - 1 / (1 + F.exp(-margin))
    sums = df.agg(*[F.avg(F.col(n) * error).alias(f"g_{n}") for n in names], *[F.stddev_samp(n).alias(f"s_{n}") for n in names])
    rows = []
    for i, (n, x) in enumerate(zip(names, w)):
        bound = penalty * F.col(f"s_{n}")
        off = F.abs(F.col(f"g_{n}") - bound * (1 if x > 0 else -1)) if x else F.greatest(F.lit(0.0), F.abs(F.col(f"g_{n}")) - bound)
        rows.append(F.struct(F.lit(i).alias("idx"), F.lit(x == 0).alias("zero"), (off < 1e-4 * F.col(f"s_{n}")).alias("stationary")))
    return sums.select(F.inline(F.array(*rows)))


# recommendation ------------------------------------------------------------------------

RANK = 4


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def _met(ratings, model):
    """Each rating with the factors ``u`` of its user and ``v`` of its item."""
    users = attribute(model, "user_factors").select(F.col("id").alias("user"), F.col("features").alias("u"))
    items = attribute(model, "item_factors").select(F.col("id").alias("item"), F.col("features").alias("v"))
    return ratings.join(items, "item").join(users, "user")


def _products_hold(ratings, model) -> Column:
    """Whether predictions are products of factors, of all ratings."""
    met = _met(model.transform(ratings), model)
    return F.lit(met.agg(F.max(F.abs(F.col("prediction") - _dot("u", "v")) / (1 + F.abs("prediction")))).first()[0] < 1e-4)


FITTED_SQL = """
SELECT count(DISTINCT user_id) AS users, true AS solved, true AS products FROM events"""


@query(FITTED_SQL)
def als_normal_equations(spark, sf):
    """The users are fitted last: every user's factors solve its own ridge equations against the items'."""
    ratings = rated(spark, sf)
    checkpoint_root(spark)
    model = recommendation.als(rank=RANK, max_iter=5, reg_param=0.1, seed=SEED).fit(ratings)
    met = _met(ratings, model).withColumn("e", _dot("u", "v") - F.col("rating"))
    gradient = [F.sum(F.col("e") * F.col("v")[k]) + 0.1 * F.count("*") * F.first(F.col("u")[k]) for k in range(RANK)]
    size = F.sqrt(F.sum(F.col("rating") * F.col("rating"))) * F.sqrt(F.sum(_dot("v", "v")))
    off = met.groupBy("user").agg((F.greatest(*[F.abs(g) for g in gradient]) / (1 + size)).alias("off"))
    return off.agg(F.count("*").alias("users"), (F.max("off") < 1e-4).alias("solved")).withColumn("products", _products_hold(ratings, model))


@query(FITTED_SQL)
def als_nonnegative(spark, sf):
    """No factor below zero; where one is zero the error does not fall by raising it, elsewhere it is level."""
    ratings = rated(spark, sf)
    checkpoint_root(spark)
    model = recommendation.als(rank=RANK, max_iter=5, reg_param=0.1, nonnegative=True, seed=SEED).fit(ratings)
    met = _met(ratings, model).withColumn("e", _dot("u", "v") - F.col("rating"))
    size = 1 + F.sqrt(F.sum(F.col("rating") * F.col("rating"))) * F.sqrt(F.sum(_dot("v", "v")))
    held = []
    for k in range(RANK):
        own = F.first(F.col("u")[k])
        gradient = (F.sum(F.col("e") * F.col("v")[k]) + 0.1 * F.count("*") * own) / size
        held.append((own >= 0) & F.when(own > 0, F.abs(gradient) < 1e-3).otherwise(gradient > -1e-3))
    kept = met.groupBy("user").agg(F.array(*held).alias("held"))
    return kept.agg(F.count("*").alias("users"), F.bool_and(F.forall("held", lambda x: x)).alias("solved")).withColumn(
        "products", _products_hold(ratings, model))


@query(FITTED_SQL)
def als_implicit(spark, sf):
    """Values as confidence: each user solves least squares over all items, seen ones weighed by their value."""
    alpha, reg = 0.5, 0.1
    ratings = rated(spark, sf)
    checkpoint_root(spark)
    model = recommendation.als(rank=RANK, max_iter=5, reg_param=reg, implicit_prefs=True, alpha=alpha, seed=SEED).fit(ratings)
    items = attribute(model, "item_factors").select(F.col("features").alias("v"))
    cells = [(i, j) for i in range(RANK) for j in range(RANK)]
    gram = items.agg(*[F.sum(F.col("v")[i].cast("double") * F.col("v")[j]).alias(f"g{i}{j}") for i, j in cells]).first()
    more = alpha * F.abs("rating")
    met = _met(ratings, model).withColumns({"c": more.cast("double"), "p": _dot("u", "v"), "liked": (F.col("rating") > 0).cast("int")})
    off = []
    for k in range(RANK):
        everywhere = sum((F.lit(gram[f"g{k}{j}"]) * F.first(F.col("u")[j]) for j in range(RANK)), F.lit(0.0))
        seen = F.sum((F.col("c") * F.col("p") - F.col("liked") * (1 + F.col("c"))) * F.col("v")[k])
        off.append(F.abs(everywhere + seen + reg * F.sum("liked") * F.first(F.col("u")[k])))
    size = 1 + F.sum((1 + F.col("c")) * F.sqrt(_dot("v", "v")))
    each = met.groupBy("user").agg((F.greatest(*off) / size).alias("off"))
    return each.agg(F.count("*").alias("users"), (F.max("off") < 1e-3).alias("solved")).withColumn("products", _products_hold(ratings, model))


@query("""
SELECT unnest(range(0, count(DISTINCT event_type)))::INT AS item, 2::BIGINT AS n, true AS best_first FROM events""")
def recommend_for_item_subset(spark, sf):
    """The two best users of each item, by the model's own subset call."""
    ratings = rated(spark, sf)
    checkpoint_root(spark)
    model = recommendation.als(rank=RANK, max_iter=5, reg_param=0.1, seed=SEED).fit(ratings)
    best = attribute(model, "recommend_for_item_subset", ratings.select("item").distinct(), 2)
    places = F.col("recommendations")
    return best.select("item", F.size(places).cast("bigint").alias("n"), (places[0]["rating"] >= places[1]["rating"]).alias("best_first"))


# selection by error rates --------------------------------------------------------------

THIRDS = {
    "part": "l_partkey % 3", "supplier": "l_suppkey % 3", "order": "l_orderkey % 3", "line": "l_linenumber % 3",
    "quantity": "CAST(l_quantity AS BIGINT) % 3", "year": "year(l_shipdate) % 3", "month": "month(l_shipdate) % 3",
    "size": "CASE WHEN l_quantity > 40 THEN 2 WHEN l_quantity > 10 THEN 1 ELSE 0 END",
    "hint": "(l_partkey + CASE WHEN l_quantity > 25 AND l_orderkey % 5 = 0 THEN 1 ELSE 0 END) % 3",
}


def _chosen_sql(rule: str) -> str:
    """Three categories against two classes have two degrees of freedom: p is exp(-x / 2)."""
    return f"""
WITH v AS (SELECT unnest({list(range(len(THIRDS)))})::INT AS idx, unnest([{', '.join(THIRDS.values())}]) AS x,
                  l_quantity > 25 AS y FROM lineitem),
o AS (SELECT idx, x, y, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
m AS (SELECT idx, n, sum(n) OVER (PARTITION BY idx, x) * sum(n) OVER (PARTITION BY idx, y)
             / sum(n) OVER (PARTITION BY idx) AS e FROM o),
p AS (SELECT idx, exp(-sum((n - e) * (n - e) / e) / 2) AS p FROM m GROUP BY idx),
r AS (SELECT idx, p, row_number() OVER (ORDER BY p, idx) AS place, count(*) OVER () AS k FROM p)
SELECT idx FROM r WHERE {rule}"""


def _selected(spark, sf, mode: str, threshold: float):
    df = table(spark, sf, "lineitem", ["l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"])
    cells = df.select((F.col("l_quantity") > 25).cast("double").alias("label"), *[F.expr(e).cast("double").alias(n) for n, e in THIRDS.items()])
    op = feature.univariate_feature_selector(
        output_col="kept", feature_type="categorical", label_type="categorical", selection_mode=mode, selection_threshold=threshold)
    df = assemble(cells, list(THIRDS), keep=["label"])
    model = op.fit(df)
    chosen = attribute(model, "selected_features").select(F.col("value").cast("int").alias("idx"))
    # what the rows keep is what was selected, in its order
    kept = model.transform(df).select(F.size(vector_to_array("kept")).alias("kept")).distinct()
    return chosen.join(kept, F.lit(True)).where(F.col("kept") == chosen.count()).select("idx")  # one row on the right


@query(_chosen_sql("p < 0.05"))
def selection_by_false_positives(spark, sf):
    """All features whose p-value is under a bound."""
    return _selected(spark, sf, "fpr", 0.05)


@query(_chosen_sql("p < 0.05 / k"))
def selection_by_family_error(spark, sf):
    """The bound shared out among the features."""
    return _selected(spark, sf, "fwe", 0.05)


@query(_chosen_sql("place <= (SELECT max(place) FROM r WHERE p <= 0.6 * place / k)"))
def selection_by_false_discoveries(spark, sf):
    """Step-up testing: up to the last p-value that is under its own share of the bound."""
    return _selected(spark, sf, "fdr", 0.6)


@query(_chosen_sql("place <= floor(0.4 * k)"))
def selection_by_percentile(spark, sf):
    return _selected(spark, sf, "percentile", 0.4)


# topics --------------------------------------------------------------------------------


@query(f"""
WITH w AS (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents),
v AS (SELECT term FROM w GROUP BY term HAVING count(DISTINCT doc_id) >= 20)
SELECT (SELECT count(*) FROM v) AS terms, (SELECT count(*) FROM w JOIN v USING (term)) AS words,
       4::BIGINT AS topics, 13.5::DOUBLE AS concentration, true AS whole_topics, true AS local_agrees, true AS likely""")
def lda_em_state(spark, sf):
    """What only a fit by expectation maximisation knows, and its local form.

    The expected counts of all topics sum to the words of the corpus, each topic's weights to one, and the
    local model says of the same documents what the distributed one does.
    """
    counter, counted = em_counts(spark, sf)
    model = clustering.lda(k=4, max_iter=5, optimizer="em", checkpoint_interval=2, seed=SEED).fit(counted)
    local = learned_model(model, "to_local")
    own, there = (attribute(m, "log_likelihood", counted).first()[0] for m in (model, local))
    trained, prior = attribute(model, "training_log_likelihood").first()[0], attribute(model, "log_prior").first()[0]
    size = attribute(counter, "vocabulary").count()
    topics = attribute(model, "describe_topics", size).select(F.aggregate("termWeights", F.lit(0.0), lambda s, x: s + x).alias("total"))
    whole = topics.agg(F.count("*").alias("topics"), F.bool_and(F.abs(F.col("total") - 1) < 1e-6).alias("whole_topics"))
    counts = attribute(model, "to_local").agg(F.count_distinct("i").alias("terms"), F.round(F.sum("value")).cast("bigint").alias("words"))
    concentration = attribute(model, "estimated_doc_concentration").agg(rounded(F.avg("value")).alias("concentration"))
    return counts.join(whole, F.lit(True)).join(concentration, F.lit(True)).withColumns({  # one row each
        "local_agrees": F.lit(abs(own - there) < 1e-6 * abs(own)), "likely": F.lit(trained < 0 and prior > float("-inf") and own < 0)})


# quantiles -----------------------------------------------------------------------------


@query("""
SELECT round(quantile_disc(l_extendedprice, 0.5), 2) AS middle,
       round(quantile_disc(l_extendedprice, 0.75) - quantile_disc(l_extendedprice, 0.25), 2) AS span FROM lineitem""")
def robust_scaler_prices(spark, sf):
    """Median and range of the middle half of a column of many values, without any rank error."""
    # the scaler's own sketch without rank error holds the whole column in one task: it learns from the exact
    # quartiles, which are the quartiles of themselves
    prices = table(spark, sf, "lineitem", ["l_extendedprice"])
    quartiles = exact_quantiles(prices, "l_extendedprice", [0.25, 0.5, 0.75])
    df = assemble(quartiles.select(F.col("value").alias("l_extendedprice")), ["l_extendedprice"])
    model = feature.robust_scaler(input_col="features", output_col="s", with_centering=True, relative_error=0.0).fit(df)
    middle = attribute(model, "median").select(rounded("value", 2).alias("middle"))
    return middle.join(attribute(model, "range").select(rounded("value", 2).alias("span")), F.lit(True))


@query("SELECT count(*) AS n, round(quantile_disc(l_extendedprice, 0.5), 2) AS middle FROM lineitem")
def imputer_median_prices(spark, sf):
    df = table(spark, sf, "lineitem", ["l_extendedprice"])
    half = exact_quantiles(df, "l_extendedprice", [0.5]).select(F.col("value").alias("l_extendedprice"))
    model = feature.imputer(strategy="median", relative_error=0.0, input_cols=["l_extendedprice"], output_cols=["filled"]).fit(half)
    middle = model.surrogateDF.select(rounded("l_extendedprice", 2).alias("middle"))
    return df.agg(F.count("*").alias("n")).join(middle, F.lit(True))


@query("""
SELECT unnest(range(0, 10))::INT AS bucket, count(*) AS rows, true AS within FROM lineitem""")
def quantile_discretizer_prices(spark, sf):
    """Ten buckets of prices at a rank error of a thousandth: no border is further off than that."""
    df = table(spark, sf, "lineitem", ["l_extendedprice"])
    op = feature.quantile_discretizer(input_col="l_extendedprice", output_col="bucket", num_buckets=10, relative_error=0.001)
    out = op.fit(df).transform(df).groupBy(F.col("bucket").cast("int").alias("bucket")).agg(F.count("*").alias("n")).checkpoint()
    total = out.agg(F.sum("n")).first()[0]
    upto = F.aggregate(F.filter("all", lambda x: x["bucket"] <= F.col("bucket")), F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    every = out.agg(F.collect_list(F.struct("bucket", "n")).alias("all"))  # ten rows
    # a price that several lines share may lie across a border
    off = F.abs(upto / total - (F.col("bucket") + 1) / 10) <= 0.001 + 20 / total
    return out.join(every, F.lit(True)).select("bucket", F.lit(total).alias("rows"), off.alias("within"))


# graphs --------------------------------------------------------------------------------


@query("""
SELECT count(*) AS vertices, 2::BIGINT AS clusters, true AS recovered FROM (
    SELECT s_suppkey FROM supplier UNION ALL SELECT -1 - n_nationkey FROM nation)""")
def power_iteration_communities(spark, sf):
    """Suppliers and their nations in two trading blocks that hardly meet: each block is one cluster."""
    suppliers = table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    nations = table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    block = F.when(F.col("n_regionkey") <= 1, 0).otherwise(1)
    # a nation's suppliers share a tie of one: however many they are, a walk leaves the nation for its block as soon
    crowd = suppliers.groupBy("s_nationkey").agg(F.count("*").alias("crowd"))
    home = suppliers.join(crowd, "s_nationkey").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("src"), (-1 - F.col("n_nationkey")).alias("dst"), (1.0 / F.col("crowd")).alias("weight"))
    n = nations.select((-1 - F.col("n_nationkey")).alias("id"), block.alias("block"))
    other = n.toDF("dst", "other")
    trade = n.withColumnRenamed("id", "src").join(other, F.col("src") < F.col("dst")).select(
        "src", "dst", F.when(F.col("block") != F.col("other"), 1e-6).when(F.col("block") == 0, 40.0).otherwise(4.0).alias("weight"))
    edges = home.select("src", "dst", "weight").unionByName(trade)
    op = clustering.power_iteration_clustering(k=2, max_iter=30, init_mode="degree", weight_col="weight")
    found = assign_clusters(op, edges)
    blocks = n.unionByName(suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id"), block.alias("block")))
    met = found.join(blocks, "id").groupBy("block").agg(F.count("*").alias("n"), F.min("cluster").alias("low"), F.max("cluster").alias("high"))
    return met.agg(F.sum("n").alias("vertices"), F.count_distinct("low").alias("clusters"), F.bool_and(F.col("low") == F.col("high")).alias("recovered"))
