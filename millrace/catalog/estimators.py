"""Feature estimators: what they learn and what they make of whole tables."""

from pyspark.sql import functions as F

from ..functions.tables import attribute
from ..functions.vectors import assemble, components, explode_vector, sparse_entries, vector_to_array
from ..operators import feature
from ..plans.scoring import score
from ..plans.verbs import pipeline
from ..session import checkpoint_root, scratch_path
from ..sources import load, save, table
from .inputs import KEYS, MEASURES, WORDS_SQL, embedded, line_vectors, lines, words
from .registry import query, round_all, rounded

KEY = ", ".join(KEYS)


def _scaled(spark, sf, op):
    """Fit on the assembled measures, score the raw columns in one projection."""
    model = op.fit(line_vectors(spark, sf))
    out = score(model, lines(spark, sf), MEASURES, KEYS)
    return round_all(out, [c for c in out.columns if c not in KEYS])


def _scaled_sql(rule, digits=6):
    """``rule`` over a measure {x}, for each of the four."""
    cells = ", ".join(f"round({rule.format(x=m)}, {digits}) + 0.0 AS s_{i}" for i, m in enumerate(MEASURES))
    return f"SELECT {KEY}, {cells} FROM lineitem"


@query(_scaled_sql("{x} / stddev_samp({x}) OVER ()"))
def standard_scaler(spark, sf):
    return _scaled(spark, sf, feature.standard_scaler(input_col="features", output_col="s"))


@query(_scaled_sql("({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER ()"))
def standard_scaler_centred(spark, sf):
    return _scaled(spark, sf, feature.standard_scaler(input_col="features", output_col="s", with_mean=True))


@query(_scaled_sql("({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) * 10 - 5"))
def min_max_scaler(spark, sf):
    return _scaled(spark, sf, feature.min_max_scaler(input_col="features", output_col="s", min=-5.0, max=5.0))


@query(_scaled_sql("{x} / max(abs({x})) OVER ()"))
def max_abs_scaler(spark, sf):
    return _scaled(spark, sf, feature.max_abs_scaler(input_col="features", output_col="s"))


@query(f"""
WITH q AS (SELECT quantile_disc(l_tax, 0.25) AS t1, quantile_disc(l_tax, 0.5) AS t2, quantile_disc(l_tax, 0.75) AS t3,
                  quantile_disc(l_linenumber, 0.25) AS n1, quantile_disc(l_linenumber, 0.5) AS n2,
                  quantile_disc(l_linenumber, 0.75) AS n3 FROM lineitem)
SELECT {KEY}, round((l_tax - t2) / (t3 - t1), 6) + 0.0 AS s_0,
       round((l_linenumber - n2) / (n3 - n1)::DOUBLE, 6) + 0.0 AS s_1
FROM lineitem, q""")
def robust_scaler(spark, sf):
    """Quartiles within the default error: both columns hold few values, far apart in rank."""
    inputs = ["l_tax", "l_linenumber"]
    op = feature.robust_scaler(input_col="features", output_col="s", with_centering=True)
    model = op.fit(assemble(table(spark, sf, "lineitem", inputs), inputs))
    return round_all(score(model, lines(spark, sf), inputs, KEYS), ["s_0", "s_1"])


def _gaps(spark, sf):
    """events with the value missing (null or NaN) for two keys in seven."""
    event = F.col("event_id") % 7
    return table(spark, sf, "events", ["event_id", "value"]).select(
        "event_id",
        F.when(event == 0, None).when(event == 1, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )


@query("""
WITH g AS (SELECT event_id, CASE WHEN event_id % 7 > 1 THEN value END AS v FROM events)
SELECT event_id, round(coalesce(v, avg(v) OVER ()), 6) AS filled FROM g""")
def imputer_mean(spark, sf):
    gaps = _gaps(spark, sf)
    model = feature.imputer(input_col="value", output_col="filled").fit(gaps)
    return round_all(score(model, gaps, ["value"], ["event_id"]), ["filled"])


def _line_gaps(spark, sf):
    return table(spark, sf, "lineitem", KEYS + ["l_tax"]).select(
        *KEYS, F.when(F.col("l_orderkey") % 7 > 0, F.col("l_linenumber").cast("double")).alias("n"),
        F.when(F.col("l_orderkey") % 5 > 0, F.col("l_tax")).alias("t"),
    )


def _imputed_sql(aggregate):
    return f"""
WITH g AS (SELECT {KEY}, CASE WHEN l_orderkey % 7 > 0 THEN l_linenumber::DOUBLE END AS n,
                  CASE WHEN l_orderkey % 5 > 0 THEN l_tax END AS t FROM lineitem),
s AS (SELECT {aggregate.format(x='n')} AS sn, {aggregate.format(x='t')} AS st FROM g)
SELECT {KEY}, coalesce(n, sn) AS n_filled, coalesce(t, st) AS t_filled FROM g, s"""


def _imputed(spark, sf, strategy):
    gaps = _line_gaps(spark, sf)
    op = feature.imputer(input_cols=["n", "t"], output_cols=["n_filled", "t_filled"], strategy=strategy)
    return score(op.fit(gaps), gaps, ["n", "t"], KEYS)


@query(_imputed_sql("quantile_disc({x}, 0.5)"))
def imputer_median(spark, sf):
    return _imputed(spark, sf, "median")


@query(f"""
WITH g AS (SELECT {KEY}, CASE WHEN l_orderkey % 7 > 0 THEN l_linenumber::DOUBLE END AS n,
                  CASE WHEN l_orderkey % 5 > 0 THEN l_tax END AS t FROM lineitem),
sn AS (SELECT n AS sn FROM g WHERE n IS NOT NULL GROUP BY n ORDER BY count(*) DESC, n LIMIT 1),
st AS (SELECT t AS st FROM g WHERE t IS NOT NULL GROUP BY t ORDER BY count(*) DESC, t LIMIT 1)
SELECT {KEY}, coalesce(n, sn) AS n_filled, coalesce(t, st) AS t_filled FROM g, sn, st""")
def imputer_mode(spark, sf):
    return _imputed(spark, sf, "mode")


INDEX_SQL = """
WITH c AS (SELECT {x} AS label, count(*) AS n FROM {t} GROUP BY {x}),
i AS (SELECT label, (row_number() OVER (ORDER BY {order}) - 1)::DOUBLE AS idx FROM c)
SELECT {keys}, idx FROM {t} JOIN i ON label = {x}"""


def _indexed(spark, sf, order):
    df = table(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    op = feature.string_indexer(input_col="o_orderpriority", output_col="idx", string_order_type=order)
    return op.fit(df).transform(df).select("o_orderkey", "idx")


def _index_query(order, sql_order):
    query(
        INDEX_SQL.format(x="o_orderpriority", t="orders", keys="o_orderkey", order=sql_order),
        name="string_indexer" if order == "frequencyDesc" else f"string_indexer_{order.lower()}",
    )(lambda spark, sf: _indexed(spark, sf, order))


for _order, _sql in [
    ("frequencyDesc", "n DESC, label"), ("frequencyAsc", "n, label"),
    ("alphabetDesc", "label DESC"), ("alphabetAsc", "label"),
]:
    _index_query(_order, _sql)


@query("""
WITH t AS (SELECT l_returnflag AS flag, count(*) AS n FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1),
i AS (SELECT flag, row_number() OVER (ORDER BY n DESC, flag) - 1 AS idx FROM t)
SELECT l_returnflag, coalesce(idx, 2)::DOUBLE AS idx, count(*) AS n
FROM lineitem LEFT JOIN i ON flag = l_returnflag GROUP BY ALL""")
def string_indexer_keep_unseen(spark, sf):
    """A label the fit did not see gets an index of its own."""
    df = table(spark, sf, "lineitem", ["l_returnflag"])
    op = feature.string_indexer(input_col="l_returnflag", output_col="idx", handle_invalid="keep")
    model = op.fit(df.filter("l_returnflag <> 'A'"))
    return model.transform(df).groupBy("l_returnflag", "idx").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, (CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END)::DOUBLE AS rank,
       (CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END)::DOUBLE AS state
FROM orders""")
def string_indexer_from_dictionary(spark, sf):
    """Indices from given dictionaries, nothing fitted; other values share the last index."""
    df = table(spark, sf, "orders", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    model = feature.string_indexer_from_arrays_of_labels(
        [["1-URGENT", "2-HIGH"], ["O", "P"]], ["o_orderpriority", "o_orderstatus"], ["rank", "state"], "keep"
    )
    return model.transform(df).select("o_orderkey", "rank", "state")


@query("""
SELECT l_orderkey, l_linenumber, (CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 END)::DOUBLE AS idx
FROM lineitem WHERE l_returnflag <> 'A'""")
def string_indexer_from_labels(spark, sf):
    df = table(spark, sf, "lineitem", [*KEYS, "l_returnflag"])
    model = feature.string_indexer_from_labels(["N", "R"], "l_returnflag", "idx", "skip")
    return model.transform(df).select(*KEYS, "idx")


@query("""
WITH c AS (SELECT l_returnflag AS f, count(*) AS n FROM lineitem GROUP BY 1),
i AS (SELECT f, row_number() OVER (ORDER BY n DESC, f) - 1 AS idx FROM c)
SELECT l_orderkey, l_linenumber, (idx = 0)::INT::DOUBLE AS is_0, (idx = 1)::INT::DOUBLE AS is_1
FROM lineitem JOIN i ON f = l_returnflag""")
def one_hot_encoder(spark, sf):
    df = table(spark, sf, "lineitem", [*KEYS, "l_returnflag"])
    stages = pipeline([
        feature.string_indexer(input_col="l_returnflag", output_col="idx"),
        feature.one_hot_encoder(input_col="idx", output_col="hot"),
    ])
    return stages.fit(df).transform(df).select(*KEYS, *components("hot", ["is_0", "is_1"]))


def _priorities(spark, sf):
    df = table(spark, sf, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice"])
    return df.select(
        "o_orderkey", "o_totalprice", F.substring("o_orderpriority", 1, 1).cast("double").alias("priority")
    )


@query("""
WITH g AS (SELECT o_orderkey, avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS a,
                  count(*) OVER (PARTITION BY o_orderpriority) AS n, avg(o_totalprice) OVER () AS m FROM orders)
SELECT o_orderkey, round(n / (n + 100.0) * a + 100.0 / (n + 100.0) * m, 4) AS encoded FROM g""")
def target_encoder(spark, sf):
    df = _priorities(spark, sf)
    op = feature.target_encoder(
        input_col="priority", output_col="encoded", label_col="o_totalprice", target_type="continuous",
        smoothing=100.0,
    )
    return round_all(op.fit(df).transform(df).select("o_orderkey", "encoded"), ["encoded"], 4)


@query("""
SELECT o_orderkey, round(avg((o_totalprice > 250000)::INT) OVER (PARTITION BY o_orderpriority), 6) AS encoded
FROM orders""")
def target_encoder_binary(spark, sf):
    df = _priorities(spark, sf).withColumn("label", (F.col("o_totalprice") > 250000).cast("double"))
    op = feature.target_encoder(input_col="priority", output_col="encoded")
    return round_all(op.fit(df).transform(df).select("o_orderkey", "encoded"), ["encoded"])


@query(f"""
WITH q AS (SELECT quantile_disc(l_tax, 0.25) AS a, quantile_disc(l_tax, 0.5) AS b, quantile_disc(l_tax, 0.75) AS c
           FROM lineitem)
SELECT {KEY}, CASE WHEN l_tax < a THEN 0 WHEN l_tax < b THEN 1 WHEN l_tax < c THEN 2 ELSE 3 END::DOUBLE AS bucket
FROM lineitem, q""")
def quantile_discretizer(spark, sf):
    """Fits a bucketizer; the default rank error cannot move a split of so few values."""
    op = feature.quantile_discretizer(input_col="l_tax", output_col="bucket", num_buckets=4)
    model = op.fit(table(spark, sf, "lineitem", ["l_tax"]))
    return score(model, lines(spark, sf), ["l_tax"], KEYS)


@query("""
WITH c AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1),
i AS (SELECT p, row_number() OVER (ORDER BY n DESC, p) - 1 AS idx FROM c)
SELECT o_orderkey, o_totalprice AS label, o_custkey::DOUBLE AS f0, (idx = 0)::INT::DOUBLE AS f1,
       (idx = 1)::INT::DOUBLE AS f2, (idx = 2)::INT::DOUBLE AS f3, (idx = 3)::INT::DOUBLE AS f4
FROM orders JOIN i ON p = o_orderpriority""")
def r_formula(spark, sf):
    df = table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"])
    op = feature.r_formula(formula="o_totalprice ~ o_custkey + o_orderpriority")
    out = op.fit(df).transform(df)
    return out.select("o_orderkey", "label", *components("features", [f"f{i}" for i in range(5)]))


@query("""
WITH v AS (SELECT unnest([0, 1, 2, 3])::INT AS idx,
                  unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS x FROM lineitem)
SELECT idx FROM v GROUP BY idx HAVING var_samp(x) > 1.0""")
def variance_threshold_selector(spark, sf):
    op = feature.variance_threshold_selector(output_col="kept", variance_threshold=1.0)
    model = op.fit(line_vectors(spark, sf))
    return attribute(model, "selected_features").select(F.col("value").cast("int").alias("idx"))


@query(f"""
SELECT {KEY}, (l_linenumber - 1)::DOUBLE AS line, l_quantity AS quantity FROM lineitem""")
def vector_indexer(spark, sf):
    """Seven line numbers become categories; fifty quantities stay numbers."""
    df = assemble(
        table(spark, sf, "lineitem", KEYS + ["l_quantity"]).withColumn("n", F.col("l_linenumber") + 0),
        ["n", "l_quantity"], keep=KEYS,
    )
    model = feature.vector_indexer(input_col="features", output_col="v", max_categories=10).fit(df)
    return model.transform(df).select(*KEYS, *components("v", ["line", "quantity"]))


@query("""
WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS idx FROM embeddings),
g AS (SELECT idx, label, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS within FROM e GROUP BY 1, 2),
t AS (SELECT idx, avg(x) AS mm FROM e GROUP BY idx),
f AS (SELECT idx, (sum(n * (m - mm) * (m - mm)) / 9) / (sum(within) / (sum(n) - 10)) AS f FROM g JOIN t USING (idx)
      GROUP BY idx)
SELECT idx::INT AS idx FROM f ORDER BY f DESC LIMIT 8""")
def univariate_feature_selector(spark, sf):
    """Numbers against classes: the eight components with the largest ANOVA F."""
    op = feature.univariate_feature_selector(
        output_col="kept", feature_type="continuous", label_type="categorical",
        selection_mode="numTopFeatures", selection_threshold=8.0,
    )
    model = op.fit(embedded(spark, sf))
    return attribute(model, "selected_features").select(F.col("value").cast("int").alias("idx"))


@query("""
WITH v AS (SELECT unnest([0, 1, 2])::INT AS idx, unnest([l_quantity, l_discount, l_tax]) AS x, l_extendedprice AS y
           FROM lineitem)
SELECT idx FROM v GROUP BY idx ORDER BY abs(corr(x, y)) DESC LIMIT 2""")
def univariate_feature_selector_regression(spark, sf):
    """Numbers against a number."""
    inputs = ["l_quantity", "l_discount", "l_tax"]
    df = assemble(table(spark, sf, "lineitem", [*inputs, "l_extendedprice"]), inputs)
    op = feature.univariate_feature_selector(
        output_col="kept", label_col="l_extendedprice", feature_type="continuous", label_type="continuous",
        selection_mode="numTopFeatures", selection_threshold=2.0,
    )
    return attribute(op.fit(df), "selected_features").select(F.col("value").cast("int").alias("idx"))


FIVES_SQL = """
WITH v AS (SELECT unnest([0, 1, 2, 3])::INT AS idx,
                  unnest([l_partkey % 5, l_suppkey % 5, l_orderkey % 5, l_quantity::BIGINT % 5]) AS x,
                  l_returnflag AS y FROM lineitem),
o AS (SELECT idx, x, y, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
m AS (SELECT idx, n, sum(n) OVER (PARTITION BY idx, x) * sum(n) OVER (PARTITION BY idx, y)
             / sum(n) OVER (PARTITION BY idx) AS e FROM o)
SELECT idx FROM m GROUP BY idx ORDER BY sum((n - e) * (n - e) / e) DESC LIMIT 2"""


def _fives(spark, sf):
    """Four features of five categories each, so their statistics rank like p-values."""
    sources = ["l_partkey", "l_suppkey", "l_orderkey", "l_quantity"]
    df = table(spark, sf, "lineitem", [*sources, "l_returnflag"])
    df = df.select(
        F.ascii("l_returnflag").cast("double").alias("label"),
        *[(F.col(c).cast("bigint") % 5).cast("double").alias(c) for c in sources],
    )
    return assemble(df, sources, keep=["label"])


@query(FIVES_SQL)
def chi_sq_selector(spark, sf):
    model = feature.chi_sq_selector(output_col="kept", num_top_features=2).fit(_fives(spark, sf))
    return attribute(model, "selected_features").select(F.col("value").cast("int").alias("idx"))


@query(FIVES_SQL)
def univariate_feature_selector_categories(spark, sf):
    """Categories against classes."""
    op = feature.univariate_feature_selector(
        output_col="kept", feature_type="categorical", label_type="categorical",
        selection_mode="numTopFeatures", selection_threshold=2.0,
    )
    model = op.fit(_fives(spark, sf))
    return attribute(model, "selected_features").select(F.col("value").cast("int").alias("idx"))


TERMS_SQL = f"""
WITH w AS (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents),
t AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
v AS (SELECT term, count(*) AS df, sum(tf)::DOUBLE AS total FROM t GROUP BY term HAVING count(*) >= 5)
"""


#: No cap on the vocabulary: as many terms as Spark can count.
ALL_TERMS = 2**31 - 1


def _counted(spark, sf):
    """documents as term counts, with the fitted vocabulary of all terms in five or more.

    Counts are written once, so that what is fitted on them cuts no text again.
    """
    checkpoint_root(spark)
    df = words(spark, sf)
    model = feature.count_vectorizer(input_col="words", output_col="tf", min_df=5.0, vocab_size=ALL_TERMS).fit(df)
    return model, model.transform(df).select("doc_id", "tf").checkpoint()


@query(TERMS_SQL + "SELECT term, df, total FROM v")
def count_vectorizer(spark, sf):
    """(term, documents, occurrences) from the vectors, so the order of the vocabulary is free."""
    model, counted = _counted(spark, sf)
    terms = attribute(model, "vocabulary").withColumnRenamed("value", "term")
    per_slot = explode_vector(counted, "tf", ["doc_id"]).groupBy("idx").agg(
        F.count("*").alias("df"), F.sum("value").alias("total")
    )
    return per_slot.join(terms, "idx").select("term", "df", "total")


@query(f"""
WITH w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents)
SELECT doc_id, len([x FOR x IN w IF x = 'the'])::DOUBLE AS the, len([x FOR x IN w IF x = 'la'])::DOUBLE AS la
FROM w""")
def count_vectorizer_from_vocabulary(spark, sf):
    model = feature.count_vectorizer_from_vocabulary(["the", "la"], "words", "tf")
    return model.transform(words(spark, sf)).select("doc_id", *components("tf", ["the", "la"]))


@query(TERMS_SQL + """, n AS (SELECT count(*) AS m FROM documents),
k AS (SELECT doc_id, count(*) AS terms, sum(tf * ln((m + 1.0) / (df + 1.0))) AS weight
      FROM t JOIN v USING (term), n GROUP BY doc_id)
SELECT doc_id, coalesce(terms, 0) AS terms, round(coalesce(weight, 0), 4) + 0.0 AS weight
FROM documents LEFT JOIN k USING (doc_id)""")
def idf(spark, sf):
    """Per document the number of kept terms and the sum of their tf-idf.

    Summed inside the row, so nothing is exploded or shuffled. No filter stands on the
    outcome: pushed down, it would cut and weigh every text again.
    """
    _, counted = _counted(spark, sf)
    model = feature.idf(input_col="tf", output_col="tfidf").fit(counted)
    weights = model.transform(counted).select("doc_id", sparse_entries("tfidf").alias("e"))
    return weights.select(
        "doc_id", F.size("e").cast("bigint").alias("terms"),
        rounded(F.aggregate("e", F.lit(0.0), lambda s, x: s + x["value"]), 4).alias("weight"),
    )


PCA_SQL = f"""
WITH x AS (SELECT {KEY}, l_quantity AS a, l_extendedprice / 2000 AS b FROM lineitem),
c AS (SELECT var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS cab FROM x),
e AS (SELECT *, (va + vb) / 2 + sqrt((va - vb) * (va - vb) / 4 + cab * cab) AS l1 FROM c),
d AS (SELECT *, va + vb - l1 AS l2, l1 - vb AS ux, cab AS uy FROM e)
"""


def _scatter(spark, sf):
    df = table(spark, sf, "lineitem", KEYS + ["l_quantity", "l_extendedprice"])
    return df.select(*KEYS, F.col("l_quantity").alias("a"), (F.col("l_extendedprice") / 2000).alias("b"))


@query(PCA_SQL + f"""
SELECT {KEY}, round(abs(a * ux + b * uy) / sqrt(ux * ux + uy * uy), 5) AS along FROM x, d""")
def pca(spark, sf):
    """The length along the first component; its sign is free."""
    df = _scatter(spark, sf)
    model = feature.pca(input_col="features", output_col="p", k=1).fit(assemble(df, ["a", "b"]))
    return score(model, df, ["a", "b"], KEYS).select(*KEYS, rounded(F.abs("p_0"), 5).alias("along"))


@query(PCA_SQL + """
SELECT unnest([0, 1])::INT AS idx, round(unnest([l1 / (l1 + l2), l2 / (l1 + l2)]), 8) AS value FROM d""")
def pca_explained_variance(spark, sf):
    model = feature.pca(input_col="features", output_col="p", k=2).fit(assemble(_scatter(spark, sf), ["a", "b"]))
    return round_all(attribute(model, "explained_variance"), ["value"], 8)


def _embedder(spark, size):
    # sentences are trained in so many parts and averaged: a fixed number, as it decides the result
    return feature.word2vec(
        input_col="words", output_col="v", vector_size=size, min_count=20, seed=42,
        num_partitions=8,
    )


@query(f"""
WITH w AS (SELECT unnest({WORDS_SQL}) AS word FROM documents)
SELECT word, 16::INT AS size FROM w GROUP BY word HAVING count(*) >= 20""")
def word2vec(spark, sf):
    """Which words got a vector, and how long it is."""
    vectors = attribute(_embedder(spark, 16).fit(words(spark, sf)), "get_vectors")
    return vectors.select("word", F.size("vector").alias("size"))


@query()
def word2vec_vectors(spark, sf):
    return attribute(_embedder(spark, 16).fit(words(spark, sf)), "get_vectors")


@query()
def word2vec_synonyms(spark, sf):
    return attribute(_embedder(spark, 16).fit(words(spark, sf)), "find_synonyms", "the", 10)


@query()
def word2vec_documents(spark, sf):
    """Each document as the mean of its word vectors."""
    df = words(spark, sf)
    return _embedder(spark, 8).fit(df).transform(df).select("doc_id", vector_to_array("v").alias("v"))


@query(_scaled_sql("{x} / stddev_samp({x}) OVER ()"))
def saved_scaler(spark, sf):
    """A model saved, loaded and applied scores as the fitted one did."""
    fitted = feature.standard_scaler(input_col="features", output_col="s").fit(line_vectors(spark, sf))
    path = scratch_path(spark, "scaler")
    save(fitted, path)
    model = load(type(fitted), path)
    out = score(model, lines(spark, sf), MEASURES, KEYS)
    return round_all(out, [c for c in out.columns if c not in KEYS])
