"""Learned state of feature models as tables."""

from pyspark.sql import functions as F

from ..functions.tables import attribute
from ..functions.vectors import assemble
from ..operators import feature
from ..sources import table
from .estimators import ALL_TERMS, TERMS_SQL, _counted, _line_gaps
from .inputs import MEASURES, line_vectors, words
from .registry import query, round_all, rounded

LONG = "(SELECT unnest([0, 1, 2, 3])::INT AS idx, unnest([{}]) AS x FROM lineitem)".format(", ".join(MEASURES))


def _joined(model, *names):
    """Several vector attributes of one model side by side."""
    out = attribute(model, names[0]).withColumnRenamed("value", names[0])
    for name in names[1:]:
        out = out.join(attribute(model, name).withColumnRenamed("value", name), "idx")
    return out


@query(f"SELECT idx, round(avg(x), 7) AS mean, round(stddev_samp(x), 6) AS std FROM {LONG} GROUP BY idx")
def standard_scaler_state(spark, sf):
    model = feature.standard_scaler(input_col="features", output_col="s").fit(line_vectors(spark, sf))
    return round_all(round_all(_joined(model, "mean", "std"), ["mean"], 7), ["std"])


@query(f"SELECT idx, min(x) AS original_min, max(x) AS original_max FROM {LONG} GROUP BY idx")
def min_max_scaler_state(spark, sf):
    model = feature.min_max_scaler(input_col="features", output_col="s").fit(line_vectors(spark, sf))
    return _joined(model, "original_min", "original_max")


@query(f"SELECT idx, max(abs(x)) AS max_abs FROM {LONG} GROUP BY idx")
def max_abs_scaler_state(spark, sf):
    model = feature.max_abs_scaler(input_col="features", output_col="s").fit(line_vectors(spark, sf))
    return _joined(model, "max_abs")


@query("""
SELECT unnest([0, 1])::INT AS idx,
       unnest([quantile_disc(l_tax, 0.5), quantile_disc(l_linenumber, 0.5)])::DOUBLE AS median,
       round(unnest([quantile_disc(l_tax, 0.75) - quantile_disc(l_tax, 0.25),
                     quantile_disc(l_linenumber, 0.75) - quantile_disc(l_linenumber, 0.25)]), 9)::DOUBLE AS range
FROM lineitem""")
def robust_scaler_state(spark, sf):
    inputs = ["l_tax", "l_linenumber"]
    op = feature.robust_scaler(input_col="features", output_col="s")
    model = op.fit(assemble(table(spark, sf, "lineitem", inputs), inputs))
    return round_all(_joined(model, "median", "range"), ["range"], 9)


@query(TERMS_SQL + """, n AS (SELECT count(*) AS m FROM documents)
SELECT term, df AS doc_freq, round(ln((m + 1.0) / (df + 1.0)), 8) + 0.0 AS idf, m AS num_docs FROM v, n""")
def idf_state(spark, sf):
    counter, counted = _counted(spark, sf)
    model = feature.idf(input_col="tf", output_col="tfidf").fit(counted)
    terms = attribute(counter, "vocabulary").withColumnRenamed("value", "term")
    out = _joined(model, "idf", "doc_freq").join(terms, "idx")
    return out.select(
        "term", F.col("doc_freq").cast("bigint").alias("doc_freq"), rounded("idf", 8).alias("idf"),
        F.lit(model.numDocs).cast("bigint").alias("num_docs"),
    )


@query("""
SELECT round(avg(CASE WHEN l_orderkey % 7 > 0 THEN l_linenumber END), 8) AS n,
       round(avg(CASE WHEN l_orderkey % 5 > 0 THEN l_tax END), 8) AS t FROM lineitem""")
def imputer_surrogates(spark, sf):
    gaps = _line_gaps(spark, sf)
    model = feature.imputer(input_cols=["n", "t"], output_cols=["a", "b"]).fit(gaps)
    return round_all(attribute(model, "surrogate_df"), ["n", "t"], 8)


@query("""
WITH c AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1)
SELECT (row_number() OVER (ORDER BY n DESC, v) - 1)::INT AS idx, v AS value FROM c""")
def string_indexer_labels(spark, sf):
    model = feature.string_indexer(input_col="o_orderpriority", output_col="i").fit(
        table(spark, sf, "orders", ["o_orderpriority"])
    )
    return attribute(model, "labels")


@query("""
WITH c AS (SELECT 0 AS i, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 2
           UNION ALL SELECT 1, o_orderstatus, count(*) FROM orders GROUP BY 2)
SELECT i::INT AS i, (row_number() OVER (PARTITION BY i ORDER BY n DESC, v) - 1)::INT AS j, v AS value FROM c""")
def string_indexer_label_arrays(spark, sf):
    op = feature.string_indexer(input_cols=["o_orderpriority", "o_orderstatus"], output_cols=["a", "b"])
    model = op.fit(table(spark, sf, "orders", ["o_orderpriority", "o_orderstatus"]))
    return attribute(model, "labels_array")


@query("SELECT 0::INT AS idx, (max(l_linenumber) + 1)::DOUBLE AS value FROM lineitem")
def one_hot_encoder_sizes(spark, sf):
    df = table(spark, sf, "lineitem", ["l_linenumber"]).select(F.col("l_linenumber").cast("double").alias("n"))
    return attribute(feature.one_hot_encoder(input_col="n", output_col="hot").fit(df), "category_sizes")


@query("""
SELECT 0::INT AS feature, n AS category, (row_number() OVER (ORDER BY n) - 1)::INT AS idx
FROM (SELECT DISTINCT l_linenumber::DOUBLE AS n FROM lineitem)""")
def vector_indexer_categories(spark, sf):
    df = assemble(table(spark, sf, "lineitem", ["l_linenumber", "l_quantity"]), ["l_linenumber", "l_quantity"])
    model = feature.vector_indexer(input_col="features", output_col="v", max_categories=10).fit(df)
    return attribute(model, "category_maps_df")


@query("""
SELECT 'o_totalprice' AS label, 'o_custkey,o_orderpriority' AS terms, count(*) AS rows FROM orders""")
def r_formula_resolved(spark, sf):
    """What a dot in a formula stood for in this table."""
    df = table(spark, sf, "orders", ["o_totalprice", "o_custkey", "o_orderpriority"])
    model = feature.r_formula(formula="o_totalprice ~ .").fit(df)
    text = attribute(model, "resolved_formula_string").first()[0]
    label, terms = F.regexp_extract(F.lit(text), r"label=(\w+), terms=\[([^\]]*)\]", 1), F.regexp_extract(
        F.lit(text), r"label=(\w+), terms=\[([^\]]*)\]", 2
    )
    return df.agg(label.alias("label"), terms.alias("terms"), F.count("*").alias("rows"))


@query(TERMS_SQL + "SELECT term FROM v")
def count_vectorizer_vocabulary(spark, sf):
    op = feature.count_vectorizer(input_col="words", output_col="tf", min_df=5.0, vocab_size=ALL_TERMS)
    model = op.fit(words(spark, sf))
    return attribute(model, "vocabulary").select(F.col("value").alias("term"))
