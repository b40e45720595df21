"""Column functions and the transformers that need no fit."""

from pyspark.sql import functions as F

from ..functions.vectors import (
    array_to_vector,
    assemble,
    components,
    explode_vector,
    sparse_entries,
    vector_to_array,
)
from ..operators import feature
from ..plans.scoring import score
from ..sources import numbers_from_text, table
from .inputs import KEYS, MEASURES, WORDS_SQL, lines, words
from .registry import query, round_all, rounded

KEY = ", ".join(KEYS)


@query("""
SELECT vec_id, len(embedding)::INT AS n, round(list_sum(embedding::DOUBLE[]), 6) + 0.0 AS total,
       embedding[1]::DOUBLE AS first_value, embedding[64]::DOUBLE AS last_value
FROM embeddings""")
def vector_array_round_trip(spark, sf):
    df = table(spark, sf, "embeddings", ["vec_id", "embedding"])
    back = df.select("vec_id", vector_to_array(array_to_vector("embedding")).alias("a"))
    return back.select(
        "vec_id", F.size("a").alias("n"),
        rounded(F.aggregate("a", F.lit(0.0), lambda s, x: s + x)).alias("total"),
        F.col("a")[0].alias("first_value"), F.col("a")[63].alias("last_value"),
    )


@query("""
SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INT AS idx, unnest(embedding)::DOUBLE AS value
FROM embeddings""")
def vector_to_float32_array(spark, sf):
    df = table(spark, sf, "embeddings", ["vec_id", "embedding"])
    narrow = vector_to_array(array_to_vector("embedding"), "float32")
    return df.select("vec_id", F.posexplode(narrow).alias("idx", "value")).withColumn(
        "value", F.col("value").cast("double")
    )


@query("""
SELECT l_orderkey, l_linenumber, l_quantity + l_discount AS total FROM lineitem""")
def vector_from_text(spark, sf):
    """A vector carried as comma-separated text, opened and used."""
    text = F.concat_ws(",", F.col("l_quantity"), F.col("l_discount"))
    df = lines(spark, sf).select(*KEYS, array_to_vector(numbers_from_text(text)).alias("v"))
    return df.select(*KEYS, *components("v", ["a", "b"])).select(
        *KEYS, (F.col("a") + F.col("b")).alias("total")
    )


@query(f"""
SELECT {KEY}, CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END::DOUBLE AS many,
       CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END::DOUBLE AS cheap
FROM lineitem""")
def binarizer(spark, sf):
    op = feature.binarizer(
        input_cols=["l_quantity", "l_discount"], output_cols=["many", "cheap"], thresholds=[25.0, 0.05]
    )
    return score(op, lines(spark, sf), ["l_quantity", "l_discount"], KEYS)


@query(f"""
SELECT {KEY}, CASE WHEN l_extendedprice < 20000 THEN 0 WHEN l_extendedprice < 40000 THEN 1
       WHEN l_extendedprice < 60000 THEN 2 ELSE 3 END::DOUBLE AS band
FROM lineitem""")
def bucketizer(spark, sf):
    op = feature.bucketizer(
        input_col="l_extendedprice", output_col="band",
        splits=[-float("inf"), 20000.0, 40000.0, 60000.0, float("inf")],
    )
    return score(op, lines(spark, sf), ["l_extendedprice"], KEYS)


@query(f"""
SELECT {KEY},
       CASE WHEN l_orderkey % 7 = 0 THEN 2 WHEN l_quantity < 10 THEN 0 ELSE 1 END::DOUBLE AS q_band,
       CASE WHEN l_tax < 0.02 THEN 0 WHEN l_tax < 0.05 THEN 1 ELSE 2 END::DOUBLE AS t_band
FROM lineitem""")
def bucketizer_keep_invalid(spark, sf):
    """A split list per column; NaN goes to a bucket of its own."""
    df = lines(spark, sf).withColumn(
        "l_quantity", F.when(F.col("l_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    )
    op = feature.bucketizer(
        input_cols=["l_quantity", "l_tax"], output_cols=["q_band", "t_band"], handle_invalid="keep",
        splits_array=[[0.0, 10.0, 50.0], [0.0, 0.02, 0.05, 1.0]],
    )
    return op.transform(df).select(*KEYS, "q_band", "t_band")


@query("""
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS n
           FROM embeddings),
k AS (SELECT unnest(range(64)) AS k)
SELECT vec_id, k::INT AS idx,
       round(sum(x * cos(pi() / 64 * (n + 0.5) * k)) * sqrt((CASE WHEN k = 0 THEN 1.0 ELSE 2.0 END) / 64), 6)
         + 0.0 AS value
FROM e, k GROUP BY vec_id, k""")
def dct(spark, sf):
    df = table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    out = feature.dct(input_col="v", output_col="spectrum").transform(df)
    return round_all(explode_vector(out, "spectrum", ["vec_id"]), ["value"])


@query(f"""
SELECT {KEY}, round(l_quantity * 2.0, 6) AS w_0, round(l_extendedprice * 0.001, 6) AS w_1,
       round(l_discount * 100.0, 6) AS w_2, round(l_tax * 0.0, 6) AS w_3
FROM lineitem""")
def elementwise_product(spark, sf):
    from pyspark.ml.linalg import Vectors

    op = feature.elementwise_product(
        input_col="features", output_col="w", scaling_vec=Vectors.dense([2.0, 0.001, 100.0, 0.0])
    )
    out = score(op, lines(spark, sf), MEASURES, KEYS)
    return round_all(out, ["w_0", "w_1", "w_2", "w_3"])


@query("""
SELECT o_orderkey, round(o_totalprice + 2, 4) AS total, 3::BIGINT AS features FROM orders""")
def feature_hasher(spark, sf):
    """Each string is a 1 in its own slot and the number keeps its value: the sum shows both."""
    df = table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"])
    op = feature.feature_hasher(
        input_cols=["o_orderstatus", "o_orderpriority", "o_totalprice"], output_col="hashed"
    )
    out = op.transform(df).select("o_orderkey", sparse_entries("hashed").alias("e"))
    return out.select(
        "o_orderkey",
        rounded(F.aggregate("e", F.lit(0.0), lambda s, x: s + x["value"]), 4).alias("total"),
        F.size("e").cast("bigint").alias("features"),
    )


@query(f"""
SELECT doc_id, len({WORDS_SQL})::DOUBLE AS total FROM documents""")
def hashing_tf(spark, sf):
    out = feature.hashing_tf(input_col="words", output_col="tf").transform(words(spark, sf))
    entries = sparse_entries("tf")
    return out.select("doc_id", F.aggregate(entries, F.lit(0.0), lambda s, x: s + x["value"]).alias("total"))


@query(f"""
SELECT {KEY}, l_returnflag, l_returnflag AS restored FROM lineitem""")
def index_to_string(spark, sf):
    df = table(spark, sf, "lineitem", [*KEYS, "l_returnflag"])
    indexed = feature.string_indexer(input_col="l_returnflag", output_col="flag").fit(df).transform(df)
    op = feature.index_to_string(input_col="flag", output_col="restored")
    return op.transform(indexed).select(*KEYS, "l_returnflag", "restored")


@query(f"""
SELECT {KEY}, round(l_quantity * l_discount, 6) AS qd, round(l_quantity * l_tax, 6) AS qt FROM lineitem""")
def interaction(spark, sf):
    df = assemble(lines(spark, sf), ["l_discount", "l_tax"], "rates", keep=[*KEYS, "l_quantity"])
    out = feature.interaction(input_cols=["l_quantity", "rates"], output_col="product").transform(df)
    return round_all(out.select(*KEYS, *components("product", ["qd", "qt"])), ["qd", "qt"])


@query(f"""
WITH w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
g AS (SELECT doc_id, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS g FROM w)
SELECT doc_id, len(g)::INT AS n, coalesce(list_sum([len(x) FOR x IN g]), 0)::BIGINT AS chars, g[1] AS first_gram,
       g[len(g)] AS last_gram FROM g""")
def ngram(spark, sf):
    out = feature.ngram(input_col="words", output_col="g", n=2).transform(words(spark, sf))
    return out.select(
        "doc_id", F.size("g").alias("n"),
        F.aggregate("g", F.lit(0).cast("bigint"), lambda s, x: s + F.length(x)).alias("chars"),
        F.get("g", F.lit(0)).alias("first_gram"), F.try_element_at("g", F.lit(-1)).alias("last_gram"),
    )


@query("""
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum([x * x FOR x IN v])) AS norm FROM e)
SELECT vec_id, (generate_subscripts(v, 1) - 1)::INT AS idx, round(unnest(v) / norm, 6) + 0.0 AS value FROM n""")
def normalizer(spark, sf):
    df = table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    out = feature.normalizer(input_col="v", output_col="unit").transform(df)
    return round_all(explode_vector(out, "unit", ["vec_id"]), ["value"])


@query(f"""
SELECT {KEY}, round(l_quantity / (l_quantity + l_extendedprice + l_discount + l_tax), 8) AS unit_0,
       round(l_extendedprice / (l_quantity + l_extendedprice + l_discount + l_tax), 8) AS unit_1,
       round(l_discount / (l_quantity + l_extendedprice + l_discount + l_tax), 8) AS unit_2,
       round(l_tax / (l_quantity + l_extendedprice + l_discount + l_tax), 8) AS unit_3
FROM lineitem""")
def normalizer_l1(spark, sf):
    op = feature.normalizer(input_col="features", output_col="unit", p=1.0)
    out = score(op, lines(spark, sf), MEASURES, KEYS)
    return round_all(out, [f"unit_{i}" for i in range(4)], 8)


@query(f"""
SELECT {KEY}, l_quantity AS x, l_quantity * l_quantity AS xx, l_discount AS y,
       round(l_quantity * l_discount, 6) AS xy, round(l_discount * l_discount, 6) AS yy
FROM lineitem""")
def polynomial_expansion(spark, sf):
    df = assemble(lines(spark, sf), ["l_quantity", "l_discount"], keep=KEYS)
    out = feature.polynomial_expansion(input_col="features", output_col="terms", degree=2).transform(df)
    return round_all(out.select(*KEYS, *components("terms", ["x", "xx", "y", "xy", "yy"])), ["xy", "yy"])


@query(f"""
WITH w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents)
SELECT doc_id, len(w)::INT AS n, coalesce(list_sum([len(x) FOR x IN w]), 0)::BIGINT AS chars, w[1] AS first_word
FROM w""")
def regex_tokenizer(spark, sf):
    return words(spark, sf).select(
        "doc_id", F.size("words").alias("n"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda s, x: s + F.length(x)).alias("chars"),
        F.get("words", F.lit(0)).alias("first_word"),
    )


@query(r"""
WITH w AS (SELECT doc_id, [x FOR x IN string_split_regex(lower(text), '[^\p{L}]+') IF len(x) >= 3] AS w
           FROM documents)
SELECT doc_id, len(w)::INT AS n, coalesce(list_sum([len(x) FOR x IN w]), 0)::BIGINT AS chars FROM w""")
def regex_tokenizer_gaps(spark, sf):
    """The pattern as the gap between tokens, short tokens dropped."""
    op = feature.regex_tokenizer(
        input_col="text", output_col="words", pattern=r"[^\p{L}]+", gaps=True, min_token_length=3
    )
    out = op.transform(table(spark, sf, "documents", ["doc_id", "text"]))
    return out.select(
        "doc_id", F.size("words").alias("n"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda s, x: s + F.length(x)).alias("chars"),
    )


@query("""
SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
def sql_transformer(spark, sf):
    op = feature.sql_transformer(
        statement="SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total "
        "FROM __THIS__ WHERE o_orderstatus = 'F' GROUP BY o_orderpriority"
    )
    return op.transform(table(spark, sf, "orders"))


STOP = ["the", "of", "and", "by", "le", "la", "des"]


@query(f"""
WITH w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents)
SELECT doc_id, len(w)::INT AS before, len([x FOR x IN w IF NOT list_contains({STOP}, x)])::INT AS kept FROM w""")
def stop_words_remover(spark, sf):
    op = feature.stop_words_remover(input_col="words", output_col="kept", stop_words=STOP)
    out = op.transform(words(spark, sf))
    return out.select("doc_id", F.size("words").alias("before"), F.size("kept").alias("kept"))


@query(r"""
SELECT doc_id, CASE WHEN text = '' THEN 1 WHEN trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN 0
       ELSE len(string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')) END::INT AS n FROM documents""")
def tokenizer(spark, sf):
    df = table(spark, sf, "documents", ["doc_id", "text"])
    out = feature.tokenizer(input_col="text", output_col="tokens").transform(df)
    return out.select("doc_id", F.size("tokens").alias("n"))


@query(f"""
SELECT {KEY}, l_quantity AS a, l_extendedprice AS b, l_discount AS c, l_tax AS d
FROM lineitem WHERE l_orderkey % 7 <> 0""")
def vector_assembler(spark, sf):
    """Rows with a missing part are skipped."""
    df = lines(spark, sf).withColumn("l_tax", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_tax")))
    op = feature.vector_assembler(input_cols=MEASURES, output_col="v", handle_invalid="skip")
    return op.transform(df).select(*KEYS, *components("v", ["a", "b", "c", "d"]))


@query("""
SELECT label, count(*) AS n FROM embeddings WHERE vec_id % 7 <> 0 GROUP BY label""")
def vector_size_hint(spark, sf):
    """Vectors cut short are skipped by the hint."""
    df = table(spark, sf, "embeddings").select(
        "label",
        array_to_vector(
            F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 10)).otherwise(F.col("embedding"))
        ).alias("v"),
    )
    op = feature.vector_size_hint(input_col="v", size=64, handle_invalid="skip")
    return op.transform(df).groupBy("label").agg(F.count("v").alias("n"))


@query("""
SELECT vec_id, embedding[4]::DOUBLE AS third, embedding[1]::DOUBLE AS zeroth, embedding[64]::DOUBLE AS last
FROM embeddings""")
def vector_slicer(spark, sf):
    df = table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    out = feature.vector_slicer(input_col="v", output_col="part", indices=[3, 0, 63]).transform(df)
    return out.select("vec_id", *components("part", ["third", "zeroth", "last"]))
