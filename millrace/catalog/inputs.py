"""Input frames the queries share, each read with only the columns it needs, and the SQL
that derives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import array_to_vector, assemble
from ..operators import feature
from ..sources import spread, table

KEYS = ["l_orderkey", "l_linenumber"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# words as maximal runs of letters, lower case
WORD = r"\p{L}+"
WORDS_SQL = rf"regexp_extract_all(lower(text), '{WORD}')"


def lines(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return table(spark, sf, "lineitem", [*KEYS, *MEASURES, *more])


def line_vectors(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    df = table(spark, sf, "lineitem", [*dict.fromkeys([*MEASURES, *keep])])
    return assemble(spread(df, *MEASURES), MEASURES, keep=list(keep))


def words(spark: SparkSession, sf: str, *more: str, some: bool = False) -> DataFrame:
    """documents with ``words``: the whole text cut into lower-case words.

    ``some`` leaves out texts without a letter; asked of the raw text, because a filter on
    the words would be pushed down and cut every text a second time.
    """
    docs = table(spark, sf, "documents", ["doc_id", "text", *more])
    if some:
        docs = docs.filter(F.col("text").rlike(r"\p{L}"))
    cut = feature.regex_tokenizer(input_col="text", output_col="words", pattern=WORD, gaps=False)
    return cut.transform(spread(docs, "doc_id")).drop("text")


def embedded(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings with ``features`` (vector) and ``label`` (double)."""
    return table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector("embedding").alias("features"), F.col("label").cast("double").alias("label")
    )


def text_sizes(spark: SparkSession, sf: str, some: bool = False) -> DataFrame:
    """documents as (doc_id, n_words, n_chars, lang), all counted inside the row."""
    df = words(spark, sf, "n_chars", "lang", some=some)
    return df.select(
        "doc_id", F.size("words").cast("double").alias("n_words"),
        F.col("n_chars").cast("double").alias("n_chars"), "lang",
    )


TEXT_SIZES_SQL = f"""
SELECT doc_id, len({WORDS_SQL})::DOUBLE AS n_words, n_chars::DOUBLE AS n_chars, lang FROM documents
"""


def rated(spark: SparkSession, sf: str) -> DataFrame:
    """events as one mean rating per (user, type): combined before the shuffle, so a user
    with very many events still is a handful of rows."""
    events = table(spark, sf, "events", ["user_id", "event_type", "value"])
    means = events.groupBy("user_id", "event_type").agg(F.avg("value").alias("rating"))
    index = feature.string_indexer(
        input_col="event_type", output_col="item_index", string_order_type="alphabetAsc"
    ).fit(means)
    return index.transform(means).select(
        F.col("user_id").cast("int").alias("user"), F.col("item_index").cast("int").alias("item"),
        F.col("rating").cast("float").alias("rating"),
    )


def baskets(spark: SparkSession, sf: str) -> DataFrame:
    """The set of brands of each order; a set never outgrows the 25 brands."""
    parts = table(spark, sf, "part", ["p_partkey", "p_brand"])
    return (
        table(spark, sf, "lineitem", ["l_orderkey", "l_partkey"])
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("items"))
    )


def type_days(spark: SparkSession, sf: str) -> DataFrame:
    """Per user the sequence of days, each the set of event types seen on it.

    Types are deduplicated per user and day before anything is collected, so a sequence is
    at most days x types long, whatever the number of events.
    """
    seen = (
        table(spark, sf, "events", ["user_id", "ts", "event_type"])
        .select("user_id", F.to_date("ts").alias("day"), "event_type").distinct()
    )
    days = seen.groupBy("user_id", "day").agg(F.sort_array(F.collect_list("event_type")).alias("types"))
    return days.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("day", "types"))).alias("days")
    ).select("user_id", F.col("days.types").alias("sequence"))


def type_ranks(spark: SparkSession, sf: str, whole: bool = False) -> DataFrame:
    """Per user the most frequent event types of each half month, in order: three of the
    first half as the prediction, two of the second as the label (a ranking's top-k), or
    the ``whole`` sets."""
    counted = (
        table(spark, sf, "events", ["user_id", "ts", "event_type"])
        .groupBy("user_id", "event_type")
        .agg(
            F.count_if(F.col("ts") < F.lit("2024-01-16").cast("timestamp")).alias("before"),
            F.count_if(F.col("ts") >= F.lit("2024-01-16").cast("timestamp")).alias("after"),
        )
        # as a number for the evaluators: the place in the alphabet of types
        .withColumn("item", F.ascii("event_type").cast("double") * 1000 + F.length("event_type"))
    )

    def ordered(count: str):
        entries = F.collect_list(F.when(F.col(count) > 0, F.struct((-F.col(count)).alias("c"), F.col("item"))))
        return F.transform(F.sort_array(entries), lambda e: e["item"])

    top = (lambda c, n: c) if whole else (lambda c, n: F.slice(c, 1, n))
    return counted.groupBy("user_id").agg(
        top(ordered("before"), 3).alias("prediction"), top(ordered("after"), 2).alias("label")
    )


TYPE_RANKS_SQL = """
WITH c AS (
  SELECT user_id, event_type, ascii(event_type)*1000.0 + length(event_type) AS item,
         count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS before,
         count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS after
  FROM events GROUP BY user_id, event_type),
ranks AS (
  SELECT user_id,
         coalesce(list(item::DOUBLE ORDER BY before DESC, item) FILTER (before > 0), [])[1:3] AS p,
         coalesce(list(item::DOUBLE ORDER BY after DESC, item) FILTER (after > 0), [])[1:2] AS t
  FROM c GROUP BY user_id)
"""

TYPE_SETS_SQL = TYPE_RANKS_SQL.replace("[1:3]", "").replace("[1:2]", "")


def judged(spark: SparkSession, sf: str) -> DataFrame:
    """labels with a fixed rule as the prediction: label, prediction, score, weight."""
    docs = table(spark, sf, "documents", ["doc_id", "n_chars", "source"])
    labels = table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    return labels.join(docs, "doc_id").select(
        "doc_id", F.col("quality").cast("double").alias("label"),
        F.when(F.col("n_chars") > 500, 1.0).otherwise(0.0).alias("prediction"),
        F.col("n_chars").cast("double").alias("score"),
        (1.0 + F.col("doc_id") % 3).cast("double").alias("weight"),
    )


JUDGED_SQL = """
SELECT doc_id, quality::DOUBLE AS label, CASE WHEN n_chars > 500 THEN 1.0 ELSE 0.0 END::DOUBLE AS pred,
       n_chars::DOUBLE AS score, (1 + doc_id % 3)::DOUBLE AS weight
FROM labels JOIN documents USING (doc_id)
"""
