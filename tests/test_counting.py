"""A vocabulary kept as a table beside Spark's own counter."""

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.catalog import QUERIES
from millrace.functions.tables import attribute
from millrace.operators import counting, feature

WORDS = ["b", "a", "c", "d", "e", "é", "zz", "f"]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(counting, "HELD", 2)
    monkeypatch.setattr(counting, "COMMON", 3)


@pytest.mark.parametrize("binary", [True, False])
def test_a_table_of_words_counts_as_the_list_does(spark, small, binary):
    rows = [(i % 7, [WORDS[(i * j) % 8] for j in range(i)]) for i in range(12)] + [(3, []), (3, ["a", "a", "only"])]
    df = spark.createDataFrame(rows, "id int, words array<string>").repartition(3)
    same = {"input_col": "words", "output_col": "v", "binary": binary, "min_df": 1.0, "vocab_size": 2**31 - 1}
    model = feature.count_vectorizer(**same).fit(df)
    assert isinstance(model, counting.TableVocabulary)  # no driver holds the words
    theirs = CountVectorizer(inputCol="words", outputCol="v", binary=binary, minDF=1.0, vocabSize=2**31 - 1).fit(df)
    listed = [r.word for r in attribute(model, "vocabulary").orderBy("idx").collect()]
    assert sorted(listed) == sorted(theirs.vocabulary)
    often = [sum(r.words.count(w) for r in df.collect()) for w in listed]
    assert often == sorted(often, reverse=True)

    def told(fitted, words, frame):
        read = lambda v: sorted((words[int(i)], n) for i, n in zip(v.indices, v.values))
        found = fitted.transform(frame).collect()
        assert all(list(r.v.indices) == sorted(set(r.v.indices)) and r.v.size == len(words) for r in found)
        return sorted((r.id, r.words, read(r.v)) for r in found)

    # keys repeat: every row is there
    assert told(model, listed, df) == told(theirs, theirs.vocabulary, df) and df.count() == 14
    unseen = spark.createDataFrame([(1, ["new", "a"]), (2, ["new"])], "id int, words array<string>")
    beside = array_to_vector(F.array(F.col("id").cast("double")))
    assert {r.w[0] for r in model.transform(df.withColumn("w", beside)).collect()} == {float(r.id) for r in df.collect()}
    assert told(model, listed, unseen) == told(theirs, theirs.vocabulary, unseen)


def test_a_bounded_vocabulary_is_sparks(spark, small, texts):
    assert not isinstance(feature.count_vectorizer(input_col="words", min_df=2.0).fit(texts), counting.TableVocabulary)


@pytest.mark.parametrize("name", ["min_hash_lsh", "min_hash_nearest", "min_hash_distances"])
def test_min_hash_queries_do_not_collect_words(spark, name, monkeypatch):
    whole = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    monkeypatch.setattr(counting, "HELD", 1000)
    fits, fit = [], counting.CountVectorizer._fit
    monkeypatch.setattr(counting.CountVectorizer, "_fit", lambda self, df: fits.append(fit(self, df)) or fits[-1])
    now = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert len(fits) == 1 and isinstance(fits[0], counting.TableVocabulary)
    if name == "min_hash_distances":
        assert now == whole
    if name == "min_hash_lsh":  # which hash is the least depends on how equally frequent words are numbered
        assert len(now) == len(whole) and {(r.doc_id, r.table) for r in now} == {(r.doc_id, r.table) for r in whole}
    if name == "min_hash_nearest":
        assert now[:2] == whole[:2]  # itself and its copy; how many meet it in a bucket depends on the hashes
