"""Topic models by blocks beside Spark's own."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import clustering as spark_ml

from millrace.operators import clustering, feature, topics
from millrace.session import scratch_path
from millrace.sources.store import load, save


@pytest.fixture(scope="module")
def counted(spark):
    """Documents of two vocabularies in three parts, some of them without a word."""
    draw = np.random.default_rng(3)
    rows = [(i, [f"{'ab'[i % 2]}{w}" for w in draw.integers(0, 12, draw.integers(0, 30))]) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, words array<string>").repartition(3, "id")
    return feature.count_vectorizer(input_col="words", output_col="features").fit(df).transform(df).select("id", "features").checkpoint()


def test_a_fit_by_em_is_that_of_the_graph(spark, counted):
    same = {"k": 3, "maxIter": 4, "optimizer": "em", "seed": 5, "checkpointInterval": 2}
    ours, theirs = clustering.lda(**same).fit(counted), spark_ml.LDA(**same).fit(counted)
    assert isinstance(ours, topics.DistributedLDAModel)  # no object for each term of a document
    assert np.allclose(ours.topicsMatrix().toArray(), theirs.topicsMatrix().toArray(), rtol=1e-9, atol=1e-12)
    assert ours.trainingLogLikelihood() == pytest.approx(theirs.trainingLogLikelihood(), rel=1e-9)
    assert ours.logPrior() == pytest.approx(theirs.logPrior(), rel=1e-9)
    assert ours.logLikelihood(counted) == pytest.approx(theirs.logLikelihood(counted), rel=1e-6)
    assert [r.termIndices for r in ours.describeTopics(4).collect()] == [r.termIndices for r in theirs.describeTopics(4).collect()]
    path = scratch_path(spark, "lda")
    save(ours, path)
    read = load(spark_ml.DistributedLDAModel, path)
    assert read.trainingLogLikelihood() == pytest.approx(theirs.trainingLogLikelihood(), rel=1e-9)
    assert read.logPrior() == pytest.approx(theirs.logPrior(), rel=1e-9)


def test_the_bound_of_an_online_fit_is_sparks(counted):
    model = clustering.lda(k=3, max_iter=3, subsampling_rate=1.0, seed=5).fit(counted)
    assert isinstance(model, topics.LocalLDAModel)
    bound = lambda name: getattr(spark_ml.LocalLDAModel, name)(model, counted)
    assert model.logLikelihood(counted) == pytest.approx(bound("logLikelihood"), rel=1e-6)
    assert model.logPerplexity(counted) == pytest.approx(bound("logPerplexity"), rel=1e-6)


def test_blocks_are_bounded_and_hold_all_terms(monkeypatch):
    monkeypatch.setattr(topics, "BLOCK", 5)
    vectors = [(0, [0, 2, 3], [1.0, 0.0, 2.0]), (0, [], []), (0, [1, 3], [4.0, 1.0]), (1, None, [0.0, 3.0, 1.0, 0.0]), (0, [2], [7.0])]
    rows = [{"type": t, "size": 4, "indices": i, "values": v} for t, i, v in vectors]
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    batch = pa.RecordBatch.from_arrays([pa.array(range(10, 15)), pa.array([2] * 5, pa.int32()), pa.array(rows, kind)], ["id", "part", "vector"])
    held, firsts = [], []
    for packed in topics._packed(iter([batch])):
        row = type("Row", (tuple,), {"part": packed.column(0)[0].as_py(), "first": packed.column(1)[0].as_py()})(c[0].as_py() for c in packed.columns)
        part, first, ids, ends, places, counts, terms = topics._unpacked(row)
        assert part == 2 and len(counts) <= 5 + 2
        firsts.append((first, len(counts)))
        held += [(int(d), int(terms[places[e]]), counts[e]) for n, d in enumerate(ids) for e in range(ends[n], ends[n + 1])]
    assert held == [(10, 0, 1.0), (10, 3, 2.0), (12, 1, 4.0), (12, 3, 1.0), (13, 1, 3.0), (13, 2, 1.0), (14, 2, 7.0)]
    assert firsts == [(0, 6), (6, 1)]
