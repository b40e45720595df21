"""Invariants of the trained models that SQL cannot repeat."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.catalog import QUERIES
from millrace.catalog.inputs import embedded
from millrace.operators import classification, clustering

SF = "/root/testdata/sf0.01"


def _accuracy(rows):
    return sum(r.n for r in rows if r.label == r.prediction) / sum(r.n for r in rows)


@pytest.mark.parametrize("name,floor", [
    ("multilayer_perceptron_classifier", 0.25), ("linear_svc", 0.6), ("fm_classifier", 0.6)])
def test_better_than_chance(spark, name, floor):
    rows = QUERIES[name](spark, SF).collect()
    assert sum(r.n for r in rows) == 500 and _accuracy(rows) > floor


def test_ten_classes_from_embeddings(spark):
    df = embedded(spark, SF)
    model = classification.logistic_regression(max_iter=5).fit(df)
    assert model.summary.accuracy > 0.35


def test_bounds_hold(spark):
    assert all(r.value >= 0 for r in QUERIES["logistic_regression_bounded"](spark, SF).collect())


def test_survival_quantiles_rise(spark):
    for r in QUERIES["aft_survival_regression"](spark, SF).limit(50).collect():
        assert list(r.quantiles) == sorted(r.quantiles) and r.prediction > 0


def test_isotonic_rises(spark):
    rows = QUERIES["isotonic_boundaries"](spark, SF).orderBy("boundary").collect()
    values = [r.value for r in rows]
    assert values == sorted(values)


def test_topics_are_shares(spark):
    for r in QUERIES["lda"](spark, SF).limit(50).collect():
        assert sum(r.topics) == pytest.approx(1.0, abs=1e-6) or sum(r.topics) == 0.0
    topics = QUERIES["lda_topics"](spark, SF).groupBy("topic").count().collect()
    assert [r["count"] for r in topics] == [8] * 4


def test_mixture_weights_sum_to_one(spark):
    df = embedded(spark, SF)
    model = clustering.gaussian_mixture(k=2, max_iter=3, seed=1).fit(
        df.select(F.lit(1).alias("x"), "features").sample(0.5, seed=1))
    assert sum(model.weights) == pytest.approx(1.0)


def test_words_nearest_to_a_word(spark):
    rows = QUERIES["word2vec_synonyms"](spark, SF).collect()
    assert len(rows) == 10 and all(-1.0 <= r.similarity <= 1.0 + 1e-6 for r in rows)


def test_random_forest_members(spark):
    rows = QUERIES["random_forest_members"](spark, SF).collect()
    assert len(rows) == 8 and all(r.num_nodes >= 3 and r.depth <= 5 for r in rows)


def test_factor_regression_beats_the_mean(spark):
    rows = QUERIES["fm_regressor"](spark, SF).collect()
    y, p = np.array([r.label for r in rows]), np.array([r.prediction for r in rows])
    assert np.mean((y - p) ** 2) < 0.5 * np.var(y)


def test_near_documents_share_a_bucket(spark):
    rows = QUERIES["min_hash_nearest"](spark, SF).orderBy("distance").collect()
    assert len(rows) == 5 and rows[0].distance == 0.0


def test_vectors_in_a_pair_are_close(spark):
    rows = QUERIES["similar_vectors"](spark, SF).collect()
    assert rows and all(r.id_a < r.id_b and 0 < r.distance < 1.15 for r in rows)


def test_every_rating_gets_a_prediction(spark):
    rows = QUERIES["als"](spark, SF).collect()
    assert len(rows) == 750 and np.mean([abs(r.rating - r.prediction) for r in rows]) < 5
