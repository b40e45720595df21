"""Against brute force on small data, with blocks of copies in it."""

import random

import numpy as np
import pytest

from millrace.functions.vectors import array_to_vector
from millrace.operators import feature
from millrace.plans import similarity


@pytest.fixture(scope="module")
def sets(spark):
    """Random sets, near copies, and one set held by a third of the rows."""
    draw = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    rows = [draw.sample(words, draw.randint(1, 12)) for _ in range(120)]
    near = [r + [draw.choice(words)] for r in rows[:40]]
    hot = ["x", "y", "z", "w1"]
    everything = rows + near + [hot] * 80 + [hot + ["w2"], []]
    draw.shuffle(everything)
    return spark.createDataFrame(list(enumerate(everything)), "id long, words array<string>").persist()


def _folded(rows):
    groups = {}
    for key, value in rows:
        groups.setdefault(value, []).append(key)
    return {min(ids): (value, len(ids)) for value, ids in groups.items()}


@pytest.mark.parametrize("threshold", [0.15, 0.5, 0.8])
def test_jaccard_join_is_exact(sets, threshold):
    folded = _folded((r.id, frozenset(r.words)) for r in sets.collect() if r.words)
    expected = {}
    for a, (x, n) in folded.items():
        for b, (y, m) in folded.items():
            d = 1 - len(x & y) / len(x | y)
            if a < b and d < threshold:
                expected[a, b] = (n, m, pytest.approx(d))
    out = similarity.jaccard_join(sets, "id", "words", threshold).collect()
    assert {(r.id_a, r.id_b): (r.copies_a, r.copies_b, r.distance) for r in out} == expected
    assert len(out) == len(expected) > 0


def test_members_name_the_smallest_id(sets):
    first = {}
    rows = sorted((r.id, tuple(r.words)) for r in sets.collect())
    for key, words in rows:
        first.setdefault(words, key)
    got = {r.id: r.stands_for for r in similarity.members(sets, "id", "words").collect()}
    assert got == {key: first[words] for key, words in rows}


@pytest.fixture(scope="module")
def points(spark):
    draw = np.random.default_rng(5)
    base = draw.normal(size=(60, 6))
    near = base[:30] + draw.normal(scale=0.02, size=(30, 6))
    rows = np.vstack([base, near, np.tile(base[0], (60, 1))])
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "id long, v array<double>").persist()


def _model(spark, points, tables=8, length=0.8):
    op = feature.bucketed_random_projection_lsh(
        input_col="f", output_col="h", bucket_length=length, num_hash_tables=tables, seed=3)
    return op.fit(points.withColumn("f", array_to_vector("v")))


@pytest.mark.parametrize("block", [20_000, 3])
@pytest.mark.parametrize("band", [1, 2])
def test_euclidean_join(spark, points, block, band):
    folded = _folded((r.id, tuple(r.v)) for r in points.collect())
    close = {}
    for a, (x, n) in folded.items():
        for b, (y, m) in folded.items():
            d = float(np.linalg.norm(np.subtract(x, y)))
            if a < b and d < 0.3:
                close[a, b] = (n, m, pytest.approx(d))
    model = _model(spark, points)
    out = similarity.euclidean_join(model, points, "id", "v", 0.3, rows_per_band=band, block=block).collect()
    got = {(r.id_a, r.id_b): (r.copies_a, r.copies_b, r.distance) for r in out}
    assert len(out) == len(got)
    assert all(got[k] == close[k] for k in got)
    assert len(got) >= 0.9 * len(close) > 0


def test_euclidean_join_finds_what_the_models_join_finds(spark, points):
    model = _model(spark, points)
    f = points.withColumn("f", array_to_vector("v"))
    theirs = {
        (r.a, r.b) for r in similarity.similarity_join(model, f, f, 0.3).selectExpr(
            "datasetA.id AS a", "datasetB.id AS b").collect() if r.a < r.b
    }
    stands = {r.id: r.stands_for for r in similarity.members(points, "id", "v").collect()}
    theirs = {tuple(sorted((stands[a], stands[b]))) for a, b in theirs if stands[a] != stands[b]}
    ours = {(r.id_a, r.id_b) for r in similarity.euclidean_join(model, points, "id", "v", 0.3).collect()}
    assert ours == theirs


@pytest.mark.parametrize("length,cells", [(5.0, ["cell"]), (0.02, ["table", "h", "cell"])])
def test_vectors_that_meet_in_many_tables_are_compared_once(spark, points, length, cells, monkeypatch):
    """Wide buckets: each two once, not in every table. Narrow ones: by the tables. The same pairs either way."""
    model, near, seen = _model(spark, points, length=length), similarity._near, []
    monkeypatch.setattr(similarity, "_near", lambda placed, cell, *rest: seen.append(cell) or near(placed, cell, *rest))
    f = points.withColumn("f", array_to_vector("v"))
    met = similarity.similarity_join(model, f, f, 0.3).selectExpr("datasetA.id AS a", "datasetB.id AS b", "distCol AS d").collect()
    stands = {r.id: r.stands_for for r in similarity.members(points, "id", "v").collect()}
    theirs = {tuple(sorted((stands[r.a], stands[r.b]))): pytest.approx(r.d) for r in met if stands[r.a] != stands[r.b]}
    out = similarity.euclidean_join(model, points, "id", "v", 0.3, block=40).collect()
    assert {(r.id_a, r.id_b): r.distance for r in out} == theirs and len(out) == len(theirs) > 0
    assert seen == [cells]


@pytest.mark.parametrize("block", [2_000, 1, 5])
@pytest.mark.parametrize("threshold", [0.05, 0.3, 2.5])
def test_distance_join_is_exact(spark, points, block, threshold):
    folded = _folded((r.id, tuple(r.v)) for r in points.collect())
    close = {}
    for a, (x, n) in folded.items():
        for b, (y, m) in folded.items():
            d = float(np.linalg.norm(np.subtract(x, y)))
            if a < b and d < threshold:
                close[a, b] = (n, m, pytest.approx(d))
    if block == 1 and threshold > 1:
        return  # a task for every pair of rows
    out = similarity.distance_join(points, "id", "v", threshold, block).collect()
    assert {(r.id_a, r.id_b): (r.copies_a, r.copies_b, r.distance) for r in out} == close and len(out) == len(close)


def test_distance_join_of_nothing(spark, points):
    assert similarity.distance_join(points.limit(0), "id", "v", 1.0).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, None)], "id long, v array<double>")
    assert similarity.distance_join(nulls, "id", "v", 1.0).collect() == []


def test_nearest_is_sorted_and_measured(spark, points):
    model = _model(spark, points, length=100.0)
    f = points.withColumn("f", array_to_vector("v"))
    key = f.filter("id = 5").first().f
    rows = similarity.nearest(model, f, key, 4).collect()
    assert len(rows) == 4 and rows[0].id == 5 and rows[0].distCol == 0.0
    for r in rows:
        assert r.distCol == pytest.approx(float(np.linalg.norm(np.subtract(r.v, key.toArray()))))


def test_min_hash_refuses_an_empty_set(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.sparse(4, [], []),)], ["s"])
    model = feature.min_hash_lsh(input_col="s", output_col="h", seed=1)
    with pytest.raises(Exception, match="non zero|nonzero|at least 1"):
        model.fit(df).transform(df).collect()


def test_the_bucket_for_a_recall(spark):
    draw = np.random.default_rng(3)
    for threshold, dims, tables, recall in ((1.0, 16, 4, 0.9), (0.3, 64, 12, 0.97)):
        bucket = similarity.bucket_for(threshold, dims, tables, recall)
        assert similarity.bucket_for(threshold, dims, tables, recall - 0.1) < bucket
        met = 0
        for _ in range(400):
            away = draw.normal(size=dims)
            away *= threshold / np.linalg.norm(away)
            base = draw.normal(size=dims) * 10
            units = draw.normal(size=(tables, dims))
            units /= np.linalg.norm(units, axis=1, keepdims=True)
            met += bool((np.floor(units @ base / bucket) == np.floor(units @ (base + away) / bucket)).any())
        assert abs(met / 400 - recall) < 0.05
    with pytest.raises(ValueError, match="recall"):
        similarity.bucket_for(1.0, 2, 2, 1.0)


def test_vectors_without_a_distance_are_in_no_pair(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.0]), (2, [0.1, 0.0]), (3, [nan, 0.0]), (4, [inf, 0.0]), (5, [None, 0.0]), (6, None), (7, [0.1, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = similarity.distance_join(df, "id", "v", 1.0).collect()
    assert [(r.id_a, r.id_b, r.copies_a, r.copies_b) for r in out] == [(1, 2, 1, 2)]


def test_a_pair_that_shares_many_buckets_is_given_once_and_candidates_are_no_rows(spark):
    draw = np.random.default_rng(9)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(draw.normal(size=(400, 8)))]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    model = _model(spark, df, tables=5, length=50.0)
    out = similarity.euclidean_join(model, df, "id", "v", 1.2, block=70)
    assert "Aggregate" not in out._jdf.queryExecution().analyzed().toString()
    true = {(r.id_a, r.id_b): r.distance for r in similarity.distance_join(df, "id", "v", 1.2).collect()}
    got = out.collect()
    assert len(got) == len(true) and {(r.id_a, r.id_b): r.distance for r in got} == true


def test_min_hash_join_finds_what_the_models_join_finds(spark, sets):
    some = sets.where("size(words) > 0")
    counter = feature.count_vectorizer(input_col="words", output_col="s", binary=True, min_df=1.0).fit(some)
    counted = counter.transform(some).persist()
    model = feature.min_hash_lsh(input_col="s", output_col="h", num_hash_tables=3, seed=2).fit(counted)
    stands = {r.id: r.stands_for for r in similarity.members(some, "id", similarity.F.array_sort(similarity.F.array_distinct("words"))).collect()}
    theirs = {}
    for r in similarity.similarity_join(model, counted, counted, 0.4).selectExpr("datasetA.id AS a", "datasetB.id AS b", "distCol AS d").collect():
        a, b = sorted((stands[r.a], stands[r.b]))
        if a != b:
            theirs[a, b] = pytest.approx(r.d)
    out = similarity.min_hash_join(model, counted, "id", "words", 0.4)
    got = {(r.id_a, r.id_b): r.distance for r in out.collect()}
    assert got == theirs and len(got) > 0
