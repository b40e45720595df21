import random

import pytest

from millrace.operators import recommendation
from millrace.plans.recommend import recommend_items, recommend_users


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(2)
    rows = [(u, i, draw.uniform(1, 5)) for u in range(30) for i in range(12) if draw.random() < 0.5]
    df = spark.createDataFrame(rows, "user int, item int, rating float")
    return recommendation.als(rank=3, max_iter=4, seed=1).fit(df)


def _flat(df):
    return {(r.id, r["rank"]): (r.other, pytest.approx(r.rating, rel=1e-4)) for r in df.collect()}


def _spark(nested):
    out = {}
    for row in nested.collect():
        for rank, rec in enumerate(row.recommendations, start=1):
            out[row[0], rank] = (rec[0], rec[1])
    return out


def test_items_for_users(model):
    ours = _flat(recommend_items(model, 4))
    assert _spark(model.recommendForAllUsers(4)) == ours and len(ours) == 30 * 4


def test_users_for_items(model):
    ours = _flat(recommend_users(model, 5))
    assert _spark(model.recommendForAllItems(5)) == ours and len(ours) == 12 * 5


def test_subsets(spark, model):
    some = spark.createDataFrame([(3,), (7,), (7,), (999,)], "user int")
    ours = _flat(recommend_items(model, 2, some))
    assert _spark(model.recommendForUserSubset(some, 2)) == ours and len(ours) == 4
    items = spark.createDataFrame([(1,)], "item int")
    assert len(recommend_users(model, 3, items).collect()) == 3


def test_blocks_give_what_one_product_gives(spark, model):
    assert _flat(recommend_items(model, 4, cells=9)) == _flat(recommend_items(model, 4))
    some = spark.createDataFrame([(3, "x")], "who int, more string")
    assert _flat(recommend_items(model, 2, some, cells=9)) == _flat(recommend_items(model, 2, some))
    assert len(recommend_items(model, 2, some, cells=9).collect()) == 2


def test_equal_ratings_go_to_the_smaller_id(spark):
    class Fixed:
        rank = 1
        userFactors = spark.createDataFrame([(1, [1.0])], "id int, features array<float>")
        itemFactors = spark.createDataFrame([(i, [2.0]) for i in (9, 4, 7, 2)], "id int, features array<float>")

    for cells in (1, 2, 100):
        assert [r.other for r in recommend_items(Fixed, 3, cells=cells).orderBy("rank").collect()] == [2, 4, 7]


def test_asking_for_more_than_there_are(model):
    assert recommend_items(model, 50).count() == 30 * 12
