"""Curves against a plain walk down the scores, at more scores than Spark's summaries keep."""

import numpy as np
import pytest

from millrace.plans import curves


@pytest.fixture(scope="module")
def counts(spark):
    draw = np.random.default_rng(3)
    rows = [(float(draw.integers(0, 6000)), float(draw.random() < 0.4)) for _ in range(12000)]
    return rows, curves.score_counts(spark.createDataFrame(rows, "s double, y double"), "s", "y").persist()


def test_every_score_is_a_point(counts):
    rows, found = counts
    scores = sorted({s for s, _ in rows}, reverse=True)
    assert len(scores) > 5000
    got = {r.threshold: (r.tp, r.fp) for r in found.collect()}
    up = np.array([s for s, y in rows if y])
    down = np.array([s for s, y in rows if not y])
    assert got == {s: ((up >= s).sum(), (down >= s).sum()) for s in scores}
    assert curves.roc(found).count() == len(scores) + 2
    assert curves.precision_recall(found).count() == len(scores) + 1


def test_first_point_and_f_measure(counts):
    rows, found = counts
    top = max(s for s, _ in rows)
    share = np.mean([y for s, y in rows if s == top])
    assert share in [r.precision for r in curves.precision_recall(found).where("recall = 0").collect()]
    for r in curves.by_threshold(found).limit(50).collect():
        both = r.precision + r.recall
        assert r.f_measure == pytest.approx(2 * r.precision * r.recall / both if both else 0.0)
