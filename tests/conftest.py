import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import checkpoint_root, local_session

    session = local_session(8, app="tests", **{"spark.ui.showConsoleProgress": "false"})
    checkpoint_root(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def points(spark):
    """Four rows with numbers, a category and a survival time."""
    return spark.sql("""
        SELECT CAST(label AS double) label, CAST(x1 AS double) x1, CAST(x2 AS double) x2,
               CAST(weight AS double) weight, CAST(censor AS double) censor,
               CAST(idx AS double) idx, CAST(survival AS double) survival, category
        FROM VALUES (0, 0.0, 1.1, 1, 1, 0, 1.2, 'a'), (0, 0.1, 1.0, 2, 0, 1, 2.9, 'b'),
                    (1, 2.0, 0.1, 1, 1, 0, 0.7, 'a'), (1, 2.1, 0.2, 2, 1, 1, 3.6, 'b'),
                    (1, 1.9, 0.4, 1, 1, 1, 2.2, 'b'), (0, 0.3, 1.4, 1, 0, 0, 1.9, 'a')
             AS t(label, x1, x2, weight, censor, idx, survival, category)""")


@pytest.fixture(scope="session")
def vectors(points):
    from millrace.functions.vectors import assemble

    return assemble(points, ["x1", "x2"]).persist()


@pytest.fixture(scope="session")
def texts(spark):
    return spark.createDataFrame(
        [(0, "a b a c".split()), (1, "a b d".split()), (2, "b c d d".split()), (3, "a e f".split())],
        "id int, words array<string>",
    )
