import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a table of documents from (id, text) with columns whose names an operator might use."""
    def make(rows):
        df = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], DOCS)
        for name in ("fp", "score", "component_id", "ids", "part", "size", "rank", "words", "_kept_id", "tie"):
            df = df.withColumn(name, F.lit("x"))
        return df.repartition(3)

    return make


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "two words"), (None, "no id here at all"), (None, None),
    (6, "same text of some words"), (7, "same text of some words"), (6, "same text of some words"),
    (8, "Ünïcödé straße 日本語 🎉 ́x"), (9, "long " * 30_000), (10, "%%% !!! ..."), (-5, "negative id and words"),
]
