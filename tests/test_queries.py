"""Every registered query at the smallest scale, beside its SQL check in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from millrace.catalog import CHECKS, QUERIES
from millrace.operators import names

SF = "/root/testdata/sf0.001"
TABLES = ("customer documents embeddings events labels lineitem nation orders part region supplier "
          "pages benchmark conversations").split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def _line(columns, row):
    cells = []
    for name, value in sorted(zip(columns, row), key=lambda c: c[0]):
        cells.append("nan" if isinstance(value, float) and math.isnan(value) else repr(value))
    return "|".join(cells)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows or name == "similar_vectors"
    if name in CHECKS:
        cursor = db.execute(CHECKS[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(_line(df.columns, r) for r in rows) == sorted(_line(columns, r) for r in cursor.fetchall())


def test_no_user_types_leave_a_query(spark):
    from pyspark.sql.types import UserDefinedType

    for name in ("gaussian_mixture_components", "word2vec", "lda", "als"):
        schema = QUERIES[name](spark, SF).schema
        assert not any(isinstance(f.dataType, UserDefinedType) for f in schema)


def test_every_operator_has_a_query():
    text = " ".join(QUERIES)
    aliases = {
        "power_iteration_clustering": "power_iteration", "min_hash_lsh": "min_hash_lsh",
        "regex_tokenizer": "regex_tokenizer", "r_formula": "r_formula", "imputer": "imputer_mean",
    }
    missing = [n for n in names() if aliases.get(n, n) not in text]
    assert missing == []


def test_the_driver_contract(spark):
    assert driver.entry(spark).count() == 3
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.queries())
