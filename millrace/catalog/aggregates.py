"""Vector aggregates and statistics."""

from pyspark.sql import functions as F

from ..functions import stats
from ..functions.vectors import METRICS, SHORTCUTS, assemble, summary, vector_to_array
from ..operators import snake
from ..sources import table
from .inputs import MEASURES, line_vectors
from .registry import query, round_all

# every vector aggregate over one component x
SQL = {
    "mean": "avg(x)", "sum": "sum(x)", "variance": "var_samp(x)", "std": "stddev_samp(x)",
    "count": "count(x)::DOUBLE", "num_nonzeros": "count(*) FILTER (x <> 0)::DOUBLE", "max": "max(x)",
    "min": "min(x)", "norm_l2": "sqrt(sum(x * x))", "norm_l1": "sum(abs(x))",
}
LONG_SQL = "(SELECT l_returnflag, unnest([0, 1, 2, 3])::INT AS idx, unnest([{}]) AS x FROM lineitem)".format(
    ", ".join(MEASURES)
)


def _digits(metric):
    if metric == "mean":
        return 7  # past the last digit a mean of two-decimal numbers can have exactly
    return 2 if metric in ("sum", "variance", "norm_l1", "norm_l2") else 6


def _shortcut_query(metric):
    digits = _digits(metric)

    def run(spark, sf):
        df = line_vectors(spark, sf, "l_returnflag")
        out = df.groupBy("l_returnflag").agg(SHORTCUTS[metric]("features").alias("v"))
        if metric == "count":
            return out.select("l_returnflag", F.lit(0).alias("idx"), F.col("v").cast("double").alias("value"))
        rows = out.select("l_returnflag", F.posexplode(vector_to_array("v")).alias("idx", "value"))
        return round_all(rows, ["value"], digits)

    only = "WHERE idx = 0" if metric == "count" else ""
    query(
        f"SELECT l_returnflag, idx, round({SQL[metric]}, {digits}) + 0.0 AS value "
        f"FROM {LONG_SQL} {only} GROUP BY l_returnflag, idx",
        name=f"vector_{metric}",
    )(run)


for _metric in SHORTCUTS:
    _shortcut_query(_metric)


def _opened(out, names, keys=()):
    """One row per component from a summary struct ``s``; the count is repeated."""
    vectors = [n for n in names if n != "count"]
    arrays = out.select(
        *keys, F.col("s.count").cast("double").alias("count"),
        *[vector_to_array(F.col(f"s.{n}")).alias(n) for n in vectors],
    )
    zipped = F.arrays_zip(*[F.col(n) for n in vectors])
    return arrays.select(*keys, "count", F.posexplode(zipped).alias("idx", "z")).select(
        *keys, "idx", F.col("count").alias("count"), *[F.col(f"z.{n}").alias(snake(n)) for n in vectors]
    )


def _rounded_summary(df):
    for name in ("mean", "sum", "variance", "std", "norm_l1", "norm_l2"):
        df = round_all(df, [name], _digits(name))
    return df


@query(f"""
SELECT idx, count(x)::DOUBLE AS count, round(avg(x), 7) AS mean, round(sum(x), 2) AS sum,
       round(var_samp(x), 2) AS variance, round(stddev_samp(x), 6) AS std,
       (count(*) FILTER (x <> 0))::DOUBLE AS num_non_zeros, max(x) AS max, min(x) AS min,
       round(sqrt(sum(x * x)), 2) AS norm_l2, round(sum(abs(x)), 2) AS norm_l1
FROM {LONG_SQL} GROUP BY idx""")
def vector_summary(spark, sf):
    """All ten metrics of every component in one aggregate."""
    out = line_vectors(spark, sf).agg(summary("features").alias("s"))
    return _rounded_summary(_opened(out, METRICS))


@query(f"""
WITH w AS (SELECT l_returnflag, unnest([0, 1, 2, 3])::INT AS idx, unnest([{", ".join(MEASURES)}]) AS x,
                  (1 + l_linenumber)::DOUBLE AS w FROM lineitem)
SELECT l_returnflag, idx, count(*)::DOUBLE AS count, round(sum(w * x) / sum(w), 7) AS mean,
       round(sum(w * x), 2) AS sum, round(sum(w * abs(x)), 2) AS norm_l1
FROM w GROUP BY l_returnflag, idx""")
def vector_summary_weighted(spark, sf):
    df = assemble(
        table(spark, sf, "lineitem", [*MEASURES, "l_returnflag", "l_linenumber"]), MEASURES
    ).withColumn("w", 1.0 + F.col("l_linenumber"))
    names = ["mean", "sum", "count", "normL1"]
    out = df.groupBy("l_returnflag").agg(summary("features", names, "w").alias("s"))
    rows = _opened(out, names, ["l_returnflag"])
    rows = round_all(rows, ["mean"], 7)
    return round_all(rows, ["sum", "norm_l1"], 2)


CHI_SQL = """
WITH v AS (
  SELECT unnest([0, 1])::INT AS idx, unnest([l_linenumber::DOUBLE, l_discount]) AS x, l_returnflag AS y FROM lineitem),
o AS (SELECT idx, x, y, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
m AS (SELECT idx, x, y, n, sum(n) OVER (PARTITION BY idx, x) AS nx, sum(n) OVER (PARTITION BY idx, y) AS ny,
             sum(n) OVER (PARTITION BY idx) AS nn FROM o)
SELECT idx AS "featureIndex", round(sum((n - nx * ny / nn) * (n - nx * ny / nn) / (nx * ny / nn)), 6) AS statistic,
       ((count(DISTINCT x) - 1) * (count(DISTINCT y) - 1))::INT AS "degreesOfFreedom"
FROM m GROUP BY idx"""


def _flags(spark, sf):
    """Return flags as numbers, by a rule on the letter rather than a fitted index."""
    df = table(spark, sf, "lineitem", ["l_linenumber", "l_discount", "l_returnflag"])
    return assemble(
        df.withColumn("label", F.ascii("l_returnflag").cast("double")), ["l_linenumber", "l_discount"],
        keep=["label"],
    )


@query(CHI_SQL)
def chi_square_test(spark, sf):
    out = stats.chi_square_test(_flags(spark, sf), "features", "label", flatten=True)
    return round_all(out.select("featureIndex", "statistic", "degreesOfFreedom"), ["statistic"])


@query("""
WITH p AS (SELECT corr(l_quantity, l_extendedprice) AS qp, corr(l_quantity, l_discount) AS qd,
                  corr(l_quantity, l_tax) AS qt, corr(l_extendedprice, l_discount) AS pd,
                  corr(l_extendedprice, l_tax) AS pt, corr(l_discount, l_tax) AS dt FROM lineitem)
SELECT unnest([0,0,0,1,1,2])::INT AS i, unnest([1,2,3,2,3,3])::INT AS j,
       round(unnest([qp,qd,qt,pd,pt,dt]), 9) + 0.0 AS value FROM p""")
def correlation_pearson(spark, sf):
    out = stats.correlation(line_vectors(spark, sf), "features")
    return round_all(out.filter("i < j"), ["value"], 9)


SPEARMAN_SQL = """
WITH r AS (SELECT {ranks} FROM lineitem)
SELECT 0::INT AS i, 1::INT AS j, round(corr(r0, r1), 9) + 0.0 AS value FROM r
UNION ALL SELECT 0, 2, round(corr(r0, r2), 9) + 0.0 FROM r
UNION ALL SELECT 1, 2, round(corr(r1, r2), 9) + 0.0 FROM r""".format(
    ranks=", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r{i}"
        for i, c in enumerate(["l_quantity", "l_discount", "l_tax"])
    )
)


@query(SPEARMAN_SQL)
def correlation_spearman(spark, sf):
    """From distinct values and their counts: the columns hold few values, many times each."""
    df = table(spark, sf, "lineitem", ["l_quantity", "l_discount", "l_tax"])
    out = stats.rank_correlation(df, ["l_quantity", "l_discount", "l_tax"])
    return round_all(out.filter("i < j"), ["value"], 9)


@query()
def kolmogorov_smirnov_test(spark, sf):
    df = table(spark, sf, "lineitem", ["l_quantity"])
    return stats.kolmogorov_smirnov_test(df, "l_quantity", "norm", 25.0, 14.0)
