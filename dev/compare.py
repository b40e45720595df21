"""Our form of a job beside the plain Spark ML form of it, in seconds (median of RUNS, warm).

    python dev/compare.py [folder]
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from millrace.catalog.evaluators import BY_LABEL, OVERALL  # noqa: E402
from millrace.catalog.inputs import MEASURES, embedded, lines, rated  # noqa: E402
from millrace.catalog.predictors import DUMMIES, _line_classes, _line_dummies, _pooled  # noqa: E402
from millrace.functions import stats  # noqa: E402
from millrace.functions.vectors import assemble  # noqa: E402
from millrace.operators import classification, clustering, evaluation, feature, recommendation, regression  # noqa: E402
from millrace.plans import recommend, reports, similarity  # noqa: E402
from millrace.plans.scoring import score  # noqa: E402
from millrace.plans.tuning import cross_validator, param_grid  # noqa: E402
from millrace.session import checkpoint_root, local_session  # noqa: E402
from millrace.sources import table  # noqa: E402

RUNS = 3


def run(df):
    df.write.format("noop").mode("overwrite").save()


def seconds(job):
    taken = []
    for _ in range(RUNS + 1):
        began = time.perf_counter()
        job()
        taken.append(time.perf_counter() - began)
    return statistics.median(taken[1:])


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, app="compare", **{"spark.ui.showConsoleProgress": "false"})
    checkpoint_root(spark)
    df = lines(spark, sf, "l_returnflag")
    vectors = assemble(df, MEASURES)

    def pair(what, plain, ours):
        a, b = seconds(plain), seconds(ours)
        print(f"| {what} | {a:.2f} | {b:.2f} | {a / b:.1f}x |", flush=True)

    print("| Job | Spark ML form, s | ours, s | |\n|---|---|---|---|")
    scaler = feature.standard_scaler(input_col="features", output_col="s").fit(vectors)
    pair("score: standard scaler", lambda: run(scaler.transform(vectors)), lambda: run(score(scaler, df, MEASURES)))
    line = regression.linear_regression(label_col="l_extendedprice").fit(vectors)
    pair("score: linear regression", lambda: run(line.transform(vectors).select("prediction")),
         lambda: run(score(line, df, MEASURES)))
    groups = clustering.k_means(k=8, seed=1).fit(vectors)
    pair("score: k-means, 8 centres", lambda: run(groups.transform(vectors).select("prediction")),
         lambda: run(score(groups, df, MEASURES)))
    classes = _line_classes(spark, sf)
    op = classification.logistic_regression(max_iter=100, weight_col="weight")
    pair("fit: logistic regression on indicators",
         lambda: op.fit(assemble(_line_dummies(classes).withColumn("weight", F.lit(1.0)), DUMMIES, keep=["label", "weight"])),
         lambda: op.fit(assemble(_line_dummies(_pooled(classes, "line", "label")), DUMMIES, keep=["label", "weight"])))
    judged = classes.select("label", (F.col("line") % 3).alias("prediction"))
    metrics = [evaluation.multiclass_classification_evaluator(metric_name=m, metric_label=1.0) for m in [*OVERALL, *BY_LABEL]]
    pair("thirteen multiclass metrics", lambda: [m.evaluate(judged) for m in metrics], lambda: run(reports.multiclass(judged)))
    ties = ["l_quantity", "l_discount", "l_tax"]
    tied = table(spark, sf, "lineitem", ties)
    pair("rank correlation of tied columns", lambda: run(stats.correlation(assemble(tied, ties), "features", "spearman")),
         lambda: run(stats.rank_correlation(tied, ties)))
    als = recommendation.als(rank=8, max_iter=3, seed=1).fit(rated(spark, sf))
    pair("top 3 items of every user", lambda: run(als.recommendForAllUsers(3)), lambda: run(recommend.recommend_items(als, 3)))
    points = embedded(spark, sf)
    lsh = feature.bucketed_random_projection_lsh(
        input_col="features", output_col="h", bucket_length=0.2, num_hash_tables=6, seed=1).fit(points)
    raw = table(spark, sf, "embeddings")
    pair("similarity self-join of embeddings",
         lambda: run(similarity.similarity_join(lsh, points, points, 1.0).filter("datasetA.vec_id < datasetB.vec_id")),
         lambda: run(similarity.euclidean_join(lsh, raw, "vec_id", "embedding", 1.0)))
    folded = assemble(df.withColumn("fold", (F.col("l_orderkey") % 3).cast("int")), ["l_quantity", "l_tax"],
                      keep=["l_extendedprice", "fold"])
    fit = regression.linear_regression(label_col="l_extendedprice", solver="normal")
    search = cross_validator(fit, param_grid((fit, {"reg_param": [0.0, 0.1]})),
                             evaluation.regression_evaluator(label_col="l_extendedprice"), fold_col="fold")
    theirs = search.operator()
    pair("three-fold search over two maps", lambda: theirs.fit(folded), lambda: search.fit(folded))
    spark.stop()


if __name__ == "__main__":
    main()
