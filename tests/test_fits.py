"""A stream broken off and taken up again, and models that models know."""

import pytest

from millrace.catalog import QUERIES
from millrace.functions.tables import attribute, learned_model
from millrace.functions.vectors import array_to_vector
from millrace.operators import clustering, feature, regression
from millrace.plans.verbs import pipeline
from millrace.session import scratch_path
from millrace.streaming import score_folder

TABLES = "/root/testdata/sf0.001"


def test_a_folder_is_scored_once_and_taken_up_again(spark, points):
    source, to, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    data = points.selectExpr("x1", "array(x2) AS a", "label")
    vectors = lambda df: df.withColumn("v", array_to_vector("a"))
    model = pipeline([
        feature.vector_assembler(input_cols=["x1", "v"], output_col="features"), regression.linear_regression(reg_param=0.1),
    ]).fit(vectors(data))
    stream = lambda: spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(source)
    score = lambda: score_folder(model, stream(), to, state, ["x1", "label", "prediction"], {"v": 1}, vectors)
    data.where("label = 0").write.parquet(source)
    first = score().collect()
    assert len(first) == data.where("label = 0").count()
    assert sorted(score().collect()) == sorted(first)  # nothing new: nothing is written again
    data.where("label = 1").write.mode("append").parquet(source)
    whole = model.transform(vectors(data)).select("x1", "label", "prediction")
    assert sorted(score().collect()) == sorted(whole.collect())


def test_vectors_of_another_length_stop_the_stream(spark, points):
    source = scratch_path(spark, "in")
    data = points.selectExpr("array(x1) AS a", "label")
    data.write.parquet(source)
    vectors = lambda df: df.withColumn("v", array_to_vector("a"))
    model = pipeline([feature.vector_assembler(input_cols=["v"], output_col="features"), regression.linear_regression()]).fit(vectors(data))
    stream = spark.readStream.schema(data.schema).parquet(source)
    with pytest.raises(Exception, match="(?s)[Ss]ize|vector"):
        score_folder(model, stream, scratch_path(spark, "out"), scratch_path(spark, "state"), ["prediction"], {"v": 2}, vectors)


def test_the_local_form_of_a_topic_model(spark, texts):
    counted = feature.count_vectorizer(input_col="words", output_col="features").fit(texts).transform(texts)
    model = clustering.lda(k=2, max_iter=3, optimizer="em", seed=1).fit(counted)
    local = learned_model(model, "to_local")
    assert not local.isDistributed() and model.isDistributed()
    assert attribute(model, "to_local").collect() == attribute(local, "topics_matrix").collect()
    assert attribute(local, "log_likelihood", counted).first()[0] == pytest.approx(attribute(model, "log_likelihood", counted).first()[0])
    assert attribute(model, "training_log_likelihood").first()[0] < 0
    with pytest.raises(TypeError, match="no model"):
        learned_model(model, "vocab_size")


def test_blocks_of_many_suppliers_stay_communities(spark, tmp_path):
    """Sixty times the suppliers: a nation's own do not hold a walk back from its block."""
    for table in ("supplier", "nation"):
        spark.read.parquet(f"{TABLES}/{table}.parquet").createOrReplaceTempView(table)
    spark.sql("SELECT s.* EXCEPT (s_suppkey), s_suppkey + 1000 * r.id AS s_suppkey FROM supplier s CROSS JOIN range(600) r").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.table("nation").write.parquet(f"{tmp_path}/nation.parquet")
    row = QUERIES["power_iteration_communities"](spark, str(tmp_path)).first()
    assert row.recovered and row.clusters == 2 and row.vertices == 600 * spark.table("supplier").count() + 25


@pytest.mark.parametrize("files", [1, 3, 11])
def test_a_mixture_does_not_depend_on_how_the_table_is_cut(spark, tmp_path, files):
    lines = spark.read.parquet(f"{TABLES}/lineitem.parquet").select("l_returnflag", "l_quantity")
    lines.repartition(files).write.parquet(f"{tmp_path}/lineitem.parquet")
    row = QUERIES["gaussian_mixture_apart"](spark, str(tmp_path)).first()
    assert (row.n, row.components, row.confident, row.weights_whole) == (lines.count(), 3, True, True)


@pytest.mark.parametrize("name", ["lda", "lda_shares", "lda_fit_quality"])
def test_topic_fits_read_a_table_of_counts(spark, name, monkeypatch):
    """Not the texts, which they would cut anew at every step."""
    from pyspark.ml.clustering import LDA

    plans, fit = [], LDA.fit
    monkeypatch.setattr(LDA, "fit", lambda self, df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or fit(self, df))
    QUERIES[name](spark, TABLES)
    assert len(plans) == 1 and "text" not in plans[0] and "RDD" in plans[0]


@pytest.mark.parametrize("name", ["lda_em_state", "lda_topics"])
def test_a_topic_graph_is_cut_by_its_edges(spark, name, monkeypatch):
    """Not by the table's files: a task builds a bounded number of edges, and all documents are there."""
    from millrace.catalog import clusters
    from pyspark.ml.clustering import LDA

    monkeypatch.setattr(clusters, "EDGES", 1000)
    seen, fit = [], LDA.fit
    most = lambda df: df.rdd.map(lambda r: r.features.numNonzeros()).glom().map(lambda n: (len(n), sum(n))).collect()
    monkeypatch.setattr(LDA, "fit", lambda self, df: seen.append(most(df)) or fit(self, df))
    QUERIES[name](spark, TABLES)
    assert sum(n for n, _ in seen[0]) == spark.read.parquet(f"{TABLES}/documents.parquet").count()
    assert len(seen[0]) >= sum(edges for _, edges in seen[0]) / 1000


@pytest.mark.parametrize("kind", ["", "_deviance", "_response", "_working"])
def test_a_poisson_fit_goes_over_pooled_rows(spark, kind, monkeypatch):
    from pyspark.ml.regression import GeneralizedLinearRegression as Glm

    sizes, fit = [], Glm.fit
    monkeypatch.setattr(Glm, "fit", lambda self, df: sizes.append((df.count(), df.agg({"weight": "sum"}).first()[0])) or fit(self, df))
    documents = spark.read.parquet(f"{TABLES}/documents.parquet").count()
    assert QUERIES[f"generalized_linear_regression_residuals{kind}"](spark, TABLES).count() == documents
    assert sizes[0][0] < documents and sizes[0][1] == documents


@pytest.mark.parametrize("name", ["robust_scaler_prices", "imputer_median_prices"])
def test_exact_quartiles_are_not_sketched_from_all_rows(spark, name, monkeypatch):
    from pyspark.ml.feature import Imputer, RobustScaler

    seen = []
    for kind in (Imputer, RobustScaler):
        monkeypatch.setattr(kind, "fit", lambda self, df, fit=kind.fit: seen.append(df.count()) or fit(self, df))
    assert len(QUERIES[name](spark, TABLES).collect()) == 1
    assert seen[0] <= 3


def test_exact_quantiles(spark):
    from millrace.plans.ordered import exact_quantiles

    values = [5.0, 1.0, 1.0, 1.0, 9.0, None, float("nan"), 2.0, 7.0, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.probability: r.value for r in exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    assert got == {0.0: 1.0, 0.25: 1.0, 0.5: 2.0, 0.75: 5.0, 1.0: 9.0}
    assert [r.value for r in exact_quantiles(df.where("v < 0"), "v", [0.5]).collect()] == [None]


@pytest.mark.parametrize("name", ["power_iteration_clustering", "power_iteration_coverage", "rule_predictions"])
def test_what_is_read_more_than_once_is_joined_and_grouped_once(spark, name, monkeypatch):
    from pyspark.ml.clustering import PowerIterationClustering
    from pyspark.ml.fpm import FPGrowth

    plans = []
    for kind, step in ((PowerIterationClustering, "assignClusters"), (FPGrowth, "fit")):
        monkeypatch.setattr(kind, step, lambda self, df, run=getattr(kind, step): plans.append(
            df._jdf.queryExecution().optimizedPlan().toString()) or run(self, df))
    QUERIES[name](spark, TABLES)
    assert len(plans) == 1 and "Aggregate" not in plans[0] and "RDD" in plans[0]
