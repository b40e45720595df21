import pytest

from millrace.functions.vectors import array_to_vector
from millrace.operators import feature, regression
from millrace.plans.verbs import pipeline
from millrace.session import scratch_path
from millrace.streaming import score_stream


def test_a_fitted_model_scores_a_stream(spark, points):
    path = scratch_path(spark, "stream")
    data = points.selectExpr("x1", "array(x2, x2 * 2) AS a", "label")
    data.write.parquet(path)
    stages = pipeline([
        feature.vector_assembler(input_cols=["x1", "v"], output_col="features"), regression.linear_regression(reg_param=0.1),
    ])
    model = stages.fit(data.withColumn("v", array_to_vector("a")))
    stream = spark.readStream.schema(data.schema).parquet(path).withColumn("v", array_to_vector("a"))
    scored = score_stream(model, stream, {"v": 2}).select("x1", "prediction")
    assert scored.isStreaming
    run = (scored.writeStream.format("memory").queryName("scored").trigger(availableNow=True)
           .option("checkpointLocation", scratch_path(spark, "offsets")).start())
    run.awaitTermination(120)
    batch = model.transform(data.withColumn("v", array_to_vector("a"))).select("x1", "prediction")
    assert sorted(spark.table("scored").collect()) == sorted(batch.collect())


def test_a_batch_is_refused(spark, points):
    with pytest.raises(ValueError, match="not a streaming frame"):
        score_stream(feature.binarizer(), points)
