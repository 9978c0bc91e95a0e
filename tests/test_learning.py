"""Model fits on small data."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lakeloom.plans import learning


@pytest.fixture
def training(spark):
    """Two classes apart in the first feature."""
    return spark.createDataFrame([
        (float(i % 2), Vectors.dense(3.0 * (i % 2) + i / 10, -i / 5, 1.0)) for i in range(8)], ["label", "features"])


def test_parameters_can_be_overridden_for_one_fit(training):
    lr = LogisticRegression(maxIter=10, regParam=0.01)
    model = learning.fit_logistic(training, lr, maxIter=30, regParam=0.1, threshold=0.55, probabilityCol="p")
    used = learning.params_used(model)
    assert (used["maxIter"], used["regParam"], used["threshold"], used["probabilityCol"]) == (30, 0.1, 0.55, "p")
    assert lr.getMaxIter() == 10
    scored = learning.score(model, training, "label", "p", "prediction")
    assert all(r.label == r.prediction for r in scored.collect())
    assert "maxIter" in learning.explain(lr)


def test_forest_learns_a_rule_and_accepts_unseen_categories(spark):
    data = spark.range(400).select(
        (F.col("id") % 2).cast("float").alias("y"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"),
        F.when(F.col("id") == 7, "rare").otherwise("usual").alias("d"), (F.col("id") % 5).cast("float").alias("x"), F.col("id").alias("key"))
    model, scored = learning.fit_forest(data, "y", "key", ["c", "d"], ["x"])
    assert learning.accuracy(scored, "y") == 1.0
    unseen = spark.createDataFrame([(0.0, "zzz", "new", 1.0)], "y double, c string, d string, x double")
    assert model.transform(unseen).count() == 1


def test_linear_regression_at_two_strengths(spark):
    data = learning.single_feature(
        spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") * 3 + 1).alias("y")).unionByName(
            spark.createDataFrame([(None, 5)], "x double, y bigint")), "x", "y")
    assert data.count() == 100
    exact, shrunk = learning.fit_linear(data)
    assert exact.coefficients[0] == pytest.approx(3.0)
    assert learning.rmse(exact.transform(data)) == pytest.approx(0.0, abs=1e-6)
    assert learning.rmse(shrunk.transform(data)) > 1


def test_vector_expression(spark):
    df = spark.range(1).select(learning.as_vector(F.lit(2.5), F.lit(3)).alias("v"))
    assert df.first().v == Vectors.dense(2.5, 3)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
