"""Classification and regression with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_logistic(training: DataFrame, estimator: LogisticRegression, **overrides: Any) -> LogisticRegressionModel:
    """Fit with the estimator's parameters, any of which ``overrides`` replaces for this fit alone."""
    return estimator.fit(training, {estimator.getParam(name): v for name, v in overrides.items()})


def score(model: Transformer, data: DataFrame, *columns: str) -> DataFrame:
    scored = model.transform(data)
    return scored.select(*columns) if columns else scored


def logistic_gradient(model: LogisticRegressionModel, data: DataFrame, reg: float) -> DataFrame:
    """``at, gradient``: the derivative of the fitted loss by each coefficient (of the scaled features) and, as -1, by the intercept.

    At the optimum all are zero. ``data`` has ``features`` and ``label``; the loss is the mean log loss and ``reg`` / 2 times the squared
    coefficients. Every task adds up its own rows, one sum per coefficient.
    """
    weights = model.coefficients.toArray().tolist()
    scored = model.transform(data).select(
        (F.element_at(vector_to_array("probability"), 2) - F.col("label")).alias("off"), vector_to_array("features").alias("x"))
    each = scored.select("off", F.posexplode(F.concat(F.col("x"), F.array(F.lit(1.0)))).alias("at", "x"))
    sums = each.groupBy("at").agg(F.avg(F.col("off") * F.col("x")).alias("slope"), F.stddev_samp("x").alias("scale"))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("at"))
    inner = F.coalesce(F.try_divide("slope", "scale"), F.lit(0.0)) + reg * weight * F.col("scale")
    last = F.col("at") == len(weights)
    return sums.select(F.when(last, -1).otherwise(F.col("at")).alias("at"), F.when(last, F.col("slope")).otherwise(inner).alias("gradient"))


def explain(estimator: Estimator) -> str:
    return estimator.explainParams()


def params_used(model: Transformer) -> dict[str, Any]:
    return {param.name: value for param, value in model.extractParamMap().items()}


def forest_stages(label: str, categories: Sequence[str], numbers: Sequence[str], seed: int,
                    max_depth: int = 5) -> Pipeline:
    """Index categories (unseen ones get an index of their own), assemble features, grow a forest."""
    indexed = [f"{c}_index" for c in categories]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"),
        VectorAssembler(inputCols=[*numbers, *indexed], outputCol="features"),
        RandomForestClassifier(labelCol=label, featuresCol="features", maxDepth=max_depth, seed=seed),
    ])


def in_sample(key: Column, share: float) -> Column:
    """Whether a row belongs to the sample; decided by its integer key alone, so every evaluation agrees."""
    return F.pmod(F.pmod(key, F.lit(1_000_003)) * 2_654_435_761, F.lit(1 << 32)) < int(share * (1 << 32))


def fit_forest(data: DataFrame, label: str, key: str, categories: Sequence[str], numbers: Sequence[str],
               seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Train on the rows of about 80 percent of the keys; gives the model and the other rows, scored.

    All distinct categories come to the driver: index columns with few of them.
    """
    model = forest_stages(label, categories, numbers, seed).fit(data.where(in_sample(F.col(key), 0.8)))
    return model, model.transform(data.where(~in_sample(F.col(key), 0.8)))


def accuracy(predictions: DataFrame, label: str) -> float:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="accuracy").evaluate(predictions)


def single_feature(df: DataFrame, feature: str, label: str) -> DataFrame:
    """``features, label`` of the rows in which both are set."""
    assembler = VectorAssembler(inputCols=[feature], outputCol="features")
    return assembler.transform(df.select(feature, df[label].cast("double").alias("label")).dropna()).select(
        "features", "label")


def as_vector(*numbers: Column) -> Column:
    """A dense vector of numeric columns, as an expression."""
    return array_to_vector(F.array(*[n.cast("double") for n in numbers]))


def fit_linear(data: DataFrame, reg_params: Sequence[float] = (0.0, 100.0)) -> list[LinearRegressionModel]:
    """One model per regularisation strength."""
    lr = LinearRegression()
    return [lr.fit(data, {lr.regParam: reg}) for reg in reg_params]


def rmse(predictions: DataFrame) -> float:
    return RegressionEvaluator(metricName="rmse").evaluate(predictions)
