"""Registered model fits."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.numbers import MONEY
from lakeloom.plans import learning
from lakeloom.session import workspace
from lakeloom.sources.tables import Tables


def vectors(s, d) -> DataFrame:
    """Embeddings with a binary label: one of the lower five classes, or not."""
    e = Tables(s, d)["embeddings"]
    return e.select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        (F.col("label") < 5).cast("double").alias("label"))


REG, MOST_GRADIENT = 0.02, 1e-4


def ml_logreg(s, d) -> DataFrame:
    """Is the fit at its optimum, and does it tell the lower classes from the upper ones better than guessing the more frequent? One row.

    ``is_optimal``: no derivative of the loss is above ``MOST_GRADIENT``, taken over all rows.
    """
    data = vectors(s, d)
    model = learning.fit_logistic(data, LogisticRegression(maxIter=200, tol=1e-9), regParam=REG, elasticNetParam=0.0)
    scored = learning.score(model, data, "vec_id", "label", "prediction")
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    share = F.avg("label")
    quality = scored.agg(
        F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("n_lower"),
        (right >= F.greatest(share, 1 - share)).alias("beats_majority"))
    steepest = learning.logistic_gradient(model, data, REG).agg(
        F.count("*").alias("n_weights"), (F.max(F.abs("gradient")) <= MOST_GRADIENT).alias("is_optimal"))
    return quality.crossJoin(steepest)  # one row each


def ml_forest(s, d) -> DataFrame:
    """Do an order's lines come to more than 150,000? One row: test rows, large ones, and whether the forest beats the majority."""
    t = Tables(s, d)
    lines = t["lineitem"].groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_quantity")).alias("quantity"),
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("price"))
    path = workspace(s, "forest")
    t["orders"].join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", (F.col("price") > 150000).cast("float").alias("large"),
        F.col("n_lines").cast("float"), F.col("quantity").cast("float"), "o_orderstatus", "o_orderpriority").write.parquet(path)
    _, scored = learning.fit_forest(
        s.read.parquet(path), "large", "o_orderkey", ["o_orderstatus", "o_orderpriority"], ["n_lines", "quantity"])
    share = F.avg("large")
    right = F.avg((F.col("prediction") == F.col("large")).cast("double"))
    return scored.agg(
        F.count("*").alias("n_test"), F.sum(F.col("large").cast("long")).alias("n_large"),
        (right >= F.greatest(share, 1 - share)).alias("beats_majority"))


def ml_linreg(s, d) -> DataFrame:
    """Price of an order line by its quantity, at two regularisation strengths."""
    data = learning.single_feature(Tables(s, d)["lineitem"], "l_quantity", "l_extendedprice")
    models = learning.fit_linear(data, (0.0, 100.0))
    reports = [
        model.transform(data).agg(F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).alias("rmse"))
        .select(F.lit(float(reg)).alias("reg_param"), F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
                F.round("rmse", 4).alias("rmse"))
        for reg, model in zip((0.0, 100.0), models)]
    return reports[0].unionByName(reports[1])


QUERIES = {"ml_logreg": ml_logreg, "ml_forest": ml_forest, "ml_linreg": ml_linreg}

# Ridge regression on one feature in closed form: on standardised columns the slope is the
# correlation divided by 1 + reg / stddev(label).
ORACLES = {
    "ml_logreg": """SELECT count(*) AS n, CAST(sum(CAST(label < 5 AS INTEGER)) AS BIGINT) AS n_lower, true AS beats_majority,
  CAST(max(len(embedding)) + 1 AS BIGINT) AS n_weights, true AS is_optimal FROM embeddings""",
    "ml_forest": """SELECT count(*) AS n_test, CAST(sum(CAST(price > 150000 AS INTEGER)) AS BIGINT) AS n_large,
  true AS beats_majority FROM orders
JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS price FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
WHERE o_orderkey % 1000003 * 2654435761 % 4294967296 >= 3435973836""",
    "ml_linreg": """WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my,
  stddev_pop(l_quantity) AS sx, stddev_pop(l_extendedprice) AS sy, corr(l_extendedprice, l_quantity) AS r
  FROM lineitem),
f AS (SELECT reg AS reg_param, r * sy / sx / (1 + reg / sy) AS slope, mx, my
  FROM m, (VALUES (CAST(0 AS DOUBLE)), (CAST(100 AS DOUBLE))) AS regs(reg))
SELECT reg_param, round(slope, 4) AS slope,
  (SELECT round(sqrt(avg((l_extendedprice - my - slope * (l_quantity - mx)) ** 2)), 4) FROM lineitem) AS rmse FROM f""",
}
