"""Ranks over groups in pieces against the plain window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators.windows import _by_range, ranked, top_k_per


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows have one key; values repeat and some are NULL; one key is NULL."""
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        key = rnd.choice(["hot"] * 5 + ["a", "b", "c", None])
        value = None if rnd.random() < 0.02 else rnd.randrange(200)
        data.append((key, value, i, float(i)))
    return spark.createDataFrame(data, "k string, v int, id int, x double").repartition(5)


def test_small_groups_give_the_same(skewed, rows):
    """By the window functions where no group is large, by pieces where one is: the same rows and types."""
    names = dict(row_number="rn", rank="rk", dense_rank="dr", lag=("x", 2, "lg"))
    whole, pieces = (ranked(skewed, ["k"], "v", ["id"], **names, group_rows=n) for n in (1 << 20, 100))
    assert "_range" not in whole._jdf.queryExecution().toString() and "_range" in pieces._jdf.queryExecution().toString()
    assert whole.dtypes == pieces.dtypes and rows(whole) == rows(pieces)
    assert rows(ranked(skewed, ["k"], "v", ["id"], rank="rk")) == rows(ranked(skewed, ["k"], "v", ["id"], rank="rk", group_rows=0))


@pytest.mark.parametrize("ranges", [1, 4, 40])
def test_ranks_of_groups_in_pieces(spark, skewed, rows, ranges):
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranked(skewed, ["k"], "v", ["id"], row_number="rn", rank="rk", dense_rank="dr", lag=("x", 2, "lg"), group_rows=0)
        w, by_value = Window.partitionBy("k").orderBy("v", "id"), Window.partitionBy("k").orderBy("v")
        want = skewed.select(
            "*", F.row_number().over(w).alias("rn"), F.rank().over(by_value).alias("rk"),
            F.dense_rank().over(by_value).alias("dr"), F.lag("x", 2).over(w).alias("lg"))
        assert got.columns == want.columns
        assert rows(got) == rows(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_key_and_one_value_for_half_of_the_rows(spark, rows):
    """Equal rows lie in several ranges; ranks and lags agree, and no range holds much more than its share."""
    data = spark.range(4000).selectExpr(
        "if(id % 2 = 0, 'hot', cast(id % 50 as string)) AS k", "if(id % 2 = 0, 1, cast(id % 7 as int)) AS v", "id")
    spark.conf.set("spark.sql.shuffle.partitions", 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in _by_range(data, ["k"], "v", []).groupBy("_range").count().collect()]
        assert len(sizes) >= 18 and max(sizes) < 2.5 * 4000 / 20
        got = ranked(data, ["k"], "v", ["id"], rank="rk", dense_rank="dr", lag=("id", 300, "lg"), group_rows=0)
        w, by_value = Window.partitionBy("k").orderBy("v", "id"), Window.partitionBy("k").orderBy("v")
        want = data.select("*", F.rank().over(by_value).alias("rk"), F.dense_rank().over(by_value).alias("dr"),
                           F.lag("id", 300).over(w).alias("lg"))
        assert rows(got) == rows(want)
        plan = got._jdf.queryExecution().toString()
        assert "BROADCAST)" not in plan and "broadcast)" not in plan.lower().split("== analyzed")[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_top_k(skewed, rows):
    best = top_k_per(skewed, ["k"], [F.desc_nulls_last("v"), F.asc("id")], 2)
    assert best.groupBy("k").count().agg(F.max("count")).first()[0] == 2
