"""Mergeable distinct counts, sets as bitmaps and rows, SQL functions, and the certificate of a fit."""

import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lakeloom.functions import sql_functions
from lakeloom.operators import sketches
from lakeloom.plans import learning


@pytest.fixture(scope="module")
def visits(spark):
    """(day, who, sort): a third of all rows is one visitor; some are missing, some numbers are large."""
    rng = random.Random(1)
    rows = [(rng.randint(1, 5), 7 if rng.random() < 0.3 else rng.choice([None, 0, 1, 32768, 32769, 65536, 10**12, rng.randint(0, 9000)]),
             rng.choice(["a", None, "b"])) for _ in range(6000)]
    return spark.createDataFrame(rows, "day int, who long, sort string").repartition(4).cache()


def sets_of(df, *keys):
    out = {}
    for r in df.collect():
        out.setdefault(tuple(r[k] for k in keys), set())
        if r.who is not None:
            out[tuple(r[k] for k in keys)].add(r.who)
    return out


def test_sketches_merge_to_coarser_keys(spark, visits, tmp_path):
    sketches.distinct_sketches(visits, "who", ["day", "sort"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 15
    for keys in (["day"], ["sort"], []):
        exact = visits.groupBy(*keys).agg(F.count_distinct("who").alias("n_exact"))
        got = sketches.beside_exact(sketches.estimated(sketches.merged_sketches(stored, keys)), exact, keys).collect()
        want = {k: len(v) for k, v in sets_of(visits, *keys).items()}
        assert all(want[tuple(r[k] for k in keys)] == r.n_exact and abs(r.error) < 0.07 for r in got)
        assert len(got) == (2 if keys == ["sort"] else len(want))  # a missing key joins nothing


def test_bitmaps_hold_the_same_sets(spark, visits, rows):
    sets = sketches.bitmaps(visits, "who", "day", "sort")
    assert sets.select(F.max(F.length("bitmap"))).first()[0] == 4096
    for keys in (["day", "sort"], ["day"], []):
        merged = sketches.merged_bitmaps(sets, *keys)
        want = sets_of(visits, *keys)
        got = {}
        for r in sketches.members(merged, *keys).collect():
            got.setdefault(tuple(r[k] for k in keys), []).append(r.value)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
        assert {tuple(r[k] for k in keys): r.n for r in sketches.set_sizes(merged, *keys).collect()} == {k: len(v) for k, v in want.items()}
    assert rows(sketches.distinct_rows(visits, "who", "sort")) == sorted(
        ((k, v) for (k,), values in sets_of(visits, "sort").items() for v in values), key=repr)


def test_sets_of_no_rows(spark):
    none = spark.createDataFrame([], "k int, v long")
    assert sketches.members(sketches.bitmaps(none, "v", "k"), "k").collect() == []
    assert sketches.estimated(sketches.merged_sketches(sketches.distinct_sketches(none, "v", ["k"]), ["k"])).collect() == []
    negative = spark.createDataFrame([(1, -5)], "k int, v long")
    assert sketches.bitmaps(negative, "v", "k").collect() == []


def test_sql_calls_registered_functions(spark, rows):
    assert "percent_change" in sql_functions.register(spark) and sql_functions.register(spark)
    one = lambda sql: spark.sql(f"SELECT {sql}").first()[0]
    assert one("clean_label(NULL)") == "UNKNOWN" and one("clean_label('  a b ')") == "a b"
    assert [one(f"percent_change({x})") for x in ("3, 2", "1, 0", "NULL, 2", "1, NULL")] == [50.0, 0.0, 0.0, 0.0]
    assert one("as_features(1, NULL, 3)") == [1.0, 3.0] and one("as_features(5)") == [5.0]
    assert [one(f"protocol_of({x})") for x in ("80, 443", "1, 443", "1, 2")] == ["HTTP", "HTTPS", "OTHER"]
    assert rows(spark.sql("SELECT token FROM VALUES (' a  b\tc '), ('') AS t(line), LATERAL tokens_of(line)")) == [("a",), ("b",), ("c",)]
    plan = spark.sql("SELECT clean_label(x) FROM VALUES ('a'), (NULL) AS t(x)")._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_a_gradient_tells_a_fit_from_none(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(400):
        x = [rng.gauss(0, 1), rng.gauss(3, 10), 1.0]
        rows.append((x, float(x[0] + 0.05 * x[1] + rng.gauss(0, 1) > 0)))
    data = spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")

    def steepest(reg, **settings):
        model = learning.fit_logistic(data, LogisticRegression(**settings), regParam=reg, elasticNetParam=0.0)
        found = learning.logistic_gradient(model, data, reg).collect()
        assert sorted(r["at"] for r in found) == [-1, 0, 1, 2]
        return max(abs(r.gradient) for r in found)

    assert steepest(0.05, maxIter=100, tol=1e-10) < 1e-5
    assert steepest(0.0, maxIter=100, tol=1e-10) < 1e-5
    assert steepest(0.05, maxIter=0) > 0.05  # the best constant predictor
    assert steepest(0.05, maxIter=2) > 1e-4


def test_no_bitmap_is_shuffled_or_sorted(spark):
    """Bitmaps are made above the last exchange, out of rows that come once."""
    rows = spark.createDataFrame([(1, 5), (1, 5), (1, 40000), (2, 5), (None, 7), (2, -1), (2, None)], "k int, v long")
    sets = sketches.bitmaps(rows, "v", "k")
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("bitmap_construct_agg") < min(plan.index("Exchange"), plan.index("Sort ["))
    assert {r.k: r.n for r in sketches.set_sizes(sets, "k").collect()} == {1: 2, 2: 1, None: 1}
