"""User reducers over sorted key groups."""

import random
from itertools import groupby

import pytest

from lakeloom.operators import scripts


def plain(rows, reducer):
    """The reducer over the same groups, without Spark."""
    none_first = lambda r: tuple((x is not None, x) for x in r)
    out = []
    for key, group in groupby(sorted(rows, key=none_first), key=lambda r: r[0]):
        out += list(reducer((key,), group))
    return sorted(out, key=repr)


def chained():
    """A reducer that is not associative: every row depends on all before it."""
    def steps(key, rows):
        state = 1
        for row in rows:
            state = (state * 31 + row[1]) % 1009
            yield key[0], row[1], state

    return steps


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_reducer_sees_each_key_once_and_in_order(spark, rows, batch):
    rng, steps = random.Random(2), chained()
    data = [(rng.choice([None, "a", "b", "", "c"]), rng.randint(0, 50)) for _ in range(200)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = scripts.reduce_sorted(
            spark.createDataFrame(data, "k string, n int").repartition(5), ["k"],
            lambda key, parts: steps(key, scripts.rows_of(parts)), "k string, n int, state int", order=["n"])
        assert rows(got) == plain(data, steps)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_several_keys_clashing_names_and_order(spark, rows):
    data = [(i % 3, None if i % 5 == 0 else i % 2, i, f"v{i}") for i in range(60)]
    df = spark.createDataFrame(data, "a int, part int, key int, schema string")

    def ends(key, parts):
        values = [r[2] for r in scripts.rows_of(parts)]
        yield *key, values[0], values[-1], len(values)

    got = scripts.reduce_sorted(df, ["a", "part"], ends, "a int, part int, first int, last int, n int", order=[df["key"].desc()])
    want = {}
    for a, part, key, _ in data:
        want.setdefault((a, part), []).append(key)
    assert rows(got) == sorted(((*k, max(v), min(v), len(v)) for k, v in want.items()), key=repr)


def test_a_reducer_may_stop_early_or_give_nothing(spark, rows):
    df = spark.range(1000).selectExpr("id % 4 AS k", "id")
    got = scripts.reduce_sorted(df, ["k"], lambda key, parts: [next(scripts.rows_of(parts))] if key[0] else [],
                                "k bigint, id bigint", order=["id"])
    assert rows(got) == [(1, 1), (2, 2), (3, 3)]


def test_no_rows(spark):
    df = spark.createDataFrame([], "k int, n int")
    assert scripts.reduce_sorted(df, ["k"], lambda key, parts: [key], "k int").collect() == []


def test_a_hot_key_is_a_stream(spark):
    """A third of all rows have one key: no part is larger than a batch, and the task's memory does not grow with the key."""
    n = 3_000_000

    def watch(key, parts):
        import resource

        start, most, count, last = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, 0, 0, -1
        for part in parts:
            ids = part.column(1)
            assert ids[0].as_py() > last
            most, count, last = max(most, part.num_rows), count + part.num_rows, ids[-1].as_py()
        yield key[0], most, count, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start

    df = spark.range(n).selectExpr("IF(id % 3 = 0, 0, 1 + id % 1000) AS k", "id", "repeat('x', 100) AS pad")
    got = {r.k: r for r in scripts.reduce_sorted(df, ["k"], watch, "k bigint, most bigint, n bigint, grown bigint", ["id"]).collect()}
    hot = got[0]
    assert hot.n == n // 3 and sum(r.n for r in got.values()) == n
    assert hot.most <= 10_000
    assert hot.grown < 100_000  # kB; the key's rows are over 100 MB
