"""State of stream deduplication: a value per batch, whatever the number of keys."""

from types import SimpleNamespace

import pytest
from pyspark.sql import Row

from lakeloom.streaming import dedup, jobs


def test_nested_keys(spark, tmp_path):
    rows = spark.sql("""SELECT named_struct('a', a, 'at', timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, b / 1000000)) AS id,
        timestamp'2024-03-01' AS ts, a, b FROM VALUES (1, 1), (1, 2), (2, 1), (1, 1), (NULL, 1), (NULL, 1) AS v(a, b)""")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        with dedup.keyed_state(spark):
            told = dedup.first_and_late(jobs.read_files(spark, str(tmp_path / "in"), max_files=1), "id", "ts", "3 hours")
            jobs.write_files(told, str(tmp_path / "out"), str(tmp_path / "progress"), stop_on_empty=True).awaitTermination()
        got = [(r.a, r.b, r.outcome) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
        assert sorted(got, key=repr) == sorted([(a, b, "first") for a, b in ((1, 1), (1, 2), (2, 1), (None, 1))], key=repr)


class Values(list):
    get = list.__iter__
    appendValue = list.append  # noqa: N815
    appendList = list.extend   # noqa: N815

    def put(self, values):
        self[:] = values


@pytest.mark.parametrize("name", [lambda i: i, lambda i: f"k{i}", lambda i: bytes([i % 256, i // 256])])
def test_a_batch_adds_one_value_to_the_state(name):
    values, timers = Values(), []
    processor = dedup.FirstOfKey(1600)
    processor.init(SimpleNamespace(getListState=lambda *a: values, registerTimer=timers.append))
    at = SimpleNamespace(getCurrentWatermarkInMs=lambda: 500)
    batch = lambda *numbers: iter([Row(key=name(i), at=1000 + i, event=i) for i in numbers])
    assert [r.event for r in processor.handleInputRows(None, batch(*range(1000), *range(1000)), at)] == list(range(1000))
    assert len(values) == 1
    assert [r.event for r in processor.handleInputRows(None, batch(*range(900, 1100)), at)] == list(range(1000, 1100))
    assert len(values) == 2
    assert list(processor.handleInputRows(None, batch(*range(1100)), at)) == [] and len(values) == 2
    late = iter([Row(key=name(5000), at=400, event=7), Row(key=name(3), at=400, event=8)])
    assert [(r.event, r.outcome) for r in processor.handleInputRows(None, late, at)] == [(7, dedup.LATE)]
    list(processor.handleExpiredTimer(None, at, SimpleNamespace(getExpiryTimeInMs=lambda: 2000 + 500 + 1600 - 1000)))
    assert len(values) == 1 and [k for k, _ in processor._kept()] == [name(i) for i in range(501, 1100)]
    values.clear()
