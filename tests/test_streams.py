"""Late, refused and dated events in bounded batches with restarts."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import event_queries
from lakeloom.sources.writers import write_mart_batch
from lakeloom.streaming import dedup, jobs, promotions

START = datetime(2024, 3, 1)


def send(spark, folder, *events):
    """Append (id, hour, extra...) events to the landing folder."""
    rows = [(i, None if hour is None else START + timedelta(hours=hour), i or "-", "x") for i, hour in events]
    spark.createDataFrame(rows, "id string, ts timestamp, event string, outcome_of string").coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def run(spark, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))

    def go(*events):
        send(spark, source, *events)
        with dedup.keyed_state(spark):
            told = dedup.first_and_late(jobs.read_files(spark, source, max_files=1), "id", "ts", "3 hours")
            jobs.write_files(told, out, progress, stop_on_empty=True, by=[dedup.OUTCOME]).awaitTermination()
        back = spark.read.parquet(out)
        return {o: sorted((r.id or "-", r.event) for r in back.where(F.col("outcome") == o).collect()) for o in ("first", "late")}

    return go


def test_late_events_leave_on_their_own_output(run):
    got = run(("a", 0), ("a", 0), ("b", 1), (None, 0), (None, 0), ("t", None), ("t", None))
    assert got == {"first": sorted([("a", "a"), ("b", "b"), ("-", "-"), ("-", "-"), ("t", "t"), ("t", "t")]), "late": []}
    # A restart; "a" is known, "c" is on time. The watermark then stands at 20 - 3 hours and forgets all of them but "d".
    got = run(("a", 0), ("c", 2), ("d", 20))
    assert [i for i, _ in got["first"] if i in "abcd"] == ["a", "b", "c", "d"] and not got["late"]
    # Once more: "a" and "c" can no longer be compared, "z" is new and late, "d" is known, "e" is on time.
    got = run(("a", 0), ("c", 2), ("z", 3), ("z", 3), ("d", 20), ("e", 18))
    assert got["late"] == [("a", "a"), ("c", "c"), ("z", "z"), ("z", "z")]
    assert [i for i, _ in got["first"] if i in "abcdez"] == ["a", "b", "c", "d", "e"]
    # Counts stay exact however many runs there were.
    for i in range(2):
        got = run((f"old{i}", 1), (f"new{i}", 21))
    assert len(got["late"]) == 6 and ("old0", "old0") in got["late"]


def test_a_hot_id_comes_out_once(run):
    got = run(*[("hot", h % 3) for h in range(3000)], *[(str(i), 1) for i in range(20)])
    assert len(got["first"]) == 21 and got["late"] == []


def test_late_output_is_for_streams(spark):
    with pytest.raises(ValueError):
        dedup.first_and_late(spark.range(1).selectExpr("id", "current_timestamp() AS ts"), "id", "ts", "1 hour")


def test_state_store_setting_is_put_back(spark):
    key = next(iter(dedup.STATE_STORE))
    before = spark.conf.get(key, None)
    with dedup.keyed_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before


def test_promotions_and_sales_meet_in_time(spark, tmp_path):
    day = lambda n: (START + timedelta(days=n)).date()
    promo, sold = "store_id bigint, item_id bigint, date date, price double, discount double", \
        "store_number bigint, item_number bigint, sale_date date, revenue double"

    def go(promos, sales):
        spark.createDataFrame(promos, promo).coalesce(1).write.mode("append").parquet(str(tmp_path / "promos"))
        spark.createDataFrame(sales, sold).coalesce(1).write.mode("append").parquet(str(tmp_path / "sales"))
        joined = promotions.promo_join_in_time(
            jobs.read_files(spark, str(tmp_path / "promos")), jobs.read_files(spark, str(tmp_path / "sales")), days=3, delay="2 days")
        jobs.write_batches(joined, write_mart_batch(str(tmp_path / "mart")), str(tmp_path / "cp"), stop_on_empty=True).awaitTermination()
        back = spark.read.parquet(str(tmp_path / "mart"))
        return sorted((r.store_number, r.revenue) for r in back.collect() if r.store_number > 0) if back.columns else []

    # The sale of promotion 1 comes on its last day, that of 2 a day too late, that of 3 a day before it starts.
    got = go([(1, 7, day(1), 10.0, 0.5), (2, 7, day(1), 10.0, 0.0), (3, 7, day(1), 10.0, 0.0)],
             [(1, 7, day(3), 1.0), (2, 7, day(4), 2.0), (3, 7, day(0), 3.0), (1, 8, day(1), 9.0)])
    assert got == [(1, 1.0)]
    # After a restart a sale meets a promotion that came before, and one that comes after it.
    got = go([(4, 7, day(2), 1.0, 0.0)], [(2, 7, day(2), 4.0), (4, 7, day(4), 5.0), (5, 7, day(5), 6.0)])
    assert got == [(1, 1.0), (2, 4.0), (4, 5.0)]
    got = go([(5, 7, day(4), 1.0, 0.0), (-1, -1, day(90), 1.0, 0.0)], [(-1, -1, day(60), 0.0)])
    assert got == [(1, 1.0), (2, 4.0), (3, None), (4, 5.0), (5, 6.0)] or got == sorted(
        [(1, 1.0), (2, 4.0), (3, None), (4, 5.0), (5, 6.0)], key=repr)


def test_enrich_runs_in_bounded_batches_with_a_restart(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(event_queries, "workspace", lambda s, label: str(tmp_path / label))
    rows = event_queries.stream_enrich(spark, small).collect()
    commits = [p for p in Path(tmp_path / "enrich/progress/commits").iterdir() if p.name.isdigit()]
    assert len(commits) >= 4
    n = spark.read.parquet(f"{small}/events.parquet")
    refused = sum(r.id is None and r.event_type.startswith('{"id":"') and '"k":9' in r.event_type for r in rows)
    assert refused > 10 and len(rows) < n.count()


def test_landing_files_do_not_grow_with_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(event_queries, "FILE_ROWS", 100)
    rows = spark.range(1000).repartition(40)
    assert event_queries.deliver(rows, str(tmp_path / "few"), files=6) == 10
    assert event_queries.deliver(rows.limit(30), str(tmp_path / "least"), files=6) == 6
    assert event_queries.deliver(rows.limit(0), str(tmp_path / "none"), files=1) == 1
    sizes = {k: len(list((tmp_path / k).glob("part-*.parquet"))) for k in ("few", "least", "none")}
    assert sizes == {"few": 10, "least": 6, "none": 1}
    assert spark.read.parquet(str(tmp_path / "few")).distinct().count() == 1000


def test_dedup_batches_do_not_grow_with_tasks(spark, small, tmp_path, monkeypatch):
    source = spark.read.parquet(f"{small}/events.parquet").repartition(16)
    source.write.parquet(str(tmp_path / "in/events.parquet"))
    monkeypatch.setattr(event_queries, "workspace", lambda s, label: str(tmp_path / label))
    assert event_queries.stream_dedup(spark, str(tmp_path / "in")).count() > 0
    files = len(list((tmp_path / "dedup/arrived").glob("part-*.parquet")))
    batches = [p for p in (tmp_path / "dedup/progress/offsets").iterdir() if p.name.isdigit()]
    assert files == 4 and len(batches) <= 8
