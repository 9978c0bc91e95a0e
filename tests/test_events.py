"""Event routing, user agents, packets and streaming progress."""

import json

import pytest
from pyspark.sql import functions as F

from lakeloom.functions.ports import app_protocol
from lakeloom.plans.event_queries import AGENTS, NO_AGENT
from lakeloom.functions.user_agent import FIELDS
from lakeloom.sources.writers import write_mart_batch
from lakeloom.streaming import events, jobs, packets, promotions


@pytest.fixture
def raw(spark):
    return lambda *values: spark.createDataFrame([(None, v) for v in values], "key string, value string")


@pytest.mark.parametrize("value", [None, "{}", " { } ", "[]", "0", "0.0", "-0", "0e5", '""', "false", "null"])
def test_dropped(raw, value):
    assert events.route(raw(value)).count() == 0


@pytest.mark.parametrize("value", ["", "{", "not json", '{"a": 1}', '{"id": null}', "[1]", "5", '"text"', "true"])
def test_failed_as_they_came(raw, value):
    assert [tuple(r) for r in events.route(raw(value)).collect()] == [(events.FAILED_TOPIC, None, value)]


def test_enriched_keeps_other_keys(raw):
    source = {"id": "e1", "user_agent": AGENTS[3][0], "nested": {"a": [1, None]}, "none": None, "n": 1.5,
              "browser_family": "to be replaced"}
    row = events.route(raw(json.dumps(source))).first()
    assert (row.topic, row.key) == (events.ENRICHED_TOPIC, "e1")
    assert json.loads(row.value) == {**source, **dict(zip(FIELDS, AGENTS[3][1]))}


@pytest.mark.parametrize("agent, want", [*AGENTS, ("", NO_AGENT)])
def test_user_agents(raw, agent, want):
    value = json.loads(events.route(raw(json.dumps({"id": 1, "user_agent": agent}))).first().value)
    assert tuple(value[f] for f in FIELDS) == want


def test_missing_user_agent_and_numeric_id(raw):
    row = events.route(raw('{"id": 7}')).first()
    assert row.key == "7"
    assert tuple(json.loads(row.value)[f] for f in FIELDS) == NO_AGENT


def test_last_of_repeated_keys_counts(raw):
    assert events.route(raw('{"id": "a", "id": "b"}')).first().key == "b"


def test_enrichments_chain(raw):
    shout = lambda df: df.withColumn("loud", F.upper(F.col("browser_family")))
    row = events.route(raw(json.dumps({"id": "x", "user_agent": AGENTS[0][0]})),
                       [events.enrich_user_agent, shout]).first()
    assert json.loads(row.value)["loud"] == "SAFARI"


@pytest.mark.parametrize("sport, dport, want", [
    (80, 1, "HTTP"), (1, 8092, "HTTP"), (443, 2, "HTTPS"), (443, 80, "HTTP"), (22, 23, "OTHER")])
def test_ports(spark, sport, dport, want):
    assert spark.range(1).select(app_protocol(F.lit(sport), F.lit(dport))).first()[0] == want


def test_packets(spark):
    packet = {"layer_type": "Ether", "dst": "ff", "packet_received_at": "2024-01-02 03:04:05", "payload": {
        "layer_type": "IP", "payload": {"layer_type": "TCP", "sport": 80, "dport": 5, "payload": {
            "layer_type": "Raw", "load": "x"}}}}
    df = spark.createDataFrame([(json.dumps(packet),), ("broken",), (None,)], "value string")
    flat = packets.flatten_packets(df).collect()
    assert [x.layer_type for x in flat[0].layers] == ["Ether", "IP", "TCP", "Raw"]
    assert [x.protocol for x in flat[0].layers] == [None, None, "HTTP", None]
    assert str(flat[0].packet_received_at) == "2024-01-02 03:04:05"
    assert json.loads(flat[0].layers[3].fields) == {"load": "x"}
    assert not flat[1].layers and not flat[2].layers
    assert packets.packet_layers(df).count() == 4


def test_packets_of_any_depth(spark):
    packet = {"layer_type": "TCP", "sport": 443, "dport": 1}
    for i in range(11, -1, -1):
        packet = {"layer_type": f"L{i}", "payload": packet}
    df = spark.createDataFrame([(json.dumps(packet),)], "value string")
    got = packets.packet_layers(df).orderBy("depth").collect()
    assert [(r.depth, r.layer_type, r.protocol) for r in got] == [(i, f"L{i}", None) for i in range(12)] + [(12, "TCP", "HTTPS")]


def test_an_enrichment_refuses_events(spark):
    def refuse_odd(df):
        odd = F.col("id").cast("int") % 2 == 1
        return df.withColumn("parity", F.when(~odd, "even")).withColumn(events.REFUSED, odd)

    values = ['{"id": "1", "x": 5}', '{"id": "2", "x": 6}', '{"id": "4"}', '{"x": 1}']
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    for chain in ((refuse_odd, events.enrich_user_agent), (events.enrich_user_agent, refuse_odd)):
        got = events.route(raw, chain).collect()
        failed = {r.value for r in got if r.topic == events.FAILED_TOPIC}
        assert failed == {values[0], values[3]} and all(r.key is None for r in got if r.value in failed)
        good = {r.key: json.loads(r.value) for r in got if r.topic == events.ENRICHED_TOPIC}
        assert set(good) == {"2", "4"} and all(x["parity"] == "even" and "refused" not in x for x in good.values())


def test_bounded_batches_with_a_restart(spark, tmp_path, rows):
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    data = spark.range(40).selectExpr("concat('{\"id\": \"', id, '\"}') AS value").repartition(4)
    data.write.parquet(source)

    def run():
        query = jobs.write_topics(events.route(jobs.read_files(spark, source, max_files=1)), out, progress, stop_on_empty=True)
        query.awaitTermination()
        return len([p for p in query.recentProgress if p["numInputRows"]])

    assert run() == 4
    data.limit(7).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(out).count() == 47


def test_promotions(spark, rows):
    raw = spark.createDataFrame(
        [('{"store_id": 1, "item_id": 2, "date": "2024-01-01", "price": 10.0, "discount": 0.25}',)], "value string")
    sales = spark.createDataFrame([(1, 2, 99.0)], "store_number bigint, item_number bigint, revenue double")
    by_day = sales.withColumn("date", F.lit("2024-01-01").cast("date")).unionByName(
        sales.withColumn("date", F.lit("2024-01-02").cast("date")).withColumn("revenue", F.lit(1.0)))
    assert rows(promotions.promo_join(promotions.parse_promotions(raw), by_day).select("revenue")) == [(99.0,)]
    row = promotions.promo_join(promotions.parse_promotions(raw), sales).first()
    assert (row.revenue, row.promo_price) == (99.0, 7.5)


def drop(spark, folder, *ids):
    spark.createDataFrame([(None, json.dumps({"id": i})) for i in ids] + [(None, "bad")], "key string, value string") \
        .coalesce(1).write.mode("append").parquet(folder)


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    for ids in (["a", "b"], ["c"]):
        drop(spark, source, *ids)
        stream = jobs.read_files(spark, source)
        jobs.write_topics(events.route(stream), out, progress, stop_on_empty=True).awaitTermination()
    back = spark.read.parquet(out)
    assert sorted(r.key for r in back.where(F.col("topic") == events.ENRICHED_TOPIC).collect()) == ["a", "b", "c"]
    assert back.where(F.col("topic") == events.FAILED_TOPIC).count() == 2


def test_stream_equals_batch(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    drop(spark, source, "a", "b")
    stream = events.route(jobs.read_files(spark, source))
    jobs.write_topics(stream, str(tmp_path / "out"), str(tmp_path / "cp"), stop_on_empty=True).awaitTermination()
    back = spark.read.parquet(str(tmp_path / "out")).select(F.col("topic").cast("string"), "key", "value")
    assert rows(back) == rows(events.route(spark.read.parquet(source)))


def test_dedup_in_stream_and_batch(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    data = spark.sql("""SELECT id, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id) AS ts
                        FROM VALUES (1), (2), (1), (3), (2) AS t(id)""")
    data.write.parquet(source)
    assert rows(events.dedup(data).select("id")) == [(1,), (2,), (3,)]
    none = data.limit(2).withColumn("id", F.lit(None).cast("int"))
    assert rows(events.dedup(data.unionByName(none)).select("id")) == [(1,), (2,), (3,), (None,), (None,)]
    with pytest.raises(ValueError):
        events.dedup(jobs.read_files(spark, source))
    stream = events.dedup(jobs.read_files(spark, source), "id", "ts", "1 hour")
    jobs.write_files(stream, str(tmp_path / "out"), str(tmp_path / "cp"), stop_on_empty=True).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("id")) == [(1,), (2,), (3,)]


def test_stream_into_mart(spark, tmp_path):
    source = str(tmp_path / "in")
    drop(spark, source, "a", "b")
    jobs.write_batches(jobs.read_files(spark, source), write_mart_batch(str(tmp_path / "mart")),
                       str(tmp_path / "cp"), stop_on_empty=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "mart")).count() == 3


def test_single_file_as_stream(spark, tmp_path):
    (tmp_path / "t").mkdir()
    source = spark.range(5)
    source.coalesce(1).write.parquet(str(tmp_path / "w"))
    part = next((tmp_path / "w").glob("part-*.parquet"))
    (tmp_path / "t" / "one.parquet").write_bytes(part.read_bytes())
    (tmp_path / "t" / "other.parquet").write_bytes(part.read_bytes())
    stream = jobs.read_files(spark, str(tmp_path / "t" / "one.parquet"))
    jobs.write_files(stream, str(tmp_path / "out"), str(tmp_path / "cp"), stop_on_empty=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_kafka_options():
    assert jobs.kafka_source_options("b:9092", "raw", min_partitions=8, max_offsets=1000) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "raw", "startingOffsets": "earliest",
        "minPartitions": "8", "maxOffsetsPerTrigger": "1000"}
