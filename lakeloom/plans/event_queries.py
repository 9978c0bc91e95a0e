"""Registered event, packet and promotion workloads, as batches and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import json_fields
from lakeloom.functions.numbers import exact_sum
from lakeloom.functions.user_agent import FIELDS
from lakeloom.plans.agents import AGENTS, NO_AGENT
from lakeloom.plans.star import sales_rows, sales_totals
from lakeloom.session import workspace
from lakeloom.sources.tables import Tables
from lakeloom.sources.writers import write_mart_batch, write_mart_files
from lakeloom.streaming import dedup, events, jobs, packets, promotions

EVENT_COLUMNS = ["event_type", "user_id", "k"]


def messages(source: DataFrame) -> DataFrame:
    """Raw messages of the events table. Each event is one message; its number modulo 100 picks the
    form: without id, broken, tombstone, empty, no object, null id, no user agent, or complete."""
    agent = F.element_at(F.array(*[F.lit(ua) for ua, _ in AGENTS]), (F.col("event_id") % len(AGENTS) + 1).cast("int"))
    body = [F.col("event_type"), F.col("user_id"), F.get_json_object("props", "$.k").cast("int").alias("k")]
    identity = F.col("event_id").cast("string").alias("id")
    form = F.col("event_id") % 100
    value = (
        F.when(form == 7, '{"kind": "anonymous"}')
        .when(form == 17, F.concat(F.lit('{"id": "'), "event_id", F.lit('", ')))
        .when(form == 27, None)
        .when(form == 37, "{ }")
        .when(form == 47, F.concat(F.lit("["), "event_id", F.lit("]")))
        .when(form == 57, '{"id": null}')
        .when(form == 67, F.to_json(F.struct(identity, *body)))
        .otherwise(F.to_json(F.struct(identity, *body, agent.alias("user_agent")))))
    return source.select("ts", F.lit(None).cast("string").alias("key"), value.alias("value"))


def enriched_fields(routed: DataFrame, fields: list[str]) -> DataFrame:
    """Selected keys of enriched events, read back from the JSON they travel as."""
    doc = json_fields.parse("value")
    types = {"user_id": "bigint", "k": "int"}
    return routed.where(F.col("topic") == events.ENRICHED_TOPIC).select("key", doc.alias("doc")).select(
        F.col("key").alias("id"), *[json_fields.read_key(
            "doc", f, "boolean" if f.startswith("device_is") else types.get(f, "string")).alias(f) for f in fields])


def _failed(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("topic") == events.FAILED_TOPIC).select("key", "value")


def _routed(s, d) -> DataFrame:
    return events.route(messages(Tables(s, d)["events"]))


def _event_stream(s, d) -> DataFrame:
    raw = jobs.read_files(s, Tables(s, d).path("events"))
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def refuse_high(df: DataFrame) -> DataFrame:
    """An enrichment that refuses events whose ``k`` is out of its range."""
    return df.withColumn(events.REFUSED, json_fields.read_key("doc", "k", "int") >= 95)


FILE_ROWS = 200_000  # rows of a landing file
BATCH_FILES = 64     # most files of a micro-batch


def deliver(rows: DataFrame, folder: str, files: int) -> int:
    """Append ``rows`` to a landing folder, in ``files`` files or as many as ``FILE_ROWS`` asks for, whatever the number of tasks.

    Returns the number of files.
    """
    files = max(files, -(-rows.count() // FILE_ROWS))
    rows.repartition(files).write.mode("append").parquet(folder)
    return files


def stream_enrich(s, d) -> DataFrame:
    """Route the message stream to its two topics; count and sample what arrived in each.

    The messages arrive in two deliveries of many files. Each run of the job takes up where the one before stopped, reads a bounded
    number of files per batch, two thirds of a delivery or ``BATCH_FILES``, and stops when it has seen all. One enrichment refuses events.
    """
    home, raw = workspace(s, "enrich"), messages(Tables(s, d)["events"])
    early = F.dayofmonth("ts") <= 15
    for delivery in (raw.where(early), raw.where(~early)):
        most = min(BATCH_FILES, deliver(delivery, f"{home}/arrived", files=6) * 2 // 3)
        jobs.write_topics(
            events.route(jobs.read_files(s, f"{home}/arrived", max_files=most), [events.enrich_user_agent, refuse_high]),
            f"{home}/topics", f"{home}/progress", stop_on_empty=True).awaitTermination()
    back = s.read.parquet(f"{home}/topics").withColumn("topic", F.col("topic").cast("string"))
    kept = enriched_fields(back, ["event_type", "user_id", "browser_family"])
    return kept.unionByName(_failed(back).select(F.col("value").alias("event_type")), allowMissingColumns=True)


def sent_events(source: DataFrame) -> DataFrame:
    """(part, id, ts, event_type): the events as they arrive, an eighth part of a month (or what is left of it) after the other.

    An event is sent one to three times at once; every fifth comes again with the next part. Of the first two days' events some
    come again with the last part, and some come only then.
    """
    number, day = F.col("event_id"), F.dayofmonth("ts")
    part = F.floor((day - 1) / 8).cast("int")
    first = F.when((day <= 2) & (number % 50 == 9), 3).otherwise(part)
    times = (number % 3 + 1).cast("int")
    again = F.when((number % 5 == 0) & (part < 3), F.array(part + 1)).otherwise(F.array().cast("array<int>"))
    long_after = F.when((day <= 2) & (number % 10 == 3), F.array(F.lit(3))).otherwise(F.array().cast("array<int>"))
    return source.select(
        F.explode(F.concat(F.array_repeat(first, times), again, long_after)).alias("part"),
        F.when(number % 97 != 0, number).alias("id"), F.col("ts").cast("timestamp").alias("ts"), "event_type")


def stream_dedup(s, d) -> DataFrame:
    """Every event comes out once, one without id as often as it was sent, and events that come too late to tell on an output
    of their own. The job is restarted before the last part arrives."""
    home, sent = workspace(s, "dedup"), sent_events(Tables(s, d)["events"])
    with dedup.keyed_state(s):
        for parts in ((0, 1, 2), (3,)):
            files = [deliver(sent.where(F.col("part") == part).drop("part"), f"{home}/arrived", files=1) for part in parts]
            told = dedup.first_and_late(
                jobs.read_files(s, f"{home}/arrived", max_files=min(BATCH_FILES, max(files))), "id", "ts", "9 days", buckets=128)
            jobs.write_files(told, f"{home}/events", f"{home}/progress", stop_on_empty=True, by=[dedup.OUTCOME]).awaitTermination()
    return s.read.parquet(f"{home}/events").select("id", "event_type", F.col(dedup.OUTCOME).cast("string"))


def promotion_messages(source: DataFrame) -> DataFrame:
    """Promotion JSON of the events table: store from the user, item and price from the value."""
    fields = F.struct(
        F.col("user_id").alias("store_id"), F.floor("value").alias("item_id"), F.to_date("ts").alias("date"),
        F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("int") / 100).alias("discount"))
    return source.select(F.to_json(fields).alias("value"))


def stream_promo(s, d) -> DataFrame:
    """Promotions joined to the sales of their store and item, into a mart keyed by micro-batch."""
    home = workspace(s, "promo")
    totals = sales_totals(Tables(s, d), ["store_number", "item_number"], ("sale_dollars", "bottles_sold"))
    per_item = totals.groupBy("store_number", "item_number").agg(
        F.sum("sale_dollars").cast("double").alias("revenue"), F.sum("bottles_sold").alias("bottles"))
    write_mart_files(per_item, f"{home}/sales")
    promos = promotions.parse_promotions(promotion_messages(_event_stream(s, d)))
    joined = promotions.promo_join(promos, s.read.parquet(f"{home}/sales"))
    jobs.write_batches(joined, write_mart_batch(f"{home}/mart"), f"{home}/progress",
                       stop_on_empty=True).awaitTermination()
    return s.read.parquet(f"{home}/mart").drop("batch_id")


def announced(s, d) -> DataFrame:
    """Promotion JSON: the first line of each order is announced up to nine days before it is sold."""
    t = Tables(s, d)
    lines = t["lineitem"].where("l_linenumber = 1").join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    fields = F.struct(
        F.col("o_custkey").alias("store_id"), F.col("l_partkey").alias("item_id"),
        F.date_sub(F.to_date("o_orderdate"), (F.col("o_orderkey") % 10).cast("int")).alias("date"),
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"))
    return lines.select(F.to_json(fields).alias("value"))


def stream_promo_in_time(s, d) -> DataFrame:
    """A stream of promotions joined to a stream of sales in the week after, into a mart keyed by micro-batch.

    Both arrive in three periods, with a restart in between. The last one ends with a row of either kind far in the future, so that
    promotions still waiting for sales are given out.
    """
    home = workspace(s, "promo_in_time")
    sold = sales_rows(Tables(s, d), ["store_number", "item_number", "sale_date", "sale_dollars", "bottles_sold"])
    sales = sold.groupBy("store_number", "item_number", "sale_date").agg(
        exact_sum(sold, "sale_dollars").cast("double").alias("revenue"), F.sum("bottles_sold").alias("bottles"))
    write_mart_files(sales, f"{home}/sales")
    write_mart_files(promotions.parse_promotions(announced(s, d)), f"{home}/promotions")
    sales, promos = s.read.parquet(f"{home}/sales"), s.read.parquet(f"{home}/promotions")
    lo, span = promos.select(F.min("date"), F.date_diff(F.max("date"), F.min("date")) + 1).first()
    nobody, end = F.lit(-1).cast("bigint"), F.date_add(F.lit(lo), 10_000)
    # Keys are set: rows that cannot join are left out before they move the watermark.
    last = {
        "sales": s.range(1).select(nobody.alias("store_number"), nobody.alias("item_number"), end.alias("sale_date")),
        "promotions": s.range(1).select(nobody.alias("store_id"), nobody.alias("item_id"), F.date_add(end, 30).alias("date"))}
    for period in range(3):
        for name, rows, day in (("sales", sales, "sale_date"), ("promotions", promos, "date")):
            part = F.least(F.floor(F.date_diff(F.col(day), F.lit(lo)) * 3 / span), F.lit(2))
            arrived = rows.where(part == period)
            if period == 2:
                arrived = arrived.unionByName(last[name], allowMissingColumns=True)
            arrived.write.mode("append").parquet(f"{home}/arrived/{name}")
        joined = promotions.promo_join_in_time(
            jobs.read_files(s, f"{home}/arrived/promotions"), jobs.read_files(s, f"{home}/arrived/sales"))
        jobs.write_batches(joined, write_mart_batch(f"{home}/mart"), f"{home}/progress", stop_on_empty=True).awaitTermination()
    return s.read.parquet(f"{home}/mart").drop("batch_id")


def captured_packets(s, d) -> DataFrame:
    """Nested packet JSON of the events table: Ethernet, IP, TCP or UDP, and for some a raw body.

    Every fiftieth packet travels in a tunnel, three layers deeper."""
    e = Tables(s, d)["events"]
    ports = F.array(*[F.lit(p) for p in (80, 443, 8091, 8092, 22, 8080)])
    port = F.element_at(ports, (F.col("event_id") % 6 + 1).cast("int"))
    inbound = F.col("user_id") % 2 == 0
    other = (F.col("user_id") + 40000).cast("int")
    raw = F.when(F.col("event_type") == "view", F.struct(
        F.lit("Raw").alias("layer_type"), F.col("props").alias("load")))
    segment = F.struct(
        F.when(F.col("event_type") == "error", "UDP").otherwise("TCP").alias("layer_type"),
        F.when(inbound, port).otherwise(other).alias("sport"),
        F.when(inbound, other).otherwise(port).alias("dport"), raw.alias("payload"))
    inner = F.to_json(F.struct(F.lit("IP").alias("layer_type"), F.lit(64).alias("ttl"), segment.alias("payload")))
    tunnel = "".join(f'{{"layer_type": "{x}", "payload": ' for x in ("Dot1Q", "IP", "GRE"))
    body = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit(tunnel), inner, F.lit("}}}"))).otherwise(inner)
    head = F.date_format("ts", """'{"layer_type": "Ether", "packet_received_at": "'yyyy-MM-dd HH:mm:ss'", "payload": '""")
    return e.select("event_id", F.concat(head, body, F.lit("}")).alias("value"))


def packet_rows(s, d) -> DataFrame:
    rows = packets.packet_layers(captured_packets(s, d))
    return rows.select(
        "event_id", "depth", "layer_type", "protocol",
        F.date_format("packet_received_at", "yyyy-MM-dd HH:mm:ss").alias("received_at"),
        F.get_json_object("fields", "$.dport").cast("int").alias("dport"))


QUERIES = {
    "enrich_valid": lambda s, d: enriched_fields(_routed(s, d), EVENT_COLUMNS),
    "enrich_failed": lambda s, d: _failed(_routed(s, d)),
    "ua_fields": lambda s, d: enriched_fields(_routed(s, d), FIELDS),
    "packets": packet_rows,
    "stream_enrich": stream_enrich,
    "stream_dedup": stream_dedup,
    "stream_promo": stream_promo,
    "stream_promo_in_time": stream_promo_in_time,
}


def _literal(x) -> str:
    return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)


_FAILED_FORMS = "(7, 17, 47, 57)"
_DROPPED_FORMS = "(27, 37)"
_VALID = f"event_id % 100 NOT IN (7, 17, 47, 57, 27, 37)"
_AGENT_FIELDS = "(VALUES " + ", ".join(
    "(" + ", ".join(_literal(x) for x in (i, *fields)) + ")"
    for i, fields in enumerate([*(f for _, f in AGENTS), NO_AGENT])) + f") AS a(agent, {', '.join(FIELDS)})"
_AGENT_TEXTS = "(VALUES " + ", ".join(
    f"({i}, {_literal(ua)})" for i, ua in enumerate([*(ua for ua, _ in AGENTS), None])) + ") AS t(agent, ua)"
_AGENT_NO = f"CASE WHEN event_id % 100 = 67 THEN {len(AGENTS)} ELSE event_id % {len(AGENTS)} END"
_FAILED_SQL = """CASE event_id % 100 WHEN 7 THEN '{"kind": "anonymous"}' WHEN 17 THEN '{"id": "' || event_id || '", '
  WHEN 47 THEN '[' || event_id || ']' ELSE '{"id": null}' END"""
_SPORT = "CASE WHEN user_id % 2 = 0 THEN port ELSE user_id + 40000 END"
_DPORT = "CASE WHEN user_id % 2 = 0 THEN user_id + 40000 ELSE port END"

ORACLES = {
    "enrich_valid": f"""SELECT CAST(event_id AS VARCHAR) AS id, event_type, user_id,
  CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events WHERE {_VALID}""",
    "enrich_failed": f"""SELECT CAST(NULL AS VARCHAR) AS key, {_FAILED_SQL} AS value FROM events
  WHERE event_id % 100 IN {_FAILED_FORMS}""",
    "ua_fields": f"""SELECT CAST(event_id AS VARCHAR) AS id, {', '.join(FIELDS)} FROM events
  JOIN {_AGENT_FIELDS} ON a.agent = {_AGENT_NO} WHERE {_VALID}""",
    "packets": f"""WITH p AS (SELECT *, [80, 443, 8091, 8092, 22, 8080][CAST(event_id % 6 + 1 AS INTEGER)] AS port
  FROM events),
t AS (SELECT event_id, event_type, CASE WHEN event_id % 50 = 0 THEN 3 ELSE 0 END AS deeper, strftime(ts, '%Y-%m-%d %H:%M:%S') AS received_at,
  CAST({_SPORT} AS INTEGER) AS sport, CAST({_DPORT} AS INTEGER) AS dport FROM p)
SELECT event_id, 0 AS depth, 'Ether' AS layer_type, NULL AS protocol, received_at, CAST(NULL AS INTEGER) AS dport FROM t
UNION ALL SELECT event_id, 1 + deeper, 'IP', NULL, received_at, NULL FROM t
UNION ALL SELECT event_id, depth, kind, NULL, received_at, NULL FROM t, (VALUES (1, 'Dot1Q'), (2, 'IP'), (3, 'GRE')) AS x(depth, kind)
  WHERE event_id % 50 = 0
UNION ALL SELECT event_id, 2 + deeper, CASE event_type WHEN 'error' THEN 'UDP' ELSE 'TCP' END,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN sport IN (80, 8091, 8092) OR dport IN (80, 8091, 8092) THEN 'HTTP'
       WHEN sport = 443 OR dport = 443 THEN 'HTTPS' ELSE 'OTHER' END, received_at, dport FROM t
UNION ALL SELECT event_id, 3 + deeper, 'Raw', NULL, received_at, NULL FROM t WHERE event_type = 'view'""",
    "stream_enrich": f"""WITH e AS (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events
  JOIN {_AGENT_FIELDS} ON a.agent = {_AGENT_NO} JOIN {_AGENT_TEXTS} ON t.agent = a.agent WHERE {_VALID})
SELECT CAST(event_id AS VARCHAR) AS id, event_type, user_id, browser_family FROM e WHERE k < 95
UNION ALL SELECT NULL, '{{"id":"' || event_id || '","event_type":"' || event_type || '","user_id":' || user_id || ',"k":' || k
  || CASE WHEN ua IS NULL THEN '}}' ELSE ',"user_agent":"' || ua || '"}}' END, NULL, NULL FROM e WHERE k >= 95
UNION ALL SELECT NULL, {_FAILED_SQL}, NULL, NULL FROM events WHERE event_id % 100 IN {_FAILED_FORMS}""",
    "stream_dedup": """WITH e AS (SELECT *, day(ts) AS d, CAST(floor((day(ts) - 1) / 8.0) AS INTEGER) AS part FROM events),
s AS (SELECT *, event_id % 3 + 1 AS times, d <= 2 AND event_id % 50 = 9 AS only_late, d <= 2 AND event_id % 10 = 3 AS again_late,
  event_id % 5 = 0 AND part < 3 AS again FROM e)
SELECT event_id AS id, event_type, 'first' AS outcome FROM s WHERE event_id % 97 <> 0 AND NOT only_late
UNION ALL SELECT event_id, event_type, 'late' FROM (SELECT *, unnest(range(0, CASE WHEN only_late THEN times ELSE 1 END)) FROM s
  WHERE event_id % 97 <> 0 AND (only_late OR again_late))
UNION ALL SELECT NULL, event_type, 'first' FROM (SELECT *, unnest(range(0, times + CASE WHEN again THEN 1 ELSE 0 END
  + CASE WHEN again_late THEN 1 ELSE 0 END)) FROM s WHERE event_id % 97 = 0)""",
    "stream_promo_in_time": """WITH sales AS (SELECT o_custkey AS store_number, l_partkey AS item_number, CAST(o_orderdate AS DATE) AS sale_date,
  CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bottles
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
promos AS (SELECT o_custkey AS store_number, l_partkey AS item_number, l_extendedprice AS price, l_discount AS discount,
  CAST(o_orderdate AS DATE) - CAST(o_orderkey % 10 AS INTEGER) AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 1)
SELECT p.store_number, p.item_number, date, price, discount, sale_date, revenue, bottles, price * (1 - discount) AS promo_price
FROM promos p LEFT JOIN sales s ON s.store_number = p.store_number AND s.item_number = p.item_number
  AND sale_date >= date AND sale_date < date + 7""",
    "stream_promo": """WITH totals AS (SELECT o_custkey AS store_number, l_partkey AS item_number,
  CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bottles
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
promos AS (SELECT user_id AS store_number, CAST(floor(value) AS BIGINT) AS item_number, CAST(ts AS DATE) AS date,
  value AS price, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) / CAST(100 AS DOUBLE) AS discount
  FROM events)
SELECT store_number, item_number, date, price, discount, revenue, bottles, price * (1 - discount) AS promo_price
FROM promos LEFT JOIN totals USING (store_number, item_number)""",
}
