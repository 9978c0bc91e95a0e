"""Event parsing, validation, enrichment and routing.

Every function maps a DataFrame to a DataFrame and works the same on a batch and on a stream.
A raw event frame has ``key`` and ``value`` (text); a parsed one adds ``doc`` (VARIANT) and ``id``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import json_fields, user_agent

ENRICHED_TOPIC = "enriched"
FAILED_TOPIC = "enriched.failed"

REFUSED = "refused"
Enrichment = Callable[[DataFrame], DataFrame]


def parse_events(raw: DataFrame) -> DataFrame:
    """Drop tombstones and empty JSON; ``doc`` is NULL for what is no JSON."""
    value = F.col("value").cast("string")
    return raw.withColumn("value", value).where(
        F.col("value").isNotNull() & ~json_fields.is_empty_json("value")
    ).withColumn("doc", json_fields.parse("value"))


def validate(events: DataFrame) -> DataFrame:
    """Add ``id`` as text; it is NULL unless the event is an object whose id is set."""
    return events.withColumn("id", json_fields.read_key("doc", "id"))


def enrich_user_agent(events: DataFrame, column: str = "user_agent", rules: user_agent.AgentRules | None = None) -> DataFrame:
    """Add the twelve browser, system and device columns of the event's user agent, by the package's rules unless others are given."""
    rules, ua = rules or user_agent.packaged_rules(), F.col("_ua")
    kinds = ("browser", "system", "device")
    # One step per layer of dependent columns, so that each is computed once.
    matched = events.withColumn("_ua", json_fields.read_key("doc", column, default="")).withColumns(
        {f"_{k}": rules.matched(ua, k) for k in kinds})
    found = {k: rules.found(F.col(f"_{k}"), k) for k in kinds}
    named = matched.withColumns({
        **{f"browser_{x}": found["browser"][x] for x in ("family", "version")},
        **{f"os_{x}": found["system"][x] for x in ("family", "version")},
        **{f"device_{x}": found["device"][x] for x in ("family", "brand", "model")}})
    full = named.withColumns(user_agent.device_kind(ua, F.col("browser_family"), F.col("os_family"), F.col("device_family")))
    return full.select(*events.columns, *user_agent.FIELDS)


def enrich(events: DataFrame, enrichments: Sequence[Enrichment] = (enrich_user_agent,)) -> DataFrame:
    """Apply enrichments one after the other; the columns they add become keys of the JSON value.

    An enrichment refuses an event by the boolean column ``REFUSED``: the event stays as it came, and ``route`` sends it
    to the failed topic.
    """
    def step(df: DataFrame, enrichment: Enrichment) -> DataFrame:
        before = df.withColumnRenamed(REFUSED, "_before") if REFUSED in df.columns else df.withColumn("_before", F.lit(False))
        after = enrichment(before)
        own = F.col(REFUSED) if REFUSED in after.columns else F.lit(False)
        return after.withColumn(REFUSED, F.col("_before") | F.coalesce(own, F.lit(False))).drop("_before")

    full = reduce(step, enrichments, events.withColumn(REFUSED, F.lit(False)))
    added = {c: F.col(c) for c in full.columns if c not in [*events.columns, REFUSED]}
    valid = F.col("id").isNotNull() & ~F.col(REFUSED)
    return full.withColumn(
        "value", F.when(valid, json_fields.merge_keys(F.when(valid, F.col("doc")), added)).otherwise(F.col("value")))


def route(raw: DataFrame, enrichments: Sequence[Enrichment] = (enrich_user_agent,),
          enriched_topic: str = ENRICHED_TOPIC, failed_topic: str = FAILED_TOPIC) -> DataFrame:
    """``topic, key, value``: valid events enriched and keyed by id, all others, and those that an enrichment refused, as they
    came, without key."""
    events = enrich(validate(parse_events(raw)), enrichments)
    valid = F.col("id").isNotNull() & ~F.col(REFUSED)
    return events.select(
        F.when(valid, enriched_topic).otherwise(failed_topic).alias("topic"),
        F.when(valid, F.col("id")).alias("key"),
        "value")


def dedup(events: DataFrame, key: str = "id", event_time: str = "ts", delay: str | None = None) -> DataFrame:
    """One event per key; events without a key all stay.

    On a stream the keys are kept until ``delay`` after their event time has passed. That is for the caller to choose: an
    event that comes later still can no longer be compared and is left out. ``dedup.first_and_late`` hands those on instead.
    """
    keyed, rest = events.where(F.col(key).isNotNull()), events.where(F.col(key).isNull())
    if not events.isStreaming:
        return keyed.dropDuplicates([key]).unionByName(rest)
    if delay is None:
        raise ValueError("a stream needs a delay")
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key]).unionByName(rest)
