"""Captured network packets: nested JSON, one level per protocol layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.json_fields import parse
from lakeloom.functions.ports import app_protocol


def _layer(doc: Column, depth: Column) -> Column:
    def read(key: str, dtype: str) -> Column:
        return F.try_variant_get(doc, f"$.{key}", dtype)

    kind = read("layer_type", "string")
    fields = F.map_filter(
        F.try_variant_get(doc, "$", "map<string,variant>"), lambda k, _: ~k.isin("payload", "layer_type"))
    return F.struct(
        depth.alias("depth"),
        kind.alias("layer_type"),
        F.when(kind == "TCP", app_protocol(read("sport", "int"), read("dport", "int"))).alias("protocol"),
        F.to_json(fields).alias("fields"))


def flatten_packets(packets: DataFrame) -> DataFrame:
    """``packet_received_at`` and the array ``layers``, outermost first, for JSON text in ``value``.

    A packet has as many layers as it nests payloads with a ``layer_type``: each step opens the payload of the layer before, and
    no packet takes more steps than the word occurs in its text. TCP layers get ``protocol`` from their ports.
    """
    most = F.regexp_count(F.col("value"), F.lit('"layer_type"'))
    steps = F.when(most > 1, F.sequence(F.lit(2), most)).otherwise(F.array().cast("array<int>"))
    opened = F.aggregate(steps, F.array("doc"), lambda chain, _: F.when(
        F.try_variant_get(F.element_at(chain, -1), "$.payload.layer_type", "string").isNull(), chain).otherwise(
            F.concat(chain, F.array(F.try_variant_get(F.element_at(chain, -1), "$.payload", "variant")))))
    docs = packets.withColumn("doc", parse("value")).withColumn("chain", opened)
    layers = F.filter(F.transform("chain", _layer), lambda x: x["layer_type"].isNotNull())
    return docs.select(
        *packets.columns,
        F.try_variant_get("doc", "$.packet_received_at", "timestamp").alias("packet_received_at"),
        layers.alias("layers")).drop("value")


def packet_layers(packets: DataFrame) -> DataFrame:
    """One row per packet and layer."""
    flat = flatten_packets(packets)
    others = [c for c in flat.columns if c != "layers"]
    # The plain form would evaluate the whole array a second time, to filter out empty ones early.
    rows = flat.select(*others, F.inline_outer("layers"))
    return rows.where(F.col("layer_type").isNotNull())
