"""Contiguous shards of near-equal bytes from global prefix sums.

Rows are put in order by range, each partition reports its bytes, and the running sum of those totals tells every row how
many bytes come before it in the whole table. Cuts at equal targets give the shards. Only ids, sizes and checksums are
sorted; texts stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.helpers import store, text_or_empty

SHARDS = 8


def ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` stored in the given order, with ``part``, the number of the range that a row lies in.

    The ranges come from a sample and are drawn once: all later steps read the stored numbers.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(spread.withColumn("part", F.spark_partition_id()), "ranged")


def prefix_sums(rows: DataFrame, size: str, order: list[str]) -> DataFrame:
    """``rows`` (with ``part``) and ``before``, the sum of ``size`` over all rows that come earlier.

    One row per part is summed up in a single task; rows are only summed within their part.
    """
    totals = rows.groupBy("part").agg(F.sum(size).alias("_bytes"))
    start = totals.select(F.col("part").alias("_part"), (
        F.sum("_bytes").over(Window.orderBy("part")) - F.col("_bytes")).alias("_start"))
    inner = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(start, F.col("part") == F.col("_part")).withColumn(
        "before", F.col("_start") + F.coalesce(F.sum(size).over(inner), F.lit(0))).drop("_part", "_start")


def shard_of(before: Column, size: Column, total: Column, shards: int) -> Column:
    """The shard in which the middle of a row lies: a row that straddles a cut goes to the side that holds most of it."""
    middle = before.cast("decimal(38,0)") * 2 + size
    return F.least(F.floor(middle * shards / (total * 2)), F.lit(shards - 1)).cast("int")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's bytes and one (a missing text has one). Rows are ordered by a hash of the text, then by doc_id,
    so that equal texts are neighbours and a group is divided only where a cut falls inside it; rows repeated with id and
    text are all placed. ``slot`` counts a shard's rows in that order without gaps. Shards differ from the equal share by
    one row's bytes at most.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text = text_or_empty()
    rows = store(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("tag")), "sizes")
    order = ["h", "doc_id", "tag"]
    ordered = ranged(rows, order)
    rows, total = prefix_sums(ordered, "size", order), ordered.agg(F.sum("size").alias("_total"))
    placed = store(rows.join(F.broadcast(total)).withColumn(  # one row
        "shard", shard_of(F.col("before"), F.col("size"), F.col("_total"), shards)).drop("before", "_total"), "placed")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("_n"))
    first = counts.select(F.col("shard").alias("_s"), F.col("part").alias("_p"), (
        F.sum("_n").over(Window.partitionBy("shard").orderBy("part")) - F.col("_n")).alias("_first"))
    at = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*order)) - 1
    return placed.join(first, (F.col("shard") == F.col("_s")) & (F.col("part") == F.col("_p"))).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_first") + at).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
