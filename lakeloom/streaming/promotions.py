"""Promotion events joined to sales by store, item and date, and to a stream of sales by store, item and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROMOTION_SCHEMA = "store_id bigint, item_id bigint, date date, price double, discount double"


def parse_promotions(raw: DataFrame) -> DataFrame:
    """Promotion columns of JSON text in ``value``."""
    return raw.select(F.from_json(F.col("value").cast("string"), PROMOTION_SCHEMA).alias("p")).select("p.*")


def promo_join(promotions: DataFrame, sales: DataFrame) -> DataFrame:
    """Each promotion with the sales of its item in its store, NULL where there were none.

    ``sales`` has one row per ``store_number``, ``item_number`` and, if it has that column, ``date``. For a stream pass a
    table that is already written: every micro-batch reads it again.
    """
    keys = promotions.withColumnsRenamed({"store_id": "store_number", "item_id": "item_number"})
    on = ["store_number", "item_number", "date"]
    joined = keys.join(sales, on if "date" in sales.columns else on[:2], "left")
    return joined.withColumn("promo_price", F.col("price") * (1 - F.col("discount")))


def promo_join_in_time(promotions: DataFrame, sales: DataFrame, days: int = 7, delay: str = "10 days") -> DataFrame:
    """Each promotion with the sales of its item in its store on its first ``days`` days, NULL where there were none.

    Both sides are streams (or both tables); ``sales`` has ``store_number``, ``item_number``, ``sale_date`` and measures. Sales may come
    before or after their promotion. Each side waits ``delay`` for rows that are behind its latest one; a promotion or sale
    leaves the state when no partner can come any more, and a promotion without sales is given out then. Rows that are later
    than ``delay`` are not joined.
    """
    first = promotions.withColumn("first_day", F.col("date").cast("timestamp")).withWatermark("first_day", delay)
    sold = sales.withColumnsRenamed({"store_number": "_store", "item_number": "_item"}).withColumn(
        "sold_at", F.col("sale_date").cast("timestamp")).withWatermark("sold_at", delay)
    on = ((F.col("store_id") == F.col("_store")) & (F.col("item_id") == F.col("_item")) & (F.col("sold_at") >= F.col("first_day"))
          & (F.col("sold_at") < F.col("first_day") + F.expr(f"INTERVAL {days} DAYS")))
    joined = first.join(sold, on, "left_outer").withColumnsRenamed({"store_id": "store_number", "item_id": "item_number"})
    return joined.drop("_store", "_item", "first_day", "sold_at").withColumn(
        "promo_price", F.col("price") * (1 - F.col("discount")))
