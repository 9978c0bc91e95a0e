"""Retail-sales reports over the 20-column sales schema.

Every report takes any DataFrame with the sales columns it needs. ``sale_dollars`` may be a double
(one row per sale) or a decimal that already adds up several sales (see ``lakeloom.plans.star``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.numbers import exact_total, name_or_unknown
from lakeloom.operators.columns import require, select_existing
from lakeloom.operators.windows import first_rows, moving_average, running_sum, top_k_per, with_previous

# The columns of the curated sales table, in schema order.
SALES_COLUMNS = [
    "invoice_item_number", "sale_date", "store_number", "city", "county_number", "county", "category",
    "category_name", "vendor_number", "vendor_name", "item_number", "item_description", "pack",
    "bottle_volume_ml", "state_bottle_cost", "state_bottle_retail", "bottles_sold", "sale_dollars",
    "volume_sold_liters", "volume_sold_gallons",
]

SAMPLE_ORDER = ["invoice_item_number", "item_number", "vendor_number", "bottles_sold", "sale_dollars"]


def _year() -> Column:
    return F.year("sale_date").alias("year")


def _bottles() -> Column:
    return F.sum("bottles_sold").cast("long").alias("total_bottles")


def _revenue_by_year(sales: DataFrame, name: str) -> DataFrame:
    dated = require(sales, "sale_date", "sale_dollars")
    return dated.groupBy(_year()).agg(exact_total(sales, "sale_dollars").alias(name))


def revenue_year(sales: DataFrame) -> DataFrame:
    return _revenue_by_year(sales, "total_revenue").orderBy("year")


def top_items_year(sales: DataFrame, k: int = 5) -> DataFrame:
    totals = (
        require(sales, "sale_date", "item_number", "sale_dollars", "bottles_sold")
        .groupBy(_year(), "item_number", name_or_unknown("item_description").alias("item_name"))
        .agg(_bottles(), exact_total(sales, "sale_dollars").alias("total_revenue")))
    best = top_k_per(totals, ["year"], [F.desc("total_revenue"), F.asc("item_name"), F.asc("item_number")], k)
    return best.select("year", "rank", "item_name", "total_bottles", "total_revenue").orderBy("year", "rank")


def top_cities_year(sales: DataFrame, k: int = 5) -> DataFrame:
    totals = (
        require(sales, "sale_date", "sale_dollars", "bottles_sold")
        .groupBy(_year(), name_or_unknown("city").alias("city"))
        .agg(_bottles(), exact_total(sales, "sale_dollars").alias("total_revenue")))
    best = top_k_per(totals, ["year"], [F.desc("total_revenue"), F.asc("city")], k)
    return best.select("year", "rank", "city", "total_bottles", "total_revenue").orderBy("year", "rank")


def mom_revenue_city(sales: DataFrame) -> DataFrame:
    """Month over month; unlike the yearly city reports, rows without a city are left out."""
    monthly = (
        require(sales, "city", "sale_date", "sale_dollars")
        .groupBy("city", F.trunc("sale_date", "MM").alias("month"))
        .agg(exact_total(sales, "sale_dollars").alias("revenue")))
    return with_previous(monthly, ["city"], "month", "revenue", "mom_pct")


def top_categories_year(sales: DataFrame, k: int = 10, category: str = "item_description") -> DataFrame:
    totals = (
        require(sales, "sale_date", "sale_dollars")
        .groupBy(_year(), name_or_unknown(category).alias("category"))
        .agg(exact_total(sales, "sale_dollars").alias("total_revenue")))
    best = top_k_per(totals, ["year"], [F.desc("total_revenue"), F.asc("category")], k)
    return best.select("year", "rank", "category", "total_revenue").orderBy("year", "rank")


def top_vendors_year(sales: DataFrame, k: int = 10) -> DataFrame:
    totals = (
        require(sales, "sale_date", "sale_dollars", "bottles_sold")
        .groupBy(_year(), name_or_unknown("vendor_name").alias("vendor"))
        .agg(exact_total(sales, "sale_dollars").alias("total_revenue"), _bottles()))
    best = top_k_per(totals, ["year"], [F.desc("total_revenue"), F.asc("vendor")], k)
    return best.select("year", "rank", "vendor", "total_revenue", "total_bottles").orderBy("year", "rank")


def _yoy(sales: DataFrame, source: str, name: str) -> DataFrame:
    yearly = (
        require(sales, "sale_date", "sale_dollars")
        .groupBy(name_or_unknown(source).alias(name), _year())
        .agg(exact_total(sales, "sale_dollars").alias("revenue")))
    return with_previous(yearly, [name], "year", "revenue", "yoy_pct").orderBy(name, "year")


def yoy_revenue_category(sales: DataFrame, category: str = "item_description") -> DataFrame:
    return _yoy(sales, category, "category")


def yoy_revenue_city(sales: DataFrame) -> DataFrame:
    return _yoy(sales, "city", "city")


def cumulative_revenue_year(sales: DataFrame) -> DataFrame:
    return running_sum(_revenue_by_year(sales, "revenue"), "year", "revenue", "cumulative_revenue")


def running_avg_revenue_year(sales: DataFrame) -> DataFrame:
    return moving_average(_revenue_by_year(sales, "revenue"), "year", "revenue", "avg_3y")


def curated_sales(sales: DataFrame) -> DataFrame:
    """The sales columns that exist, in schema order."""
    return select_existing(sales, SALES_COLUMNS)


def curated_sample(sales: DataFrame, n: int = 10_000) -> DataFrame:
    """``n`` rows with a date, a store and an item: the first ones by invoice, so that runs agree."""
    complete = require(curated_sales(sales), "sale_date", "store_number", "item_number")
    return first_rows(complete, [F.col(c) for c in SAMPLE_ORDER if c in complete.columns], n)
