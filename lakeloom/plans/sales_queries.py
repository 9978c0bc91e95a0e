"""Registered sales reports on the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import sales as reports
from lakeloom.plans.star import sales_rows, sales_sample, sales_totals
from lakeloom.sources.tables import Tables

DOLLARS = ("sale_dollars",)
BOTH = ("sale_dollars", "bottles_sold")


def with_gaps(sales: DataFrame) -> DataFrame:
    """Make one city unknown and pad another one, so that the guards for both have work to do."""
    city = F.col("city")
    return sales.withColumn(
        "city", F.when(city == "NATION_0", None).when(city == "NATION_1", "  NATION_1 ").otherwise(city))


QUERIES = {
    "revenue_year": lambda s, d: reports.revenue_year(sales_totals(Tables(s, d), [])),
    "top_items_year": lambda s, d: reports.top_items_year(
        sales_totals(Tables(s, d), ["item_number", "item_description"], BOTH)),
    "top_cities_year": lambda s, d: reports.top_cities_year(with_gaps(sales_totals(Tables(s, d), ["city"], BOTH))),
    "mom_revenue_city": lambda s, d: reports.mom_revenue_city(
        with_gaps(sales_totals(Tables(s, d), ["city"], period="month"))),
    "top_categories_year": lambda s, d: reports.top_categories_year(
        sales_totals(Tables(s, d), ["item_description"])),
    "top_vendors_year": lambda s, d: reports.top_vendors_year(sales_totals(Tables(s, d), ["vendor_name"], BOTH)),
    "yoy_revenue_category": lambda s, d: reports.yoy_revenue_category(
        sales_totals(Tables(s, d), ["item_description"])),
    "yoy_revenue_city": lambda s, d: reports.yoy_revenue_city(with_gaps(sales_totals(Tables(s, d), ["city"]))),
    "cumulative_revenue_year": lambda s, d: reports.cumulative_revenue_year(sales_totals(Tables(s, d), [])),
    "running_avg_revenue_year": lambda s, d: reports.running_avg_revenue_year(sales_totals(Tables(s, d), [])),
    "curated_sales": lambda s, d: reports.curated_sales(sales_rows(Tables(s, d))),
    "curated_sample": lambda s, d: sales_sample(Tables(s, d)),
}

_SALES = """
WITH sales AS (
  SELECT 'INV-' || l_orderkey || '-' || l_linenumber AS invoice_item_number,
         CAST(o_orderdate AS DATE) AS sale_date, o_custkey AS store_number,
         n_name AS city, r_regionkey AS county_number, r_name AS county,
         p_brand AS category, p_type AS category_name, l_suppkey AS vendor_number, s_name AS vendor_name,
         l_partkey AS item_number, p_name AS item_description, p_size AS pack, 750 AS bottle_volume_ml,
         p_retailprice / CAST(1.5 AS DOUBLE) AS state_bottle_cost, p_retailprice AS state_bottle_retail,
         CAST(l_quantity AS BIGINT) AS bottles_sold, l_extendedprice * (1 - l_discount) AS sale_dollars,
         CAST(l_quantity AS BIGINT) * CAST(0.75 AS DOUBLE) AS volume_sold_liters,
         CAST(l_quantity AS BIGINT) * CAST(0.75 AS DOUBLE) * CAST(0.264172 AS DOUBLE) AS volume_sold_gallons
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey),
gaps AS (
  SELECT * REPLACE (CASE city WHEN 'NATION_0' THEN NULL WHEN 'NATION_1' THEN '  NATION_1 ' ELSE city END AS city)
  FROM sales)
"""
_MONEY = "CAST(SUM(CAST(sale_dollars AS DECIMAL(18,4))) AS DOUBLE)"
_BOTTLES = "CAST(SUM(bottles_sold) AS BIGINT)"
_YEAR = "CAST(year(sale_date) AS INTEGER)"


def _top(source: str, keys: str, name: str, measures: str, columns: str, k: int, ties: str) -> str:
    return f"""{_SALES}, totals AS (
  SELECT {_YEAR} AS year, {keys}, {measures} FROM {source} WHERE sale_date IS NOT NULL
    AND sale_dollars IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY total_revenue DESC, {ties}) AS INTEGER) AS rank
  FROM totals)
SELECT year, rank, {name}, {columns} FROM ranked WHERE rank <= {k}"""


def _change(source: str, key: str, name: str, period: str, period_name: str, pct: str) -> str:
    return f"""{_SALES}, totals AS (
  SELECT {key} AS {name}, {period} AS {period_name}, {_MONEY} AS revenue FROM {source}
  WHERE sale_date IS NOT NULL AND sale_dollars IS NOT NULL GROUP BY ALL),
prev AS (SELECT *, lag(revenue) OVER (PARTITION BY {name} ORDER BY {period_name}) AS p FROM totals)
SELECT {name}, {period_name}, revenue, coalesce(p, 0.0) AS prev_revenue,
  CASE WHEN p IS NULL OR p = 0 THEN CAST(0 AS DOUBLE)
       ELSE (revenue - p) / p * CAST(100 AS DOUBLE) END AS {pct} FROM prev"""


_BY_YEAR = f"{_SALES}, y AS (SELECT {_YEAR} AS year, {_MONEY} AS revenue FROM sales GROUP BY 1)"
_CATEGORY = "trim(coalesce(item_description, 'UNKNOWN'))"
_CITY = "trim(coalesce(city, 'UNKNOWN'))"

ORACLES = {
    "revenue_year": f"{_BY_YEAR} SELECT year, revenue AS total_revenue FROM y",
    "top_items_year": _top(
        "sales", f"item_number, {_CATEGORY} AS item_name", "item_name",
        f"{_BOTTLES} AS total_bottles, {_MONEY} AS total_revenue", "total_bottles, total_revenue", 5,
        "item_name, item_number"),
    "top_cities_year": _top(
        "gaps", f"{_CITY} AS city_name", "city_name AS city",
        f"{_BOTTLES} AS total_bottles, {_MONEY} AS total_revenue", "total_bottles, total_revenue", 5, "city_name"),
    "mom_revenue_city": _change(
        "(SELECT * FROM gaps WHERE city IS NOT NULL)", "city", "city",
        "CAST(date_trunc('month', sale_date) AS DATE)", "month", "mom_pct"),
    "top_categories_year": _top(
        "sales", f"{_CATEGORY} AS clean_name", "clean_name AS category", f"{_MONEY} AS total_revenue", "total_revenue",
        10, "clean_name"),
    "top_vendors_year": _top(
        "sales", "trim(coalesce(vendor_name, 'UNKNOWN')) AS vendor", "vendor",
        f"{_MONEY} AS total_revenue, {_BOTTLES} AS total_bottles", "total_revenue, total_bottles", 10, "vendor"),
    "yoy_revenue_category": _change("sales", _CATEGORY, "category", _YEAR, "year", "yoy_pct").replace(
        "GROUP BY ALL", "GROUP BY 1, 2"),
    "yoy_revenue_city": _change("gaps", _CITY, "city_clean", _YEAR, "year", "yoy_pct").replace(
        "SELECT city_clean, year, revenue, coalesce", "SELECT city_clean AS city, year, revenue, coalesce"),
    "cumulative_revenue_year": f"""{_BY_YEAR} SELECT year, revenue,
  SUM(revenue) OVER (ORDER BY year ROWS UNBOUNDED PRECEDING) AS cumulative_revenue FROM y""",
    "running_avg_revenue_year": f"""{_BY_YEAR} SELECT year, revenue,
  AVG(revenue) OVER (ORDER BY year ROWS 2 PRECEDING) AS avg_3y FROM y""",
    "curated_sales": f"{_SALES} SELECT * FROM sales",
    "curated_sample": f"""{_SALES} SELECT * FROM sales WHERE sale_date IS NOT NULL AND store_number IS NOT NULL
  AND item_number IS NOT NULL
ORDER BY invoice_item_number, item_number, vendor_number, bottles_sold, sale_dollars LIMIT 10000""",
}
