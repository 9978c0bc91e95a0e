"""The sales schema on top of the order tables.

Two forms of the same data:

* ``sales_rows``: one row per sale, with only the joins that the wanted columns need;
* ``sales_totals``: measures added up before each join, for reports that only need sums.

All joins are left joins on unique dimension keys, so leaving one out never changes the row set.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.numbers import exact_sum
from lakeloom.operators.columns import require
from lakeloom.operators.windows import first_rows
from lakeloom.plans.sales import SALES_COLUMNS, SAMPLE_ORDER
from lakeloom.sources.tables import Tables

# Sales columns as Spark SQL over the order tables, by the table that supplies them. Fixed values:
# 750 ml a bottle, 0.264172 gallons a litre.
FACT = {
    "invoice_item_number": "concat('INV-', l_orderkey, '-', l_linenumber)",
    "vendor_number": "l_suppkey",
    "item_number": "l_partkey",
    "bottle_volume_ml": "750",
    "bottles_sold": "cast(l_quantity as bigint)",
    "sale_dollars": "l_extendedprice * (1 - l_discount)",
    "volume_sold_liters": "cast(l_quantity as bigint) * 0.75D",
    "volume_sold_gallons": "cast(l_quantity as bigint) * 0.75D * 0.264172D",
}
ORDER = {"sale_date": "to_date(o_orderdate)", "store_number": "o_custkey"}
STORE = {"city": "n_name", "county_number": "r_regionkey", "county": "r_name"}
ITEM = {
    "category": "p_brand",
    "category_name": "p_type",
    "item_description": "p_name",
    "pack": "p_size",
    "state_bottle_cost": "p_retailprice / 1.5D",
    "state_bottle_retail": "p_retailprice",
}
VENDOR = {"vendor_name": "s_name"}
COLUMNS = {**FACT, **ORDER, **STORE, **ITEM, **VENDOR}


def _sales_columns(names: Iterable[str]) -> list[Column]:
    return [F.expr(COLUMNS[c]).alias(c) for c in names]


def _stores(t: Tables, columns: Iterable[str]) -> DataFrame:
    places = t["nation"]
    if set(columns) & {"county", "county_number"}:
        places = places.join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return t["customer"].join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def sales_rows(t: Tables, columns: Iterable[str] = SALES_COLUMNS, lines: DataFrame | None = None) -> DataFrame:
    """One row per order line with the given sales columns; ``lines`` may be a choice of order lines."""
    columns = list(columns)
    df = t["lineitem"] if lines is None else lines
    if set(columns) & (ORDER.keys() | STORE.keys()):
        df = df.join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if set(columns) & STORE.keys():
        df = df.join(_stores(t, columns), F.col("o_custkey") == F.col("c_custkey"), "left")
    if set(columns) & ITEM.keys():
        df = df.join(t["part"], F.col("l_partkey") == F.col("p_partkey"), "left")
    if set(columns) & VENDOR.keys():
        df = df.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return df.select(*_sales_columns(columns))


def sales_sample(t: Tables, n: int = 10_000) -> DataFrame:
    """The rows of ``sales.curated_sample``, chosen on order lines alone: only ``n`` of them meet the
    customer, part and supplier tables."""
    dated = t["orders"].where(F.col("o_orderdate").isNotNull() & F.col("o_custkey").isNotNull())
    lines = require(t["lineitem"], "l_partkey").join(dated, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    first = first_rows(lines, [F.expr(COLUMNS[c]) for c in SAMPLE_ORDER], n)
    return sales_rows(t, lines=first)


def sales_totals(t: Tables, attributes: Iterable[str], measures: Sequence[str] = ("sale_dollars",),
                 period: str = "year") -> DataFrame:
    """The measures summed per period and attribute; sales lacking one of the measures are left out.

    ``sale_date`` is cut to the start of its ``period``. Sums are taken on the order key before the
    orders join and on the surrogate keys before each dimension join: a hot order, customer or part
    arrives at its join as a few rows per task. Lines of one order are added up first only when
    nothing finer than the order is wanted.
    """
    wanted = set(attributes)
    line_keys = []
    if wanted & (ITEM.keys() | {"item_number"}):
        line_keys.append("l_partkey")
    if wanted & (VENDOR.keys() | {"vendor_number"}):
        line_keys.append("l_suppkey")
    store_key = ["o_custkey"] if wanted & (STORE.keys() | {"store_number"}) else []

    lines = require(
        t["lineitem"].select("l_orderkey", *line_keys, *_sales_columns(measures)), *measures)
    if not line_keys:
        lines = _add_up(lines, measures, "l_orderkey")

    dated = lines.join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "left").withColumn(
        "sale_date", F.trunc(F.to_date("o_orderdate"), period))
    totals = _add_up(dated, measures, "sale_date", *line_keys, *store_key)

    if wanted & STORE.keys():
        totals = totals.join(_stores(t, wanted), F.col("o_custkey") == F.col("c_custkey"), "left")
    if wanted & ITEM.keys():
        totals = totals.join(t["part"], F.col("l_partkey") == F.col("p_partkey"), "left")
    if wanted & VENDOR.keys():
        totals = totals.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return totals.select("sale_date", *_sales_columns(attributes), *measures)


def _add_up(df: DataFrame, measures: Sequence[str], *keys: str) -> DataFrame:
    sums = {"sale_dollars": exact_sum, "bottles_sold": lambda _, m: F.sum(m)}
    return df.groupBy(*keys).agg(*[sums[m](df, m).alias(m) for m in measures])
