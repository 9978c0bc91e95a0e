"""Build one report from a sales table and write it to its mart.

``spark-submit lakeloom/plans/marts.py revenue_year --sales /lake/sales --out /marts``
``spark-submit lakeloom/plans/marts.py sales_curated --sales /lake/sales --jdbc-url jdbc:... --batchsize 5000``
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from lakeloom.plans import sales
from lakeloom.session import build_session
from lakeloom.sources.readers import read_table
from lakeloom.sources.writers import jdbc_options, write_mart, write_mart_files

# Mart table and the report that fills it. Two names for the item report, as its users know both.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "revenue_year": sales.revenue_year,
    "top_items_year": sales.top_items_year,
    "top_products_year": sales.top_items_year,
    "top_cities_year": sales.top_cities_year,
    "mom_revenue_city": sales.mom_revenue_city,
    "top_categories_year": sales.top_categories_year,
    "top_vendors_year": sales.top_vendors_year,
    "yoy_revenue_category": sales.yoy_revenue_category,
    "yoy_revenue_city": sales.yoy_revenue_city,
    "cumulative_revenue_year": sales.cumulative_revenue_year,
    "running_avg_revenue_year": sales.running_avg_revenue_year,
    "sales_curated": sales.curated_sales,
    "sales_curated_sample": sales.curated_sample,
}


def build(spark: SparkSession, report: str, sales_path: str) -> DataFrame:
    return REPORTS[report](read_table(spark, sales_path))


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("report", choices=REPORTS)
    parser.add_argument("--sales", required=True, help="Parquet folder with the sales columns")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="folder of Parquet marts")
    target.add_argument("--jdbc-url")
    parser.add_argument("--driver")
    parser.add_argument("--user")
    parser.add_argument("--batchsize", type=int, default=5000)
    parser.add_argument("--connections", type=int, help="upper limit of parallel JDBC writers")
    parser.add_argument("--mode", choices=["append", "overwrite"], default="append")
    args = parser.parse_args(argv)

    df = build(build_session(args.report), args.report, args.sales)
    if args.out:
        write_mart_files(df, f"{args.out}/{args.report}", args.mode)
    else:
        # The password comes from the environment, where it shows in no process list.
        write_mart(df, jdbc_options(
            args.jdbc_url, args.report, args.driver, args.user, os.environ.get("MART_PASSWORD"), args.batchsize,
            args.connections, truncate=args.mode == "overwrite"), args.mode)


if __name__ == "__main__":
    main()
