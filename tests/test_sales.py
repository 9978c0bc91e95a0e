"""Reports on hand-made sales, and relations between them."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import sales as reports
from lakeloom.plans.star import sales_rows, sales_sample, sales_totals
from lakeloom.sources.tables import Tables

SCHEMA = ("sale_date date, city string, vendor_name string, item_number bigint, item_description string, "
          "bottles_sold bigint, sale_dollars double")
SALES = [
    (date(2020, 1, 5), "Ames", "V1", 1, " gin ", 2, 10.0),
    (date(2020, 1, 9), "Ames", "V1", 1, "gin", 1, 5.0),
    (date(2020, 3, 1), "Ames", "V2", 2, None, 1, 30.0),
    (date(2021, 2, 1), None, "V2", 2, None, 4, 0.0),
    (date(2022, 2, 1), None, None, 3, "rum", 4, 8.0),
    (date(2022, 5, 1), " ", "V1", 3, "rum", None, 7.0),
    (None, "Ames", "V1", 3, "rum", 1, 99.0),
    (date(2022, 5, 1), "Ames", "V1", 3, "rum", 1, None),
]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(SALES, SCHEMA)


def test_revenue_year(sales, rows):
    assert rows(reports.revenue_year(sales)) == [(2020, 45.0), (2021, 0.0), (2022, 15.0)]


def test_top_items_groups_by_number_and_clean_name(sales, rows):
    assert rows(reports.top_items_year(sales, k=1)) == [
        (2020, 1, "UNKNOWN", 1, 30.0), (2021, 1, "UNKNOWN", 4, 0.0), (2022, 1, "rum", 4, 8.0)]


def test_cities_know_unknown_but_months_do_not(sales, rows):
    assert (2022, 1, "UNKNOWN", 4, 8.0) in rows(reports.top_cities_year(sales))
    assert rows(reports.mom_revenue_city(sales)) == [
        (" ", date(2022, 5, 1), 7.0, 0.0, 0.0),
        ("Ames", date(2020, 1, 1), 15.0, 0.0, 0.0),
        ("Ames", date(2020, 3, 1), 30.0, 15.0, 100.0)]


def test_yoy_previous_present_year_and_zero_base(sales, rows):
    assert rows(reports.yoy_revenue_city(sales)) == [
        ("", 2022, 7.0, 0.0, 0.0), ("Ames", 2020, 45.0, 0.0, 0.0),
        ("UNKNOWN", 2021, 0.0, 0.0, 0.0), ("UNKNOWN", 2022, 8.0, 0.0, 0.0)]


def test_running_reports(sales, rows):
    assert rows(reports.cumulative_revenue_year(sales)) == [
        (2020, 45.0, 45.0), (2021, 0.0, 45.0), (2022, 15.0, 60.0)]
    assert rows(reports.running_avg_revenue_year(sales)) == [
        (2020, 45.0, 45.0), (2021, 0.0, 22.5), (2022, 15.0, 20.0)]


def test_category_column_can_be_chosen(sales, rows):
    by_vendor = reports.top_categories_year(sales, k=1, category="vendor_name")
    assert rows(by_vendor)[0] == (2020, 1, "V2", 30.0)


def test_curated_keeps_existing_columns_in_schema_order(sales):
    extra = sales.withColumn("note", F.lit("x"))
    assert reports.curated_sales(extra).columns == [
        "sale_date", "city", "vendor_name", "item_number", "item_description", "bottles_sold", "sale_dollars"]


def test_sample_is_guarded_and_limited(spark, small):
    sample = reports.curated_sample(sales_rows(Tables(spark, small)), n=100)
    assert sample.count() == 100
    assert sample.columns == reports.SALES_COLUMNS


def test_sample_of_lines_is_the_sample_of_sales(spark, small, rows):
    t = Tables(spark, small)
    assert rows(sales_sample(t, 200)) == rows(reports.curated_sample(sales_rows(t), 200))


@pytest.mark.parametrize("report, attributes, period", [
    (reports.top_items_year, ["item_number", "item_description"], "year"),
    (reports.top_vendors_year, ["vendor_name"], "year"),
    (reports.mom_revenue_city, ["city"], "month"),
    (reports.yoy_revenue_city, ["city"], "year"),
])
def test_totals_give_the_same_reports_as_rows(spark, small, rows, report, attributes, period):
    t = Tables(spark, small)
    both = ["sale_dollars", "bottles_sold"]
    by_row = report(sales_rows(t, ["sale_date", *attributes, *both]))
    assert rows(report(sales_totals(t, attributes, both, period))) == rows(by_row)


def test_totals_leave_out_sales_without_a_measure(spark, small, tmp_path, rows):
    folder = str(tmp_path)
    for name in ("orders", "customer", "nation", "region"):
        Tables(spark, small)[name].write.parquet(f"{folder}/{name}.parquet")
    holes = Tables(spark, small)["lineitem"].withColumn(
        "l_quantity", F.when(F.col("l_linenumber") > 2, F.col("l_quantity")))
    holes.write.parquet(f"{folder}/lineitem.parquet")
    t = Tables(spark, folder)
    both = ("sale_dollars", "bottles_sold")
    assert rows(reports.top_cities_year(sales_totals(t, ["city"], both))) == rows(
        reports.top_cities_year(sales_rows(t, ["sale_date", "city", *both])))
    assert rows(reports.revenue_year(sales_totals(t, []))) == rows(
        reports.revenue_year(sales_rows(t, ["sale_date", "sale_dollars"])))


def test_last_cumulative_is_the_total_and_top_k_stays_below(spark, small):
    totals = sales_totals(Tables(spark, small), ["item_number", "item_description"], ("sale_dollars", "bottles_sold"))
    whole = sum(r.total_revenue for r in reports.revenue_year(totals).collect())
    last = max(r.cumulative_revenue for r in reports.cumulative_revenue_year(totals).collect())
    assert last == pytest.approx(whole)
    assert sum(r.total_revenue for r in reports.top_items_year(totals).collect()) <= whole
