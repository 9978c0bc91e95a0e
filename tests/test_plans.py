"""Physical plans: what reaches the scan, what is cut before a shuffle, and what must not occur."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from lakeloom.operators.joins import inner_join
from lakeloom.plans import sales as reports
from lakeloom.plans.star import sales_rows, sales_totals
from lakeloom.sources.tables import Tables
from lakeloom.sources.writers import write_partitioned


def plan(df, whole=False):
    execution = df._jdf.queryExecution()
    return execution.toString() if whole else execution.executedPlan().toString()


def scans(text):
    return re.findall(r"FileScan.*", text)


def test_filters_reach_the_scan(spark, small):
    text = plan(e.queries()["filter_and"](spark, small))
    assert "EqualTo(o_orderstatus,F)" in text and "EqualTo(o_orderpriority,1-URGENT)" in text


def test_only_needed_columns_are_read(spark, small):
    text = plan(e.queries()["revenue_year"](spark, small))
    schemas = sorted(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas == ["l_orderkey:bigint,l_extendedprice:double,l_discount:double",
                       "o_orderkey:bigint,o_orderdate:timestamp_ntz"]


def test_joins_follow_the_columns(spark, small):
    t = Tables(spark, small)
    assert len(scans(plan(sales_rows(t, ["item_number", "sale_dollars"])))) == 1
    assert len(scans(plan(sales_rows(t, ["item_description", "sale_dollars"])))) == 2
    assert len(scans(plan(reports.top_vendors_year(
        sales_totals(t, ["vendor_name"], ("sale_dollars", "bottles_sold")))))) == 3


def test_lines_are_added_up_before_the_orders_join(spark, small):
    text = plan(sales_totals(Tables(spark, small), ["city"]))
    below_join = text[text.index("l_orderkey"):]
    assert re.search(r"HashAggregate\(keys=\[l_orderkey#\d+L\], functions=\[partial_sum", below_join)


@pytest.mark.parametrize("name", ["top_items_year", "top_cities_year", "top_categories_year", "top_vendors_year"])
def test_top_k_is_cut_before_the_shuffle(spark, small, name):
    text = plan(e.queries()[name](spark, small))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_partitions_are_pruned(spark, small, tmp_path):
    path = str(tmp_path / "orders")
    orders = Tables(spark, small)["orders"].withColumn("y", F.year("o_orderdate"))
    write_partitioned(orders, path, "y")
    text = plan(spark.read.parquet(path).where("y = 1998"))
    assert re.search(r"PartitionFilters: \[isnotnull\(y#\d+\), \(y#\d+ = 1998\)\]", text)


def test_pivot_needs_no_lookup_of_its_values(spark, small):
    assert len(scans(plan(e.queries()["pivot_sum"](spark, small)))) == 1


STORED = {"stream_enrich", "stream_dedup", "stream_promo", "shortest_path", "ml_forest", "ml_linreg", "ml_logreg"}


@pytest.mark.parametrize("name", sorted(set(e.queries()) - STORED))
def test_no_product_and_no_row_by_row_python(spark, small, name):
    text = plan(e.queries()[name](spark, small), whole=True)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which a few megabytes look like terabytes."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_join_key_is_split(spark, small_partitions):
    """Half of the rows share one key; the join spreads them over several tasks."""
    left = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("string").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("x"))
    right = spark.range(0, 200_000).select("id")
    joined = inner_join(left, right, "k", "id", "bigint")
    assert len(joined.collect()) == 200_000
    assert "skew=true" in plan(joined)


def test_hot_order_is_one_row_per_task_at_the_join(spark, small, tmp_path):
    """Every line belongs to one order: the orders join then receives at most one row per scan task."""
    folder = str(tmp_path)
    Tables(spark, small)["orders"].write.parquet(f"{folder}/orders.parquet")
    Tables(spark, small)["lineitem"].withColumn("l_orderkey", F.lit(1).cast("bigint")).repartition(6).write.parquet(
        f"{folder}/lineitem.parquet")
    t = Tables(spark, folder)
    report = reports.revenue_year(sales_totals(t, []))
    assert report.collect() == reports.revenue_year(sales_rows(t, ["sale_date", "sale_dollars"])).collect()
    text = plan(report)
    assert re.search(r"HashAggregate\(keys=\[l_orderkey#\d+L\], functions=\[partial_sum", text)
