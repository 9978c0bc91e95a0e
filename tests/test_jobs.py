"""The two command-line jobs."""

import json

import pytest

from lakeloom.plans import marts
from lakeloom.plans.star import sales_rows
from lakeloom.sources.tables import Tables
from lakeloom.streaming import enrich_job


@pytest.fixture(scope="module")
def sales_table(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "sales")
    sales_rows(Tables(spark, small)).write.parquet(path)
    return path


@pytest.mark.parametrize("report", sorted(marts.REPORTS))
def test_every_report_fills_its_mart(spark, sales_table, tmp_path, rows, report):
    out = str(tmp_path)
    marts.main([report, "--sales", sales_table, "--out", out])
    mart = spark.read.parquet(f"{out}/{report}")
    assert mart.count() > 0
    assert rows(mart) == rows(marts.build(spark, report, sales_table))


def test_append_doubles_and_overwrite_does_not(spark, sales_table, tmp_path):
    def run(mode):
        marts.main(["revenue_year", "--sales", sales_table, "--out", str(tmp_path), "--mode", mode])
        return spark.read.parquet(f"{tmp_path}/revenue_year").count()

    once = run("overwrite")
    assert run("append") == 2 * once
    assert run("overwrite") == once


def test_enrichment_from_files_to_files(spark, tmp_path):
    source = str(tmp_path / "raw")
    spark.createDataFrame([("k", json.dumps({"id": "a"})), (None, "bad"), (None, None)], "key string, value string") \
        .write.parquet(source)
    enrich_job.main(["--source", source, "--sink", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "cp"),
                     "--enriched-topic", "good", "--failed-topic", "bad", "--drain"])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.topic, r.key) for r in back.select("topic", "key").collect()) == [("bad", None), ("good", "a")]
