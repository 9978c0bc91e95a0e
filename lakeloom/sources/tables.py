"""Named Parquet tables of one data directory."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """``Tables(spark, folder)["orders"]`` reads ``folder/orders.parquet``."""

    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))
