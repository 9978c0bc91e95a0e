"""Keeping and counting partitions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist a frame that several actions read, for the length of a ``with`` block.

    Blocks lost with an executor are computed again from the frame's own plan.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows of each non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))
