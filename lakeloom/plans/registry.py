"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.plans import event_queries, frame_queries, io_queries, learning_queries, sales_queries, text_queries

MODULES = [sales_queries, frame_queries, text_queries, io_queries, event_queries, learning_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
