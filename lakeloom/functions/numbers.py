"""Exact sums, means and percent changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lakeloom.functions.text import as_column

MONEY = "decimal(18,4)"


def money(df: DataFrame, name: str) -> Column:
    """The column in fixed point; a decimal column, such as an earlier sum, stays as it is."""
    is_decimal = isinstance(df.schema[name].dataType, DecimalType)
    return F.col(name) if is_decimal else F.col(name).cast(MONEY)


def exact_sum(df: DataFrame, name: str) -> Column:
    """Sum in fixed point, so that the result does not depend on how rows are spread over tasks."""
    return F.sum(money(df, name))


def exact_total(df: DataFrame, name: str) -> Column:
    return exact_sum(df, name).cast("double")


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def percent_change(current: Column, previous: Column) -> Column:
    """``(current - previous) / previous * 100``; 0.0 for no previous value or a previous value of zero."""
    change = (current - previous) / previous * F.lit(100.0)
    return F.when(previous.isNull() | (previous == 0), F.lit(0.0)).otherwise(change)


def name_or_unknown(col: str | Column) -> Column:
    """NULL becomes UNKNOWN and surrounding spaces go; a blank name stays an empty string."""
    return F.trim(F.coalesce(as_column(col), F.lit("UNKNOWN")))
