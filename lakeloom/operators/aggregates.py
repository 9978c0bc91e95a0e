"""Aggregates used by the reports and text workloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import as_column, field, parse_double, parse_int, strip_ascii


def sums_and_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str], exact: str | None = None) -> DataFrame:
    """``sum_c`` and ``avg_c`` for every column ``c``, as doubles.

    ``exact`` names a decimal type to add up in, so that the result does not depend on the order of tasks. The values must fit
    it; without it they are added up as they are and no digit is lost to rounding.
    """
    def total(c: str) -> Column:
        return F.sum(F.col(c).cast(exact) if exact else F.col(c)).cast("double")

    return df.groupBy(*keys).agg(*[
        agg for c in columns for agg in (total(c).alias(f"sum_{c}"), (total(c) / F.count(c)).alias(f"avg_{c}"))])


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def approx_distinct(df: DataFrame, column: str, rsd: float = 0.05) -> DataFrame:
    return df.agg(F.approx_count_distinct(column, rsd).alias("n_distinct"))


def distinct_values(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """The set of values as a sorted array, for columns with few distinct values."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_set(column)).alias("distinct_values"))


def first_by(df: DataFrame, keys: Sequence[str], column: str, order: Sequence[str]) -> DataFrame:
    """The value in the first row by ``order``, for every group."""
    return df.groupBy(*keys).agg(F.min_by(column, F.struct(*order)).alias(f"first_{column}"))


def mean_parts(df: DataFrame, column: str | Column, exact: str | None = None) -> DataFrame:
    """Sum, count and mean of the values that are numbers.

    Sums of doubles depend on the order of tasks in their last digits; ``exact`` names a decimal type in which they do not.
    """
    x = as_column(column).try_cast(exact or "double")
    total = F.sum("x").cast("double")
    return df.select(x.alias("x")).agg(
        total.alias("total"), F.count("x").alias("n"), F.try_divide(total, F.count("x")).alias("mean"))


def variance_parts(df: DataFrame, column: str | Column) -> DataFrame:
    """Squared deviations from the mean added up, count and population variance, in one pass."""
    x = as_column(column).try_cast("double")
    return df.select(x.alias("x")).agg(
        (F.var_pop("x") * F.count("x")).alias("sum_sq_dev"), F.count("x").alias("n"),
        F.var_pop("x").alias("variance"))


def deviation_about(df: DataFrame, column: str | Column, mean: float) -> DataFrame:
    """Squared deviations about a mean given from outside, added up, and their count."""
    x = as_column(column).try_cast("double")
    return df.select(F.pow(x - F.lit(mean), 2).alias("d")).agg(
        F.sum("d").alias("sum_sq_dev"), F.count("d").alias("n"))


def _reported_field(index: int, sep: str) -> Column:
    """The field, NULL where the line is too short; empty fields at its end do not count."""
    return field(F.rtrim("value", F.lit(sep)), index, sep)


def count_by_field(lines: DataFrame, index: int = 7, sep: str = ",") -> DataFrame:
    """Lines per value of one field. A header counts as a line, quotes are plain characters, and
    lines too short to have the field are dropped (``short_lines`` counts them)."""
    return lines.select(_reported_field(index, sep).alias("key")).where(
        F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n"))


def short_lines(lines: DataFrame, index: int = 7, sep: str = ",") -> DataFrame:
    return lines.agg(F.count_if(_reported_field(index, sep).isNull()).alias("n_short"))


def sum_by_field(lines: DataFrame, key: int = 3, amount: int = 2, sep: str = ",") -> DataFrame:
    """Whole-number amounts added up per non-empty key; lines whose amount is no integer are skipped."""
    line = strip_ascii("value")
    pairs = lines.select(field(line, key, sep).alias("key"), parse_int(field(line, amount, sep)).alias("amount"))
    return pairs.where((F.col("key") != "") & F.col("amount").isNotNull()).groupBy("key").agg(
        F.sum("amount").alias("total"))


def measure(lines: DataFrame, index: int = 1, sep: str = ",") -> DataFrame:
    """One field of each line as a number."""
    return lines.select(parse_double(field("value", index, sep)).alias("x"))
