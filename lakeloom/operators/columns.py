"""Projection, schema and row-guard operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import delimited_tokens, parse_int


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of ``columns`` is NULL."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def with_literals(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(dtype) for name, dtype in types.items()})


def sanitize_names(df: DataFrame) -> DataFrame:
    """Column names with underscores in place of spaces."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns})


def clean(df: DataFrame, marker: str = "?") -> DataFrame:
    """Turn ``marker`` into NULL in text columns, then drop rows with any NULL."""
    return df.replace(marker, None).dropna("any")


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in each column."""
    return df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type in short and in JSON form, nullability."""
    rows = [(i, f.name, f.dataType.simpleString(), f.dataType.typeName(), f.dataType.json(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, type_name string, json string, nullable boolean")


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type as Spark sees it in the data, and the number of values present."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return counts.unpivot([], df.columns, "name", "n_values").withColumn("type", types[F.col("name")])


def last_token_above(lines: DataFrame, threshold: int = 30, delimiters: str = "[\t ]*") -> DataFrame:
    """First token and last number of each line whose last number exceeds ``threshold``.

    Every such line counts; no maximum is taken. Lines with fewer than two tokens or with a last
    token that is not a number are skipped.
    """
    tokens = lines.select(delimited_tokens("value", delimiters).alias("t")).where(F.size("t") > 1)
    pairs = tokens.select(F.col("t")[0].alias("key"), parse_int(F.element_at("t", -1)).alias("value"))
    return pairs.where(F.col("value") > threshold)


def pivot_sum(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], amount: Column) -> DataFrame:
    """One column per value; the values are given, which saves a pass that would look them up."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(amount)


def unpivot_present(df: DataFrame, ids: Sequence[str], labels: dict[str, str], name: str, value: str) -> DataFrame:
    """Columns back to rows under the labels given for them, without NULL cells.

    A column that has no label is left out.
    """
    long = df.unpivot(list(ids), list(labels), name, value).where(F.col(value).isNotNull())
    relabel = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return long.withColumn(name, relabel[F.col(name)])
