"""Small expressions and the stored intermediate tables that the operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import workspace

# White space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only, so that the result does not depend on a locale or a Unicode version."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def store(df: DataFrame, label: str, *by: str) -> DataFrame:
    """``df`` written once below the cluster's shared folder, in a folder per value of ``by``, and read back.

    Later steps read the files: they do not repeat the work above, a lost executor costs no more than
    its own tasks, and the planner knows the size.
    """
    path = workspace(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> Column:
    """All columns of a row as one struct: names an operator adds cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"{name}.`{c}`").alias(c) for c in columns])


def pieces(text: bytes, separator: re.Pattern, size: int = 1 << 20) -> Iterator[bytes]:
    """``text`` in parts of about ``size`` bytes, cut where a separator begins: no match between separators is divided."""
    start = 0
    while start < len(text):
        found = separator.search(text, start + size) if start + size < len(text) else None
        stop = found.start() if found else len(text)
        yield text[start:stop]
        start = stop
