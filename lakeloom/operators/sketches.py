"""Distinct values that need no array: sketches that merge, and sets of whole numbers as bitmaps.

Both are small rows per key and part of the data. They are stored once and merged to any coarser key without reading the data again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import as_column

LG_K = 12  # 2**12 registers: a standard error of 1.6 percent


def distinct_sketches(df: DataFrame, column: str, keys: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """``keys, sketch``: a HyperLogLog sketch of the values for each key. Missing values do not count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sketches of all rows with the same ``keys`` as one."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame) -> DataFrame:
    """``n_sketch`` in place of the sketch."""
    return sketches.withColumn("n_sketch", F.hll_sketch_estimate("sketch")).drop("sketch")


def beside_exact(estimates: DataFrame, exact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimates next to ``n_exact`` and their relative ``error``."""
    both = estimates.join(exact, list(keys)) if keys else estimates.crossJoin(exact)  # one row each
    return both.withColumn("error", F.try_divide(F.col("n_sketch") - F.col("n_exact"), F.col("n_exact")))


def distinct_rows(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """The set of values of each key as rows ``keys, value``: for values of any type and sets of any size."""
    return df.select(*keys, F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()


def bitmaps(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """The set of whole numbers of each key as rows ``keys, bucket, bitmap`` of 4 KB, one for every 32,768 numbers in a row.

    A set has as many rows as it spans buckets. Missing and negative values are left out. Numbers are shuffled and sorted as short rows,
    each once for its key; a bitmap is made where its numbers lie together, so that none but finished ones exist, one at a time.
    """
    value = F.col(column).cast("long")
    places = df.where(value >= 0).select(
        *keys, F.bitmap_bucket_number(value).alias("bucket"), F.bitmap_bit_position(value).alias("_place")).distinct()
    return places.repartition(*keys, "bucket").groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("_place").alias("bitmap"))


def merged_bitmaps(sets: DataFrame, *keys: str) -> DataFrame:
    """The union of all sets with the same ``keys``, bucket by bucket."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def set_sizes(sets: DataFrame, *keys: str) -> DataFrame:
    """``n``, the number of members of each set."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias("n"))


def _first_of(bucket: Column) -> Column:
    """The number that the first bit of a bucket stands for: 0 has bucket 0 to itself."""
    return F.when(bucket == 0, 0).otherwise((bucket - 1) * 32768 + 1)


def members(sets: DataFrame, *keys: str) -> DataFrame:
    """The members of bitmaps as rows ``keys, value``."""
    digits = F.regexp_extract_all(F.hex("bitmap"), F.lit(".."), F.lit(0))
    bytes_ = sets.select(*keys, "bucket", F.posexplode(digits).alias("at", "digits")).where("digits <> '00'")
    byte = F.conv("digits", 16, 10).cast("int")
    bits = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda i: F.getbit(byte, i) == 1)
    return bytes_.select(*keys, "bucket", "at", F.explode(bits).alias("bit")).select(
        *keys, (_first_of(as_column("bucket")) + F.col("at") * 8 + F.col("bit")).alias("value"))
