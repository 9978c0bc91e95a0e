"""Equi-join and lookup join.

No side is hinted as a broadcast: Spark broadcasts one whose size, known or measured at run time, is
below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise sorts both and splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               key_type: str | None = None) -> DataFrame:
    """Inner join on keys of different names, both kept; ``key_type`` aligns keys of different types."""
    lk, rk = left[left_key], right[right_key]
    if key_type:
        lk, rk = lk.try_cast(key_type), rk.try_cast(key_type)
    return left.join(right, lk == rk, "inner")


def lookup_or_unknown(fact: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name`` from ``dim``; a key it lacks reads as '<key> - Unkown Country' (a fixed output text).

    Of several names for one key the last in text order counts.
    """
    names = dim.groupBy(key).agg(F.max(name).alias(name))
    return fact.join(names, key, "left").withColumn(
        name, F.coalesce(name, F.concat(key, F.lit(" - Unkown Country"))))


def people_per_country(countries: DataFrame, people: DataFrame) -> DataFrame:
    """People counted per country name and type.

    People are counted per code before the lookup, so that a hot country joins as one row per type.
    """
    counted = people.groupBy("code", "person_type").agg(F.count("*").alias("n"))
    named = lookup_or_unknown(counted, countries, "code", "country_name")
    return named.groupBy("country_name", "person_type").agg(F.sum("n").alias("n_people"))
