"""Batch readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.functions.text import strip_ascii


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_json(spark: SparkSession, path: str, multiline: bool = False,
              schema: StructType | str | None = None) -> DataFrame:
    """JSON lines, or with ``multiline`` one array or object per file.

    Without a schema Spark reads the input twice, so pass one for large folders.
    """
    reader = spark.read.option("multiline", multiline)
    return (reader.schema(schema) if schema else reader).json(path)


def read_csv(spark: SparkSession, path: str, infer: bool = False,
             schema: StructType | str | None = None, **options: str) -> DataFrame:
    """CSV with a header row: all strings, inferred types, or a given schema."""
    reader = spark.read.option("header", True).options(**options)
    if schema:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_delimited(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Each text line as one ``array<string>`` column."""
    return spark.read.text(path).select(
        F.split("value", rf"\Q{sep}\E").alias("fields"))


def from_rows(spark: SparkSession, rows: list, schema: StructType | list[str] | str | None = None) -> DataFrame:
    """In-memory rows with default names, given names, or a full (nested) schema."""
    return spark.createDataFrame(rows, schema)


def integer_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    return spark.range(start, end)


def split_record_kinds(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pipe-delimited lines of two kinds as ``(countries, people)``.

    Two fields make a country ``name|code``; three or more a person ``name|type|code``.
    """
    fields = lines.select(F.split(strip_ascii("value"), "[|]").alias("f"))
    countries = fields.where(F.size("f") == 2).select(
        F.col("f")[0].alias("country_name"), F.col("f")[1].alias("code"))
    people = fields.where(F.size("f") >= 3).select(
        F.col("f")[0].alias("person_name"), F.col("f")[1].alias("person_type"), F.col("f")[2].alias("code"))
    return countries, people


def generate_measures(spark: SparkSession, n: int = 1_000_000, seed: int = 0) -> DataFrame:
    """Lines ``word,measure,word``: ten random letters, a value in [7.5, 9.5), ten random letters."""
    def letters(offset: int):
        return F.concat(*[
            F.chr((F.lit(97) + F.floor(F.rand(seed + offset + i) * 26)).cast("int")) for i in range(10)])

    measure = F.rand(seed) * 2 + 7.5
    return spark.range(n).select(
        F.concat_ws(",", letters(1), measure.cast("string"), letters(11)).alias("value"))
