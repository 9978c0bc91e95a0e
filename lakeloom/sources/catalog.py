"""Databases, tables and views of the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_database(spark: SparkSession, name: str, location: str | None = None, use: bool = False) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    if use:
        spark.sql(f"USE {name}")


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {dtype}" for name, dtype in columns.items())


def create_csv_table(spark: SparkSession, name: str, columns: Sequence[str], location: str,
                     sep: str = ",", quote: str = '"') -> None:
    """External table over quoted CSV files with a header row; every column reads as text."""
    spark.sql(
        f"CREATE TABLE {name} ({_columns(dict.fromkeys(columns, 'string'))}) USING csv "
        f"OPTIONS (header 'true', sep '{sep}', quote '{quote}', enforceSchema 'true') LOCATION '{location}'")


def create_delimited_table(spark: SparkSession, name: str, columns: dict[str, str], location: str | None = None,
                           sep: str = ",", header: bool = False) -> None:
    """Typed table over delimited text, external when it has a location; a bad value reads as NULL."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE {name} ({_columns(columns)}) USING csv "
        f"OPTIONS (sep '{sep}', header '{str(header).lower()}', mode 'PERMISSIVE'){where}")


def create_table(spark: SparkSession, name: str, columns: dict[str, str], fmt: str = "parquet",
                 partitioned_by: Sequence[str] = (), location: str | None = None) -> None:
    """Managed table, or external with ``location``; ``partitioned_by`` names some of the columns."""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} ({_columns(columns)}) USING {fmt}{parts}{where}")


def insert_select(spark: SparkSession, target: str, source: str) -> None:
    spark.sql(f"INSERT INTO {target} SELECT * FROM {source}")


def insert_partitioned(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert by column position; the partition columns come last and their values pick the partitions.

    ``overwrite`` replaces only the partitions that ``df`` has rows for.
    """
    spark = df.sparkSession
    n_keys = sum(c.isPartition for c in spark.catalog.listColumns(table))
    gathered = df.hint("rebalance", *[F.col(c) for c in df.columns[len(df.columns) - n_keys:]])
    # insertInto takes the overwrite mode from the session only.
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        gathered.write.insertInto(table, overwrite=overwrite)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def load_overwrite(spark: SparkSession, table: str, path: str, sep: str = ",", header: bool = True) -> None:
    """Replace the rows of a table by those of delimited text files, which stay where they are."""
    rows = spark.read.schema(spark.table(table).schema).csv(path, sep=sep, header=header)
    rows.write.insertInto(table, overwrite=True)


def avro_table_ddl(name: str, schema_literal: str) -> str:
    """DDL of an Avro table with its record schema; to run in a session with Hive support."""
    return (
        f"CREATE TABLE {name} STORED AS AVRO "
        f"TBLPROPERTIES ('avro.schema.literal'='{schema_literal}')")


def write_avro_table(df: DataFrame, name: str, schema_literal: str) -> None:
    """Create an Avro table and fill it; needs Hive support in the session."""
    spark = df.sparkSession
    spark.sql(avro_table_ddl(name, schema_literal))
    df.write.insertInto(name)


def run_query(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Register a view of this session and read it back."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(f"SELECT * FROM {name}")


def global_view(df: DataFrame, name: str) -> DataFrame:
    """Register a view of the application and read it from a new session."""
    df.createOrReplaceGlobalTempView(name)
    return df.sparkSession.newSession().sql(f"SELECT * FROM global_temp.{name}")
