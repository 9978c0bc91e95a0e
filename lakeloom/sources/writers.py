"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def jdbc_options(url: str, table: str, driver: str | None = None, user: str | None = None,
                 password: str | None = None, batchsize: int = 5000, num_partitions: int | None = None,
                 truncate: bool = False) -> dict[str, str]:
    """Writer options of a relational mart.

    ``num_partitions`` caps the connections; without it every partition of the result writes.
    """
    given = {
        "url": url, "dbtable": table, "driver": driver, "user": user, "password": password,
        "batchsize": str(batchsize), "numPartitions": num_partitions and str(num_partitions),
        "truncate": "true" if truncate else None,
    }
    return {k: v for k, v in given.items() if v}


def write_mart(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    """Write a report over JDBC. Appending twice doubles the rows; ``overwrite`` with ``truncate`` does not."""
    df.write.format("jdbc").options(**options).mode(mode).save()


def write_mart_files(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(path)


def write_mart_batch(path: str):
    """A micro-batch writer whose repeated batches replace themselves."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def write_mart_batch_jdbc(options: dict[str, str]):
    """A micro-batch writer over JDBC. The batch number is a column of the mart: a batch that comes again
    after a failure appends again, and its first, possibly partial, rows carry the same number."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_mart(df.withColumn("batch_id", F.lit(batch_id)), options)
    return write


def write_partitioned(df: DataFrame, path: str, *keys: str, fmt: str = "parquet", mode: str = "overwrite",
                      **options: str) -> None:
    """One folder per key value. Rows are brought together by key first, so that a task does not open
    a file for every value; Spark splits a hot value over several tasks and files."""
    gathered = df.hint("rebalance", *[F.col(k) for k in keys])
    gathered.write.format(fmt).options(**options).partitionBy(*keys).mode(mode).save(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", **options: str) -> None:
    df.write.mode(mode).option("header", True).options(**options).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines; NULL fields are written as null."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_key_values(df: DataFrame, path: str, mode: str = "errorifexists", sep: str = "\t") -> None:
    """Columns of each row joined by a tab, one line per row; NULL gives an empty field."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *cells).alias("value")).write.mode(mode).text(path)
