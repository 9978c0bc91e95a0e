"""Registered round trips through files, tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import partitions
from lakeloom.session import workspace
from lakeloom.sources import catalog, readers, writers
from lakeloom.sources.tables import Tables

ORDER_TYPES = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate string, o_orderpriority string")
ORDER_COLUMNS = dict(c.split() for c in ORDER_TYPES.split(", "))


def orders(s, d) -> DataFrame:
    """Orders with the date as text, so that every format gives back the same types."""
    return Tables(s, d)["orders"].select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")


def by_year(s, d) -> DataFrame:
    return orders(s, d).withColumn("reg_year", F.substr("o_orderdate", F.lit(1), F.lit(4)))


def typed(df: DataFrame) -> DataFrame:
    """Text columns back to the order types."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in ORDER_COLUMNS.items()])


def _database(s, label: str) -> str:
    """A new database whose tables live in the shared folder."""
    where = workspace(s, label)
    name = f"lakeloom_{where.rpartition('-')[2]}"
    catalog.create_database(s, name, where)
    return name


def io_parquet(s, d) -> DataFrame:
    path = workspace(s, "parquet")
    writers.write_mart_files(orders(s, d), path)
    return readers.read_table(s, path)


def io_parquet_part(s, d) -> DataFrame:
    path = workspace(s, "parquet-part")
    writers.write_partitioned(by_year(s, d), path, "reg_year")
    back = s.read.schema(by_year(s, d).schema).parquet(path)
    return back.where(F.col("reg_year") == "1998")


def io_csv(s, d) -> DataFrame:
    path = workspace(s, "csv")
    writers.write_csv(orders(s, d), path)
    return typed(readers.read_csv(s, path))


def io_csv_inferred(s, d) -> DataFrame:
    path = workspace(s, "csv-inferred")
    writers.write_csv(orders(s, d).drop("o_orderdate"), path)
    return readers.read_csv(s, path, infer=True).withColumns({
        "o_orderkey": F.col("o_orderkey").cast("bigint"), "o_custkey": F.col("o_custkey").cast("bigint")})


def io_json(s, d) -> DataFrame:
    path = workspace(s, "json")
    writers.write_jsonl(orders(s, d), path)
    return readers.read_json(s, path).select(*ORDER_COLUMNS)


def io_delimited(s, d) -> DataFrame:
    path = workspace(s, "delimited")
    writers.write_csv(orders(s, d).select("o_orderkey", "o_orderpriority"), path, header="false", sep=";")
    fields = F.col("fields")
    return readers.read_delimited(s, path).select(
        fields[0].cast("bigint").alias("o_orderkey"), fields[1].alias("o_orderpriority"))


def io_key_value(s, d) -> DataFrame:
    path = workspace(s, "kv")
    writers.write_key_values(orders(s, d).groupBy("o_custkey").agg(F.count("*").alias("n")), path)
    parts = F.split("value", "\t")
    return s.read.text(path).select(parts[0].cast("bigint").alias("o_custkey"), parts[1].cast("bigint").alias("n"))


def load_overwrite(s, d) -> DataFrame:
    """Load files into a table twice; the second load replaces the first."""
    path = workspace(s, "load")
    writers.write_csv(orders(s, d), path)
    db = _database(s, "load-db")
    catalog.create_delimited_table(s, f"{db}.orders_in", ORDER_COLUMNS)
    for _ in range(2):
        catalog.load_overwrite(s, f"{db}.orders_in", path)
    return catalog.run_query(s, f"SELECT * FROM {db}.orders_in")


def export_csv(s, d) -> DataFrame:
    """A query result as CSV files."""
    catalog.temp_view(orders(s, d), "orders_to_export")
    path = workspace(s, "export")
    result = catalog.run_query(
        s, "SELECT o_orderstatus, count(*) AS n FROM orders_to_export GROUP BY o_orderstatus")
    writers.write_csv(result, path)
    return readers.read_csv(s, path, schema="o_orderstatus string, n bigint")


def table_csv_external(s, d) -> DataFrame:
    """External table over quoted CSV with a header, every column text."""
    path = workspace(s, "quoted")
    writers.write_csv(orders(s, d), path, quoteAll="true")
    db = _database(s, "quoted-db")
    catalog.create_csv_table(s, f"{db}.orders_csv", list(ORDER_COLUMNS), path)
    return typed(s.table(f"{db}.orders_csv"))


def table_insert_select(s, d) -> DataFrame:
    """Delimited external table copied into a managed Parquet table."""
    path = workspace(s, "star")
    writers.write_csv(orders(s, d), path, header="false")
    db = _database(s, "star-db")
    catalog.create_delimited_table(s, f"{db}.star", ORDER_COLUMNS, path)
    catalog.create_table(s, f"{db}.star_parquet", ORDER_COLUMNS)
    catalog.insert_select(s, f"{db}.star_parquet", f"{db}.star")
    return s.table(f"{db}.star_parquet")


def _partitioned_table(s, d, fmt: str) -> DataFrame:
    db = _database(s, f"part-{fmt}")
    columns = {**ORDER_COLUMNS, "reg_year": "string"}
    catalog.create_table(s, f"{db}.orders_part", columns, fmt, ["reg_year"])
    catalog.insert_partitioned(by_year(s, d), f"{db}.orders_part", overwrite=True)
    return s.table(f"{db}.orders_part")


def io_json_multiline(s, d) -> DataFrame:
    """Nations nested in their regions: one JSON document over many lines per region, read back and flattened."""
    t = Tables(s, d)
    nested = t["region"].join(t["nation"], F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_regionkey", "r_name").agg(
        F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("nations"))
    document = F.to_json(F.struct("r_name", "nations"), {"pretty": "true"})
    path = workspace(s, "nested")
    nested.select(document.alias("value"), F.col("r_regionkey").alias("part")).write.partitionBy("part").text(path)
    back = readers.read_json(s, f"{path}/*", multiline=True)
    return back.select("r_name", F.inline("nations")).select("r_name", F.col("n_nationkey").cast("int"), "n_name")


def kept_frame(s, d) -> DataFrame:
    """A persisted choice of order lines, read by two actions."""
    lines = Tables(s, d)["lineitem"].where("l_discount >= 0.05")
    with partitions.kept(lines.select("l_returnflag", "l_quantity")) as df:
        total = df.count()
        flags = df.select("l_returnflag").distinct().count()
    return lines.groupBy("l_returnflag").agg(F.count("*").alias("n")).select(
        "l_returnflag", "n", F.lit(total).alias("n_all"), F.lit(flags).alias("n_flags"))


def partition_count(s, d) -> DataFrame:
    """Rows that lie in the three partitions which six are merged into."""
    merged = Tables(s, d)["orders"].select("o_orderkey").repartition(6).coalesce(3)
    return partitions.partition_sizes(merged).agg(F.count("*").alias("n_partitions"), F.sum("n").alias("n_rows"))


QUERIES = {
    "io_json_multiline": io_json_multiline,
    "kept_frame": kept_frame,
    "partition_count": partition_count,
    "io_parquet": io_parquet,
    "io_parquet_part": io_parquet_part,
    "io_csv": io_csv,
    "io_csv_inferred": io_csv_inferred,
    "io_json": io_json,
    "io_delimited": io_delimited,
    "io_key_value": io_key_value,
    "load_overwrite": load_overwrite,
    "export_csv": export_csv,
    "table_csv_external": table_csv_external,
    "table_insert_select": table_insert_select,
    "table_partitioned_parquet": lambda s, d: _partitioned_table(s, d, "parquet"),
    "table_partitioned_csv": lambda s, d: _partitioned_table(s, d, "csv"),
    "temp_view_sql": lambda s, d: catalog.temp_view(Tables(s, d)["customer"], "customer_view"),
    "global_view": lambda s, d: catalog.global_view(Tables(s, d)["supplier"], "supplier_view"),
}

_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority{0} FROM orders"""
_ALL = _ORDERS.format("")
_YEARS = _ORDERS.format(", strftime(o_orderdate, '%Y') AS reg_year")

ORACLES = {
    "io_json_multiline": """SELECT r_name, CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name
  FROM region JOIN nation ON r_regionkey = n_regionkey""",
    "kept_frame": """WITH l AS (SELECT * FROM lineitem WHERE l_discount >= 0.05)
SELECT l_returnflag, count(*) AS n, (SELECT count(*) FROM l) AS n_all,
  (SELECT count(DISTINCT l_returnflag) FROM l) AS n_flags FROM l GROUP BY 1""",
    "partition_count": "SELECT CAST(3 AS BIGINT) AS n_partitions, count(*) AS n_rows FROM orders",
    "io_parquet": _ALL,
    "io_parquet_part": f"{_YEARS} WHERE year(o_orderdate) = 1998",
    "io_csv": _ALL,
    "io_csv_inferred": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "io_json": _ALL,
    "io_delimited": "SELECT o_orderkey, o_orderpriority FROM orders",
    "io_key_value": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1",
    "load_overwrite": _ALL,
    "export_csv": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1",
    "table_csv_external": _ALL,
    "table_insert_select": _ALL,
    "table_partitioned_parquet": _YEARS,
    "table_partitioned_csv": _YEARS,
    "temp_view_sql": "SELECT * FROM customer",
    "global_view": "SELECT * FROM supplier",
}
