"""Registered projections, filters, joins, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import sql_functions
from lakeloom.functions.numbers import MONEY
from lakeloom.operators import aggregates, columns, joins, sketches, windows
from lakeloom.session import workspace
from lakeloom.sources.readers import split_record_kinds
from lakeloom.sources.tables import Tables

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# Labels of the columns that go back to rows; the last priority has none and is left out.
SHORT_NAMES = {"1-URGENT": "URG", "2-HIGH": "HGH", "3-MEDIUM": "MED", "4-NOT SPECIFIED": "NON"}


def filter_eq(s, d) -> DataFrame:
    """The same condition as attribute, column and SQL text."""
    c = Tables(s, d)["customer"]
    return c.filter(c.c_mktsegment == "BUILDING").filter(F.col("c_mktsegment") == "BUILDING").filter(
        "c_mktsegment = 'BUILDING'")


def filter_and(s, d) -> DataFrame:
    o = Tables(s, d)["orders"]
    return o.filter((o.o_orderstatus == "F") & (o.o_orderpriority == "1-URGENT"))


def filter_gt(s, d) -> DataFrame:
    return Tables(s, d)["customer"].filter(F.col("c_acctbal") > 2100).select("c_custkey", "c_acctbal")


def filter_array(s, d) -> DataFrame:
    words = Tables(s, d)["part"].select("p_partkey", F.split("p_name", " ").alias("words"))
    return words.filter(F.array_contains("words", "ring")).select("p_partkey", F.concat_ws(" ", "words").alias("name"))


def filter_nested(s, d) -> DataFrame:
    people = Tables(s, d)["customer"].select(
        F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("who"), "c_custkey")
    return people.filter(F.col("who.segment") == "MACHINERY").select("c_custkey", "who.name")


def project_arith(s, d) -> DataFrame:
    """Arithmetic on a number and on a number held as text."""
    c = Tables(s, d)["customer"].withColumn("balance", F.col("c_acctbal").cast("string"))
    return c.select(
        "c_custkey", (F.col("c_nationkey") + 1).alias("next_nation"),
        (F.col("balance").try_cast("double") * 100).alias("cents"))


def sketch_against_count(s, d) -> DataFrame:
    """The exact number of parts sold, and whether the sketch is within four standard errors of it."""
    lines = Tables(s, d)["lineitem"]
    sketch = aggregates.approx_distinct(lines, "l_partkey", 0.05).scalar()
    exact = lines.agg(F.count_distinct("l_partkey").alias("n_exact"))
    return exact.select(
        "n_exact", (F.abs(sketch - F.col("n_exact")) <= 4 * 0.05 * F.col("n_exact")).alias("is_close"))


def distinct_users(s, d) -> DataFrame:
    """Distinct users per kind of event: sketches of each day are stored and merged to days and to the whole month.

    Each estimate stands beside the exact count. Sketches of 2**17 registers are exact to the last user at this size.
    """
    e = Tables(s, d)["events"].select("event_type", F.to_date("ts").alias("day"), "user_id")
    path = workspace(s, "sketches")
    sketches.distinct_sketches(e, "user_id", ["event_type", "day"], 17).write.parquet(path)
    stored, out = s.read.parquet(path), []
    for keys in (["event_type", "day"], ["day"], ["event_type"]):
        exact = e.groupBy(*keys).agg(F.count_distinct("user_id").alias("n_exact"))
        estimates = sketches.estimated(sketches.merged_sketches(stored, keys))
        out.append(sketches.beside_exact(estimates, exact, keys).select(
            *[F.col(k) if k in keys else F.lit(None).alias(k) for k in ("event_type", "day")], "n_exact", "n_sketch", "error"))
    return out[0].unionByName(out[1]).unionByName(out[2])


def bitmap_members(s, d) -> DataFrame:
    """Which users had each kind of event: bitmaps per day, stored and merged, their members as rows."""
    e = Tables(s, d)["events"].select("event_type", F.to_date("ts").alias("day"), "user_id")
    path = workspace(s, "bitmaps")
    sketches.bitmaps(e, "user_id", "event_type", "day").write.parquet(path)
    return sketches.members(sketches.merged_bitmaps(s.read.parquet(path), "event_type"), "event_type")


def bitmap_sizes(s, d) -> DataFrame:
    """Number of distinct orders in which a supplier has lines, from bitmaps of the order numbers."""
    return sketches.set_sizes(sketches.bitmaps(Tables(s, d)["lineitem"], "l_orderkey", "l_suppkey"), "l_suppkey")


def sets_as_rows(s, d) -> DataFrame:
    """The set of suppliers of each part as one row per member."""
    return sketches.distinct_rows(Tables(s, d)["lineitem"], "l_suppkey", "l_partkey")


def sql_functions_used(s, d) -> DataFrame:
    """Revenue per year and state of the line, with its change, by SQL text that calls registered functions."""
    sql_functions.register(s)
    t = Tables(s, d)
    t["lineitem"].createOrReplaceTempView("called_lines")
    t["orders"].createOrReplaceTempView("called_orders")
    return s.sql("""WITH r AS (SELECT clean_label(concat(' ', nullif(l_returnflag, 'R'), ' ')) AS label, year(o_orderdate) AS year,
        cast(sum(cast(l_extendedprice AS decimal(18,4))) AS double) AS revenue, max(as_features(l_quantity, l_discount)[0]) AS top
      FROM called_lines JOIN called_orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT label, year, revenue, top, percent_change(revenue, lag(revenue) OVER (PARTITION BY label ORDER BY year)) AS change FROM r""")


def drop_lit(s, d) -> DataFrame:
    wide = columns.with_literals(Tables(s, d)["customer"], market="retail", note="dropped again")
    return wide.drop("note", "c_acctbal")


def cast_cols(s, d) -> DataFrame:
    o = Tables(s, d)["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    return columns.cast_columns(o, {"o_orderkey": "string", "o_custkey": "int", "o_totalprice": "float"})


def rename_cols(s, d) -> DataFrame:
    n = Tables(s, d)["customer"].select(F.col("c_custkey").alias("customer key"), F.col("c_name").alias("full name"))
    return columns.sanitize_names(n)


def select_existing(s, d) -> DataFrame:
    return columns.select_existing(Tables(s, d)["supplier"], ["s_suppkey", "s_phone", "s_name"])


def schema_info(s, d) -> DataFrame:
    return columns.column_profile(Tables(s, d)["orders"])


def gappy_events(s, d) -> DataFrame:
    """Events whose type is '?' for errors and whose value is missing below 10."""
    return Tables(s, d)["events"].select(
        "event_id", F.when(F.col("event_type") == "error", "?").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"))


def inner_join(s, d) -> DataFrame:
    """Text key against integer key."""
    t = Tables(s, d)
    left = t["orders"].select("o_orderkey", F.col("o_custkey").cast("string").alias("cust"))
    return joins.inner_join(left, t["customer"].select("c_custkey", "c_name"), "cust", "c_custkey", "bigint")


def lookup_unknown(s, d) -> DataFrame:
    """Customers per nation from pipe-delimited lines of both kinds; debtors carry a code nobody has."""
    t = Tables(s, d)
    code = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("X"), "c_nationkey")).otherwise(
        F.col("c_nationkey").cast("string"))
    lines = t["customer"].select(F.concat_ws("|", "c_name", "c_mktsegment", code).alias("value")).unionByName(
        t["nation"].select(F.concat_ws("|", "n_name", "n_nationkey").alias("value")))
    return joins.people_per_country(*split_record_kinds(lines))


def collect_set(s, d) -> DataFrame:
    types = aggregates.distinct_values(Tables(s, d)["events"], "event_type")
    return types.select(F.array_join("distinct_values", ",").alias("event_types"))


def pivoted(s, d) -> DataFrame:
    o = Tables(s, d)["orders"]
    return columns.pivot_sum(
        o, ["o_orderstatus"], "o_orderpriority", PRIORITIES,
        F.sum(F.col("o_totalprice").cast("decimal(18,4)")).cast("double"))


def ranked_orders(s, d, **outputs) -> DataFrame:
    o = Tables(s, d)["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return windows.ranked(o, ["o_custkey"], "o_orderdate", ["o_orderkey"], **outputs)


def with_int(df: DataFrame, name: str) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", F.col(name).cast("long").alias(name))


QUERIES = {
    "filter_eq": filter_eq,
    "filter_and": filter_and,
    "filter_gt": filter_gt,
    "filter_array": filter_array,
    "filter_nested": filter_nested,
    "project_arith": project_arith,
    "drop_lit": drop_lit,
    "cast_cols": cast_cols,
    "rename_cols": rename_cols,
    "select_existing": select_existing,
    "schema_info": schema_info,
    "clean_rows": lambda s, d: columns.clean(gappy_events(s, d)),
    "null_counts": lambda s, d: columns.null_counts(gappy_events(s, d)),
    "inner_join": inner_join,
    "lookup_unknown": lookup_unknown,
    "row_count": lambda s, d: Tables(s, d)["lineitem"].agg(F.count("*").alias("n")),
    "group_count": lambda s, d: aggregates.group_count(Tables(s, d)["events"], "event_type"),
    "group_sum_avg": lambda s, d: aggregates.sums_and_means(
        Tables(s, d)["lineitem"], ["l_returnflag"], ["l_extendedprice", "l_quantity"], exact=MONEY),
    "approx_distinct": sketch_against_count,
    "distinct_users": distinct_users,
    "bitmap_members": bitmap_members,
    "bitmap_sizes": bitmap_sizes,
    "sets_as_rows": sets_as_rows,
    "sql_functions": sql_functions_used,
    "collect_set": collect_set,
    "first_by": lambda s, d: aggregates.first_by(
        Tables(s, d)["orders"], ["o_custkey"], "o_totalprice", ["o_orderdate", "o_orderkey"]),
    "pivot_sum": pivoted,
    "unpivot": lambda s, d: columns.unpivot_present(
        pivoted(s, d), ["o_orderstatus"], SHORT_NAMES, "priority", "total"),
    "row_number": lambda s, d: with_int(ranked_orders(s, d, row_number="position"), "position"),
    "rank": lambda s, d: with_int(ranked_orders(s, d, rank="position"), "position"),
    "dense_rank": lambda s, d: with_int(ranked_orders(s, d, dense_rank="position"), "position"),
    "lag2": lambda s, d: ranked_orders(s, d, lag=("o_totalprice", 2, "two_before")),
    "largest_orders": lambda s, d: Tables(s, d)["orders"].orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20),
}

_GAPPY = """(SELECT event_id, CASE WHEN event_type = 'error' THEN '?' ELSE event_type END AS event_type,
  CASE WHEN value >= 10 THEN value END AS value FROM events)"""
_SUM = "CAST(SUM(CAST({0} AS DECIMAL(18,4))) AS DOUBLE)"
_PIVOT = "SELECT o_orderstatus, " + ", ".join(
    f"""CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) FILTER (o_orderpriority = '{p}') AS DOUBLE) AS "{p}\""""
    for p in PRIORITIES) + " FROM orders GROUP BY 1"
_WINDOW = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate"

ORACLES = {
    "filter_eq": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "filter_and": "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
    "filter_gt": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 2100",
    "filter_array": """SELECT p_partkey, p_name AS name FROM part
  WHERE list_contains(string_split(p_name, ' '), 'ring')""",
    "filter_nested": "SELECT c_custkey, c_name AS name FROM customer WHERE c_mktsegment = 'MACHINERY'",
    "project_arith": "SELECT c_custkey, c_nationkey + 1 AS next_nation, c_acctbal * 100 AS cents FROM customer",
    "drop_lit": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, 'retail' AS market FROM customer",
    "cast_cols": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
  CAST(o_totalprice AS FLOAT) AS o_totalprice FROM orders""",
    "rename_cols": "SELECT c_custkey AS customer_key, c_name AS full_name FROM customer",
    "select_existing": "SELECT s_suppkey, s_name FROM supplier",
    "schema_info": " UNION ALL ".join(
        f"SELECT '{name}' AS name, '{dtype}' AS type, count({name}) AS n_values FROM orders" for name, dtype in [
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
            ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]),
    "clean_rows": f"SELECT * FROM {_GAPPY} WHERE event_type <> '?' AND value IS NOT NULL",
    "null_counts": f"""SELECT count(*) - count(event_id) AS event_id, count(*) - count(event_type) AS event_type,
  count(*) - count(value) AS value FROM {_GAPPY}""",
    "inner_join": """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, c_custkey, c_name
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "lookup_unknown": """SELECT country_name, person_type, count(*) AS n_people FROM (
  SELECT CASE WHEN c_acctbal < 0 THEN 'X' || c_nationkey || ' - Unkown Country' ELSE n_name END AS country_name,
         c_mktsegment AS person_type
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1, 2""",
    "row_count": "SELECT count(*) AS n FROM lineitem",
    "group_count": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "group_sum_avg": "SELECT l_returnflag, " + ", ".join(
        f"{_SUM.format(c)} AS sum_{c}, {_SUM.format(c)} / count({c}) AS avg_{c}"
        for c in ("l_extendedprice", "l_quantity")) + " FROM lineitem GROUP BY 1",
    "approx_distinct": "SELECT count(DISTINCT l_partkey) AS n_exact, true AS is_close FROM lineitem",
    "distinct_users": """WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, user_id FROM events),
g AS (SELECT event_type, day, count(DISTINCT user_id) AS n FROM e GROUP BY GROUPING SETS ((event_type, day), (day), (event_type)))
SELECT event_type, day, n AS n_exact, n AS n_sketch, CAST(0 AS DOUBLE) AS error FROM g""",
    "bitmap_members": "SELECT DISTINCT event_type, user_id AS value FROM events",
    "bitmap_sizes": "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1",
    "sets_as_rows": "SELECT DISTINCT l_partkey, l_suppkey AS value FROM lineitem",
    "sql_functions": """WITH r AS (SELECT CASE l_returnflag WHEN 'R' THEN 'UNKNOWN' ELSE l_returnflag END AS label,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS revenue, max(l_quantity) AS top
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2), p AS (SELECT *, lag(revenue) OVER (PARTITION BY label ORDER BY year) AS b FROM r)
SELECT label, year, revenue, CAST(top AS DOUBLE) AS top,
  CASE WHEN b IS NULL OR b = 0 THEN CAST(0 AS DOUBLE) ELSE (revenue - b) / b * 100 END AS change FROM p""",
    "collect_set": "SELECT string_agg(event_type, ',' ORDER BY event_type) AS event_types FROM "
                   "(SELECT DISTINCT event_type FROM events)",
    "first_by": """SELECT o_custkey, o_totalprice AS first_o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
  WHERE rn = 1""",
    "pivot_sum": _PIVOT,
    "unpivot": f"WITH p AS ({_PIVOT}) SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT o_orderstatus, '{short}' AS priority, "{name}" AS total FROM p"""
        for name, short in SHORT_NAMES.items()) + ") WHERE total IS NOT NULL",
    "row_number": f"SELECT o_orderkey, o_custkey, row_number() {_WINDOW}, o_orderkey) AS position FROM orders",
    "rank": f"SELECT o_orderkey, o_custkey, rank() {_WINDOW}) AS position FROM orders",
    "dense_rank": f"SELECT o_orderkey, o_custkey, dense_rank() {_WINDOW}) AS position FROM orders",
    "lag2": f"""SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice,
  lag(o_totalprice, 2) {_WINDOW}, o_orderkey) AS two_before FROM orders""",
    "largest_orders": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
}
