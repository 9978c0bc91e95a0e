"""Registered line, word and graph workloads."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import aggregates, columns, graph, scripts, words
from lakeloom.sources.tables import Tables


def unit_lines(s, d) -> DataFrame:
    """Order lines as text: order, line number and quantity with mixed white space."""
    li = Tables(s, d)["lineitem"]
    return li.select(F.concat(
        "l_orderkey", F.lit("   "), "l_linenumber", F.lit(" \t"), F.col("l_quantity").cast("int")).alias("value"))


def order_lines(s, d) -> DataFrame:
    """Orders as comma-separated text; every tenth price bracket has no whole-number amount."""
    o = Tables(s, d)["orders"]
    cents = F.col("o_totalprice") % 10 < 1
    amount = F.when(cents, F.format_string("%.2f", "o_totalprice")).otherwise(
        F.floor("o_totalprice").cast("string"))
    status = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    return o.select(F.concat_ws(",", "o_orderkey", "o_custkey", amount, status).alias("value"))


def sale_lines(s, d) -> DataFrame:
    """Eight fields, the last one the line status; returned lines lack it."""
    li = Tables(s, d)["lineitem"]
    base = [F.col(c).cast("string") for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")]
    status = F.when(F.col("l_returnflag") == "R", None).otherwise(F.col("l_linestatus"))
    return li.select(F.concat_ws(",", *base, status).alias("value"))


def measure_lines(s, d) -> DataFrame:
    li = Tables(s, d)["lineitem"]
    quantity = F.col("l_quantity").cast("string")
    return li.select(F.concat_ws(",", "l_returnflag", quantity, "l_linestatus").alias("value"))


def document_lines(s, d) -> DataFrame:
    return words.lines_of(Tables(s, d)["documents"])


def stripe_sizes(s, d) -> DataFrame:
    """Neighbours, counts and the last neighbour of each word, read off its stripes: those of a round are stored before the next round."""
    total = F.aggregate(F.map_values("stripe"), F.lit(0).cast("long"), lambda a, x: a + x)

    def sums(stripes: DataFrame) -> DataFrame:
        return stripes.groupBy("word").agg(
            F.sum("n_words").alias("n_words"), F.sum("n_pairs").alias("n_pairs"), F.max("last_word").alias("last_word"))

    rounds = [sums(stripes.select("word", F.size("stripe").alias("n_words"), total.alias("n_pairs"), F.array_max(F.map_keys("stripe")).alias(
        "last_word"))) for stripes in words.cooccur_stripes(document_lines(s, d), apart=True)]
    return sums(words.stored_in_turn("stripes", *rounds))


def referrals(s, d) -> DataFrame:
    """Customers linked both ways by orders: the buyer and the customer whose number the order key maps to."""
    t = Tables(s, d)
    n_customers = t["customer"].select(F.count("*")).scalar()
    edges = t["orders"].select(
        F.col("o_custkey").cast("string").alias("src"),
        F.pmod("o_orderkey", n_customers).cast("string").alias("dst"))
    return graph.stored(graph.both_ways(edges))


def referral_paths(s, d) -> DataFrame:
    """Hops from customer 0."""
    nodes = Tables(s, d)["customer"].select(
        F.col("c_custkey").cast("string").alias("node"), F.lit("_").alias("path"),
        F.when(F.col("c_custkey") == 0, 0).otherwise(-1).alias("dist"))
    return graph.shortest_paths(nodes, referrals(s, d), rounds=4)


def mean_of_quantity(s, d) -> DataFrame:
    return aggregates.mean_parts(aggregates.measure(measure_lines(s, d)), "x", exact="decimal(18,4)")


def variance_of_quantity(s, d) -> DataFrame:
    v = aggregates.variance_parts(aggregates.measure(measure_lines(s, d)), "x")
    return v.select(F.round("sum_sq_dev", 2).alias("sum_sq_dev"), "n", F.round("variance", 6).alias("variance"))


def script_word_lengths(s, d) -> DataFrame:
    """Token lengths counted by a user mapper, with a parameter, and a user reducer."""
    # Local functions travel to the workers by value, like those of a user's own script.
    def word_lengths(line: str, longest: int):
        return [(min(len(token), longest), 1) for token in line.split(" ") if token]

    def add_up(group: pd.DataFrame) -> pd.DataFrame:
        return group.groupby("length", as_index=False)["n"].sum()

    schema = "length bigint, n bigint"
    pairs = scripts.map_lines(document_lines(s, d), word_lengths, schema, longest=30)
    return scripts.reduce_groups(pairs, "length", add_up, schema)


def script_order_gaps(s, d) -> DataFrame:
    """Days between consecutive orders of a customer, by a user reducer that carries the last date along.

    ``streak`` counts the orders in a row, up to this one, that came within 120 days of the one before.
    """
    def gaps(key, parts):
        last, streak = None, 0
        for customer, order, date in scripts.rows_of(parts):
            days = None if last is None else (date - last).days
            streak = streak + 1 if days is not None and days <= 120 else 0
            last = date
            yield customer, order, days, streak

    orders = Tables(s, d)["orders"].select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return scripts.reduce_sorted(orders, ["o_custkey"], gaps, "customer bigint, order bigint, days int, streak int",
                                 order=["date", "o_orderkey"])


def script_reduce_join(s, d) -> DataFrame:
    """Customers per nation and segment by a reducer over mixed lines, in which the line of the nation comes before its customers.

    Every fourth nation has no line of its own.
    """
    def count_people(key, parts):
        name, segment, n = None, None, 0
        for nation, kind, value in scripts.rows_of(parts):
            if kind == "1":
                name = value
                continue
            if n and value != segment:
                yield name or f"{nation} - unknown", segment, n
                n = 0
            segment, n = value, n + 1
        if n:
            yield name or f"{key[0]} - unknown", segment, n

    t = Tables(s, d)
    nations = t["nation"].where("n_nationkey % 4 <> 0").select(
        F.concat_ws("|", "n_nationkey", F.lit("1"), "n_name").alias("value"))
    people = t["customer"].select(F.concat_ws("|", "c_nationkey", F.lit("2"), "c_mktsegment").alias("value"))
    fields = F.split("value", "[|]")
    lines = nations.unionByName(people).select(
        F.get(fields, 0).alias("nation"), F.get(fields, 1).alias("kind"), F.get(fields, 2).alias("name"))
    return scripts.reduce_sorted(lines, ["nation"], count_people, "nation string, segment string, n bigint", order=["kind", "name"])


QUERIES = {
    "last_token_filter": lambda s, d: columns.last_token_above(unit_lines(s, d), 30),
    "count_by_field": lambda s, d: aggregates.count_by_field(sale_lines(s, d)),
    "short_lines": lambda s, d: aggregates.short_lines(sale_lines(s, d)),
    "sum_by_type": lambda s, d: aggregates.sum_by_field(order_lines(s, d)),
    "mean_parts": mean_of_quantity,
    "variance_parts": variance_of_quantity,
    "word_count": lambda s, d: words.word_count(document_lines(s, d)),
    "script_word_lengths": script_word_lengths,
    "script_order_gaps": script_order_gaps,
    "script_reduce_join": script_reduce_join,
    "cooccur_pairs": lambda s, d: words.partners_per_word(*words.pair_counts(document_lines(s, d), apart=True)),
    "cooccur_stripes": stripe_sizes,
    "common_neighbors": lambda s, d: graph.common_neighbors(referrals(s, d)).drop("list_of"),
    "shortest_path": referral_paths,
}

_SPACE = r"[ \t\n\x0b\f\r]+"
_PAIRS = rf"""
WITH lines AS (SELECT row_number() OVER () AS id, line
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)),
tokens AS (SELECT id, translate(regexp_replace(regexp_replace(w, '^[^A-Za-z]+', ''), '[^A-Za-z]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM (SELECT id, unnest(string_split_regex(line, '{_SPACE}')) AS w FROM lines)),
counts AS (SELECT id, w, count(*) AS n FROM tokens WHERE w <> '' GROUP BY 1, 2),
pairs AS (SELECT a.w AS first, b.w AS second, CAST(sum(a.n * b.n) AS BIGINT) AS n
  FROM counts a JOIN counts b ON a.id = b.id AND a.w <> b.w GROUP BY 1, 2)
"""
_EDGES = """
WITH size AS (SELECT count(*) AS n FROM customer),
links AS (SELECT o_custkey AS x, o_orderkey % n AS y FROM orders, size WHERE o_custkey <> o_orderkey % n),
edges AS (SELECT CAST(x AS VARCHAR) AS src, CAST(y AS VARCHAR) AS dst FROM links
  UNION SELECT CAST(y AS VARCHAR), CAST(x AS VARCHAR) FROM links)
"""


def _paths_sql(rounds: int) -> str:
    """One block of CTEs per hop."""
    ctes = [_EDGES.strip(), "r0 AS (SELECT '0' AS node, '_' AS path, 0 AS dist)"]
    for i in range(1, rounds + 1):
        ctes.append(f"""r{i} AS (SELECT * FROM r{i - 1} UNION ALL
  SELECT dst, min(node || ':' || path), {i} FROM r{i - 1} JOIN edges ON node = src
  WHERE dist = {i - 1} AND dst NOT IN (SELECT node FROM r{i - 1}) GROUP BY dst)""")
    return ",\n".join(ctes) + f"""
SELECT CAST(c_custkey AS VARCHAR) AS node, coalesce(path, '_') AS path, coalesce(dist, -1) AS dist
FROM customer LEFT JOIN r{rounds} ON node = CAST(c_custkey AS VARCHAR)"""


ORACLES = {
    "last_token_filter": """SELECT CAST(l_orderkey AS VARCHAR) AS key, CAST(l_quantity AS BIGINT) AS value
  FROM lineitem WHERE l_quantity > 30""",
    "count_by_field": "SELECT l_linestatus AS key, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1",
    "short_lines": "SELECT count(*) AS n_short FROM lineitem WHERE l_returnflag = 'R'",
    "sum_by_type": """SELECT o_orderstatus AS key, CAST(sum(floor(o_totalprice)) AS BIGINT) AS total FROM orders
  WHERE NOT o_totalprice % 10 < 1 AND o_orderstatus <> 'P' GROUP BY 1""",
    "mean_parts": "SELECT sum(l_quantity) AS total, count(*) AS n, avg(l_quantity) AS mean FROM lineitem",
    "variance_parts": """SELECT round(var_pop(l_quantity) * count(*), 2) AS sum_sq_dev, count(*) AS n,
  round(var_pop(l_quantity), 6) AS variance FROM lineitem""",
    "word_count": rf"""SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split_regex(text, '{_SPACE}')) AS word FROM documents) WHERE word <> '' GROUP BY 1""",
    "script_word_lengths": """SELECT least(length(word), 30) AS length, count(*) AS n FROM (
  SELECT unnest(string_split(line, ' ')) AS word FROM (
    SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) WHERE word <> '' GROUP BY 1""",
    "script_order_gaps": """WITH o AS (SELECT o_custkey AS customer, o_orderkey AS "order", CAST(o_orderdate AS DATE) AS date
  FROM orders), g AS (SELECT *, CAST(date - lag(date) OVER c AS INTEGER) AS days FROM o
  WINDOW c AS (PARTITION BY customer ORDER BY date, "order")),
r AS (SELECT *, count(*) FILTER (days IS NULL OR days > 120) OVER (PARTITION BY customer ORDER BY date, "order"
  ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT customer, "order", days, CAST(count(*) OVER (PARTITION BY customer, run ORDER BY date, "order" ROWS UNBOUNDED PRECEDING) - 1
  AS INTEGER) AS streak FROM r""",
    "script_reduce_join": """SELECT coalesce(n_name, c_nationkey || ' - unknown') AS nation, c_mktsegment AS segment, count(*) AS n
  FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 4 <> 0) ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    "cooccur_pairs": f"""{_PAIRS} SELECT first AS word, count(*) AS n_partners, CAST(sum(n) AS BIGINT) AS n_pairs,
  max(n) AS top_count, CAST(sum(n * (length(second) + 31 * ascii(second) + 1009 * ascii(right(second, 1)))) AS BIGINT)
  AS bound FROM pairs GROUP BY 1""",
    "cooccur_stripes": f"""{_PAIRS} SELECT first AS word, count(*) AS n_words,
  CAST(sum(n) AS BIGINT) AS n_pairs, max(second) AS last_word FROM pairs GROUP BY 1""",
    "common_neighbors": f"""{_EDGES}, pairs AS (SELECT src AS a, dst AS b FROM edges WHERE src < dst)
SELECT a, b, neighbor FROM pairs LEFT JOIN (
  SELECT p.a, p.b, e.dst AS neighbor FROM pairs p JOIN edges e ON e.src = p.a
  JOIN edges f ON f.src = p.b AND f.dst = e.dst) USING (a, b)""",
    "shortest_path": _paths_sql(4),
}
