"""Functions that SQL text can call by name.

They are SQL functions: a call is replaced by the function's own expression when a query is planned, so that nothing leaves the JVM and
filters are pushed through as if it had been written out.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# name(parameters) RETURNS type: expression or query
FUNCTIONS = {
    "clean_label(label STRING) RETURNS STRING": "trim(coalesce(label, 'UNKNOWN'))",
    "percent_change(now DOUBLE, before DOUBLE) RETURNS DOUBLE":
        "CASE WHEN now IS NULL OR before IS NULL OR before = 0 THEN 0D ELSE (now - before) / before * 100 END",
    "as_features(first DOUBLE, second DOUBLE DEFAULT NULL, third DOUBLE DEFAULT NULL) RETURNS ARRAY<DOUBLE>":
        "filter(array(first, second, third), x -> x IS NOT NULL)",
    "protocol_of(sport INT, dport INT) RETURNS STRING":
        "CASE WHEN sport IN (80, 8091, 8092) OR dport IN (80, 8091, 8092) THEN 'HTTP' "
        "WHEN sport = 443 OR dport = 443 THEN 'HTTPS' ELSE 'OTHER' END",
    "tokens_of(line STRING) RETURNS TABLE (at INT, token STRING)":
        r"SELECT pos, col FROM (SELECT posexplode(array_remove(split(line, '[ \\t\\n\\x0B\\f\\r]+'), '')))",
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session under their names, which are returned."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in FUNCTIONS]
