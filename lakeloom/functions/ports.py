"""Application protocol of a TCP segment by its ports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
HTTP_PORTS = [80, 8091, 8092]
HTTPS_PORTS = [443]


def app_protocol(sport: Column, dport: Column) -> Column:
    """HTTP is tested before HTTPS; either end may carry the port."""
    return (
        F.when(sport.isin(HTTP_PORTS) | dport.isin(HTTP_PORTS), "HTTP")
        .when(sport.isin(HTTPS_PORTS) | dport.isin(HTTPS_PORTS), "HTTPS")
        .otherwise("OTHER"))
