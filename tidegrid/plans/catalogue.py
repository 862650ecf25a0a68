"""The named queries over the driver's tables and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import crops, curves, fields, layers, relations, reports, scenes, seasons, series

FLAGSHIP = "own_range_flagship"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _part in (series, relations, curves, fields, crops, layers, reports, seasons, scenes):
    QUERIES |= _part.QUERIES
    ORACLE_SQL |= _part.ORACLE_SQL
