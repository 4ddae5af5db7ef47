"""Queries over the driver's tables and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegate.plans import etl_queries, run_log


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return etl_queries.QUERIES | run_log.QUERIES


def oracle_sql() -> dict[str, str]:
    return etl_queries.ORACLES | run_log.ORACLES
