"""Checks after the load, reconciliation, verdict and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.tsql import holds, minutes_between


def orphans(lines: DataFrame, headers: DataFrame) -> DataFrame:
    return lines.join(headers.select("SalesOrderID"), "SalesOrderID", "left_anti")


def without_lines(headers: DataFrame, lines: DataFrame) -> DataFrame:
    return headers.join(lines.select("SalesOrderID"), "SalesOrderID", "left_anti")


def subtotal_mismatches(headers: DataFrame, lines: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Headers with lines whose subtotal is off by more than the tolerance; lines are summed before the join."""
    sums = lines.groupBy("SalesOrderID").agg(F.sum("LineTotal").cast("decimal(38,6)").alias("lines_total"))
    return headers.join(sums, "SalesOrderID").where(F.abs(F.col("SubTotal") - F.col("lines_total")) > F.lit(tolerance).cast("decimal(10,4)"))


def duplicate_groups(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).count().where("count > 1")


def outside_domain(lines: DataFrame) -> DataFrame:
    return lines.where(holds(F.expr("OrderQty <= 0 OR UnitPrice < 0 OR UnitPriceDiscount < 0 OR UnitPriceDiscount > 1 OR LineTotal IS NULL OR ProductID IS NULL")))


def reconciled(left: Column, right: Column, tolerance: int = 0) -> Column:
    return F.when(F.abs(left - right) <= tolerance, "PASS").otherwise("FAIL")


def lag_hours(loaded: Column, source: Column) -> Column:
    """Hours that the warehouse is behind the source, never negative; null for an empty warehouse."""
    return F.greatest(minutes_between(loaded, source) / F.lit(60.0), F.lit(0.0))


def freshness_status(lag: Column, most: float) -> Column:
    return F.when(lag.isNull(), "WARN").when(lag <= most, "PASS").otherwise("FAIL")


def verdict(log: DataFrame) -> DataFrame:
    """Per run: counts by status and severity, whether to alert, and the failed checks, critical ones first."""
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    failed, critical = F.col("status") == "FAIL", F.col("severity") == "Critical"
    rank = F.when(critical, "0").otherwise("1")
    names = F.array_sort(F.collect_list(F.when(failed, F.concat(rank, F.col("check_name")))))
    return log.groupBy("run_id").agg(
        F.count("*").alias("checks_run"),
        n(F.col("status") == "PASS").alias("checks_passed"),
        n(failed).alias("checks_failed"),
        n(failed & critical).alias("critical_failed"),
        F.array_join(F.transform(names, lambda x: F.substr(x, F.lit(2))), ", ").alias("failed_checks"),
    ).withColumn("should_alert", F.col("critical_failed") > 0)


def status(critical_failed: Column, failed: Column, asked: Column | None = None) -> Column:
    """Derived from results; a caller may only ask for failure."""
    bad = critical_failed > 0
    if asked is not None:
        bad = holds(asked == "Failed") | bad
    return F.when(bad, "Failed").when(failed > 0, "CompletedWithWarnings").otherwise("Succeeded")
