"""Queries over the run history: state, verdicts, bookmarks and metrics.

The history is derived from ``orders`` and ``lineitem`` by the same projection in Spark and in the oracle: one run for
each order month, one check row for each run and order priority, alerts for every third run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.tsql import percent, seconds_between
from tidegate.operators import checks
from tidegate.plans.driver_tables import read
from tidegate.sources.entities import DETAIL, HEADER, stamp

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
NOW = "2003-01-01 00:00:00"

LOG_SQL = """
o AS (SELECT *, CAST((year(o_orderdate) - 1990) * 12 + month(o_orderdate) AS BIGINT) AS run_id FROM orders),
log AS (SELECT run_id, o_orderpriority AS check_name, CASE WHEN o_orderpriority LIKE '1%' THEN 'RowCountReconciliation' WHEN o_orderpriority LIKE '2%' THEN 'FinancialReconciliation' ELSE 'DomainCheck' END AS check_type,
  CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'Critical' ELSE 'Warning' END AS severity,
  CASE WHEN min(o_orderkey) % 7 = 0 THEN 'FAIL' WHEN min(o_orderkey) % 7 = 1 THEN 'WARN' ELSE 'PASS' END AS status, CASE WHEN min(o_orderkey) % 7 <= 2 THEN count(*) END AS variance FROM o GROUP BY 1, 2),
entity AS (SELECT run_id, 'SalesOrderHeader' AS entity_name, count(*) AS rows_extracted, count(*) FILTER (o_orderkey % 11 <> 0) AS rows_loaded, count(*) FILTER (o_orderkey % 11 = 0) AS rows_rejected FROM o GROUP BY 1
  UNION ALL SELECT CAST((year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS BIGINT), 'SalesOrderDetail', count(*), count(*) FILTER (l_orderkey % 13 <> 0), count(*) FILTER (l_orderkey % 13 = 0) FROM lineitem GROUP BY 1),
verdict AS (SELECT run_id, count(*) AS checks_run, count(*) FILTER (status = 'PASS') AS checks_passed, count(*) FILTER (status = 'FAIL') AS checks_failed, count(*) FILTER (status = 'FAIL' AND severity = 'Critical') AS critical_failed FROM log GROUP BY 1),
runs AS (SELECT r.run_id, start_time, CASE WHEN r.run_id % 17 <> 0 THEN start_time + to_milliseconds(n * 7) END AS end_time, CASE WHEN r.run_id % 12 = 1 THEN 'Full' ELSE 'Incremental' END AS load_type, n AS rows_extracted,
  CASE WHEN r.run_id % 17 = 0 THEN 'Running' WHEN critical_failed > 0 THEN 'Failed' WHEN checks_failed > 0 THEN 'CompletedWithWarnings' ELSE 'Succeeded' END AS status, checks_run, checks_failed
  FROM (SELECT run_id, min(o_orderdate) + INTERVAL 2 HOUR AS start_time, count(*) AS n FROM o GROUP BY 1) r JOIN verdict v ON r.run_id = v.run_id),
alert AS (SELECT run_id * 10 + k AS alert_id, run_id, k = 2 OR run_id % 2 = 0 AS delivered, CASE WHEN k = 1 THEN 'ValidationFailure' ELSE 'Escalation' END AS alert_type FROM runs, (SELECT unnest([1, 2]) AS k) WHERE run_id % 3 = 0)"""


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql.replace("{L}", LOG_SQL.strip())
        return f

    return add


def _month(day: str):
    return ((F.year(day) - 1990) * 12 + F.month(day)).cast("long")


def checks_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("check_name")
    first = F.min("o_orderkey") % 7
    grouped = read(spark, sf_dir, "orders").groupBy(_month("o_orderdate").alias("run_id"), F.col("o_orderpriority").alias("check_name")).agg(first.alias("_r"), F.count("*").alias("_n"))
    kind = F.when(name.like("1%"), "RowCountReconciliation").when(name.like("2%"), "FinancialReconciliation").otherwise("DomainCheck")
    return grouped.select(
        "run_id", "check_name", kind.alias("check_type"), F.when(name.like("1%") | name.like("2%"), "Critical").otherwise("Warning").alias("severity"),
        F.when(F.col("_r") == 0, "FAIL").when(F.col("_r") == 1, "WARN").otherwise("PASS").alias("status"), F.when(F.col("_r") <= 2, F.col("_n")).alias("variance"),
    )


def run_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    def one(table, day, key, by, entity):
        bad = F.col(key) % by == 0
        return read(spark, sf_dir, table).groupBy(_month(day).alias("run_id")).agg(F.count("*").alias("rows_extracted"), F.count(F.when(~bad, 1)).alias("rows_loaded"), F.count(F.when(bad, 1)).alias("rows_rejected")).select("run_id", F.lit(entity).alias("entity_name"), "rows_extracted", "rows_loaded", "rows_rejected")

    return one("orders", "o_orderdate", "o_orderkey", 11, HEADER.name).unionByName(one("lineitem", "l_shipdate", "l_orderkey", 13, DETAIL.name))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "orders").groupBy(_month("o_orderdate").alias("run_id")).agg((F.min("o_orderdate") + F.expr("interval 2 hour")).alias("start_time"), F.count("*").alias("rows_extracted"))
    v = checks.verdict(checks_log(spark, sf_dir)).select("run_id", "checks_run", "checks_failed", "critical_failed")
    open_run = F.col("run_id") % 17 == 0
    millis = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("rows_extracted") * 7 / 1000).cast("decimal(18,6)"))
    return r.join(v, "run_id").select(
        "run_id", "start_time", F.when(~open_run, F.col("start_time") + millis).alias("end_time"), F.when(F.col("run_id") % 12 == 1, "Full").otherwise("Incremental").alias("load_type"), "rows_extracted",
        F.when(open_run, "Running").otherwise(checks.status(F.col("critical_failed"), F.col("checks_failed"))).alias("status"), "checks_run", "checks_failed",
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = runs(spark, sf_dir).where("run_id % 3 = 0").select("run_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    return each.select((F.col("run_id") * 10 + F.col("k")).alias("alert_id"), "run_id", ((F.col("k") == 2) | (F.col("run_id") % 2 == 0)).alias("delivered"), F.when(F.col("k") == 1, "ValidationFailure").otherwise("Escalation").alias("alert_type"))


def _n(condition):
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


@query("WITH {L} SELECT *, critical_failed > 0 AS should_alert FROM verdict")
def validation_summary(spark, sf_dir):
    return checks.verdict(checks_log(spark, sf_dir)).drop("failed_checks")


@query("WITH {L} SELECT run_id, string_agg(check_name, ', ' ORDER BY CASE severity WHEN 'Critical' THEN 0 ELSE 1 END, check_name) AS failed_checks FROM log WHERE status = 'FAIL' GROUP BY run_id")
def failed_check_list(spark, sf_dir):
    return checks.verdict(checks_log(spark, sf_dir)).where("checks_failed > 0").select("run_id", "failed_checks")


@query("WITH {L} SELECT run_id, CAST(sum(rows_extracted) AS BIGINT) AS rows_extracted, CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded, CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected FROM entity GROUP BY run_id")
def run_rollup(spark, sf_dir):
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return run_entities(spark, sf_dir).groupBy("run_id").agg(total("rows_extracted"), total("rows_loaded"), total("rows_rejected"))


@query("WITH {L} SELECT run_id, CASE WHEN run_id % 23 = 0 OR critical_failed > 0 THEN 'Failed' WHEN checks_failed > 0 THEN 'CompletedWithWarnings' ELSE 'Succeeded' END AS status, run_id % 23 = 0 OR critical_failed > 0 AS required_manual_intervention FROM verdict")
def run_status_derivation(spark, sf_dir):
    asked = F.when(F.col("run_id") % 23 == 0, "Failed").when(F.col("run_id") % 2 == 0, "Succeeded")
    found = checks.verdict(checks_log(spark, sf_dir)).withColumn("status", checks.status(F.col("critical_failed"), F.col("checks_failed"), asked))
    return found.select("run_id", "status", (F.col("status") == "Failed").alias("required_manual_intervention"))


@query(
    """WITH marks AS (SELECT 'SalesOrderHeader' AS entity_name, max(o_orderdate) AS w FROM orders UNION ALL SELECT 'SalesOrderDetail', max(l_shipdate) FROM lineitem)
    SELECT 'Incremental' AS load_type, coalesce(min(w), TIMESTAMP '1900-01-01') AS watermark_from FROM marks WHERE entity_name IN ('SalesOrderHeader', 'SalesOrderDetail')
    UNION ALL SELECT 'Full', TIMESTAMP '1900-01-01'"""
)
def watermark_resolve(spark, sf_dir):
    marks = read(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("w")).select(F.lit(HEADER.name).alias("entity_name"), "w")
    marks = marks.unionByName(read(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("w")).select(F.lit(DETAIL.name).alias("entity_name"), "w"))
    asked = F.transform(F.split(F.lit("SalesOrderHeader , SalesOrderDetail"), ","), lambda x: F.trim(x))
    start = stamp("1900-01-01 00:00:00")
    part = marks.where(F.array_contains(asked, F.col("entity_name"))).agg(F.coalesce(F.min("w"), start).alias("watermark_from")).select(F.lit("Incremental").alias("load_type"), "watermark_from")
    return part.unionByName(spark.range(1).select(F.lit("Full").alias("load_type"), start.alias("watermark_from")))


@query(
    """WITH {L} SELECT load_type, max(greatest(start_time, TIMESTAMP '1995-06-01')) AS watermark_value, arg_max(run_id, start_time) AS last_run_id FROM runs WHERE status IN ('Succeeded', 'CompletedWithWarnings') GROUP BY load_type"""
)
def watermark_advance(spark, sf_dir):
    done = runs(spark, sf_dir).where(F.col("status").isin("Succeeded", "CompletedWithWarnings"))
    return done.groupBy("load_type").agg(F.greatest(F.max("start_time"), stamp("1995-06-01 00:00:00")).alias("watermark_value"), F.max_by("run_id", "start_time").alias("last_run_id"))


@query(
    """WITH {L} SELECT coalesce(a.run_id, b.run_id) AS run_id, coalesce(a.entity_name, b.entity_name) AS entity_name, coalesce(b.x, a.rows_extracted) AS rows_extracted, a.rows_loaded AS rows_loaded
    FROM entity a FULL OUTER JOIN (SELECT run_id, entity_name, CASE WHEN run_id % 2 = 0 THEN rows_extracted + 1 END AS x FROM entity WHERE run_id % 4 <> 1) b ON a.run_id = b.run_id AND a.entity_name = b.entity_name"""
)
def run_entity_merge(spark, sf_dir):
    old = run_entities(spark, sf_dir)
    new = old.where("run_id % 4 <> 1").select("run_id", "entity_name", F.when(F.col("run_id") % 2 == 0, F.col("rows_extracted") + 1).alias("x"))
    both = old.join(new, ["run_id", "entity_name"], "full_outer")
    return both.select("run_id", "entity_name", F.coalesce("x", "rows_extracted").alias("rows_extracted"), "rows_loaded")


@query("WITH {L} SELECT run_id, max(alert_id) AS alert_id FROM alert GROUP BY run_id")
def latest_alert_per_run(spark, sf_dir):
    return alerts(spark, sf_dir).groupBy("run_id").agg(F.max("alert_id").alias("alert_id"))


@query(f"WITH {{L}} SELECT round(date_diff('minute', max(end_time), TIMESTAMP '{NOW}') / 60.0, 4)::DOUBLE AS hours_since_success, date_diff('minute', max(end_time), TIMESTAMP '{NOW}') / 60.0 > 26 AS silent FROM runs WHERE status <> 'Failed' AND status <> 'Running'")
def last_success_age(spark, sf_dir):
    last = runs(spark, sf_dir).where(~F.col("status").isin("Failed", "Running")).agg(F.max("end_time").alias("end"))
    hours = F.timestamp_diff("MINUTE", F.date_trunc("minute", "end"), stamp(NOW)) / 60
    return last.select(F.round(hours, 4).alias("hours_since_success"), (hours > 26).alias("silent"))


@query(
    """WITH {L} SELECT count(*) AS runs_total, count(*) FILTER (status = 'Succeeded') AS runs_succeeded, count(*) FILTER (status = 'Failed') AS runs_failed, count(*) FILTER (status = 'CompletedWithWarnings') AS runs_with_warnings,
    CAST(coalesce(sum(rows_extracted), 0) AS BIGINT) AS rows_extracted, round(100.0::DOUBLE * count(*) FILTER (status <> 'Failed') / count(*), 4) AS unattended_percent FROM runs WHERE status <> 'Running'"""
)
def run_summary_metrics(spark, sf_dir):
    done = runs(spark, sf_dir).where("status <> 'Running'")
    return done.agg(
        F.count("*").alias("runs_total"), _n(F.col("status") == "Succeeded").alias("runs_succeeded"), _n(F.col("status") == "Failed").alias("runs_failed"), _n(F.col("status") == "CompletedWithWarnings").alias("runs_with_warnings"),
        F.coalesce(F.sum("rows_extracted"), F.lit(0)).alias("rows_extracted"), percent(_n(F.col("status") != "Failed"), F.count("*")).alias("unattended_percent"),
    )


@query("WITH {L} SELECT count(*) AS checks_run, count(*) FILTER (status = 'PASS') AS checks_passed, count(*) FILTER (status = 'FAIL') AS checks_failed, round(100.0::DOUBLE * count(*) FILTER (status = 'PASS') / count(*), 4) AS pass_percent FROM log")
def check_metrics(spark, sf_dir):
    passed = _n(F.col("status") == "PASS")
    return checks_log(spark, sf_dir).agg(F.count("*").alias("checks_run"), passed.alias("checks_passed"), _n(F.col("status") == "FAIL").alias("checks_failed"), percent(passed, F.count("*")).alias("pass_percent"))


@query("WITH {L} SELECT count(*) AS reconciliations, count(*) FILTER (status = 'PASS') AS passed, CAST(sum(abs(coalesce(variance, 0))) AS BIGINT) AS total_variance FROM log WHERE check_type = 'RowCountReconciliation'")
def reconciliation_metrics(spark, sf_dir):
    rows = checks_log(spark, sf_dir).where("check_type = 'RowCountReconciliation'")
    return rows.agg(F.count("*").alias("reconciliations"), _n(F.col("status") == "PASS").alias("passed"), F.sum(F.abs(F.coalesce("variance", F.lit(0)))).alias("total_variance"))


@query("WITH {L} SELECT count(*) AS alerts_raised, count(*) FILTER (delivered) AS alerts_delivered FROM alert")
def alert_metrics(spark, sf_dir):
    return alerts(spark, sf_dir).agg(F.count("*").alias("alerts_raised"), _n(F.col("delivered")).alias("alerts_delivered"))


@query("WITH {L} SELECT quantile_cont(CAST(rows_extracted * 7 AS DOUBLE) / 1000, 0.5) AS median_seconds FROM runs WHERE status <> 'Running'")
def median_duration(spark, sf_dir):
    done = runs(spark, sf_dir).where("status <> 'Running'").select(seconds_between(F.col("start_time"), F.col("end_time")).cast("double").alias("s"))
    return done.agg(F.percentile("s", 0.5).alias("median_seconds"))


@query("WITH {L} SELECT check_name, severity, count(*) AS failures, max(run_id) AS last_run FROM log WHERE status = 'FAIL' GROUP BY ALL ORDER BY failures DESC, check_name")
def failed_check_breakdown(spark, sf_dir):
    return checks_log(spark, sf_dir).where("status = 'FAIL'").groupBy("check_name", "severity").agg(F.count("*").alias("failures"), F.max("run_id").alias("last_run")).orderBy(F.desc("failures"), "check_name")


@query("WITH {L} SELECT run_id, load_type, status, rows_extracted, CAST(CASE WHEN end_time IS NOT NULL THEN CAST(rows_extracted * 7 AS DECIMAL(12,0)) * CAST(0.001 AS DECIMAL(4,3)) END AS DECIMAL(12,3)) AS duration_seconds FROM runs ORDER BY run_id")
def run_ledger(spark, sf_dir):
    return runs(spark, sf_dir).select("run_id", "load_type", "status", "rows_extracted", seconds_between(F.col("start_time"), F.col("end_time")).alias("duration_seconds")).orderBy("run_id")


@query("WITH {L} SELECT run_id, status, start_time FROM runs ORDER BY run_id DESC LIMIT 10")
def recent_runs(spark, sf_dir):
    return runs(spark, sf_dir).select("run_id", "status", "start_time").orderBy(F.desc("run_id")).limit(10)


@query("WITH {L} SELECT run_id, status, load_type, rows_extracted, checks_run, checks_failed, coalesce(n, 0) AS alerts_raised FROM runs LEFT JOIN (SELECT run_id AS id, count(*) AS n FROM alert GROUP BY 1) ON run_id = id")
def view_run_summary(spark, sf_dir):
    raised = alerts(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("n"))
    return runs(spark, sf_dir).join(raised, "run_id", "left").select("run_id", "status", "load_type", "rows_extracted", "checks_run", "checks_failed", F.coalesce("n", F.lit(0)).alias("alerts_raised"))
