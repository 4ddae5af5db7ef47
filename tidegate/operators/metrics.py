"""Figures over a store's run history, and their report as Markdown and JSON."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field

from pyspark.sql import functions as F

from tidegate.operators.alerts import AlertLog
from tidegate.operators.pipeline import SCHEMAS, run_log
from tidegate.sources.entities import DETAIL, HEADER
from tidegate.sources.store import Store


def percent(part: float, whole: float) -> float:
    """Four decimals; 0 where there is nothing to divide by."""
    return round(100.0 * part / whole, 4) if whole else 0.0


@dataclass
class Metrics:
    generated_at_utc: str
    total_runs: int = 0
    scheduled_runs: int = 0
    manual_runs: int = 0
    backfill_runs: int = 0
    succeeded: int = 0
    completed_with_warnings: int = 0
    failed: int = 0
    runs_requiring_manual_intervention: int = 0
    autonomous_run_rate_pct: float = 0.0
    rows_extracted: int = 0
    rows_loaded: int = 0
    rows_quarantined: int = 0
    row_load_rate_pct: float = 0.0
    checks_executed: int = 0
    checks_passed: int = 0
    checks_failed: int = 0
    check_pass_rate_pct: float = 0.0
    critical_checks_failed: int = 0
    reconciliation_checks: int = 0
    reconciliation_passed: int = 0
    reconciliation_pass_rate_pct: float = 0.0
    row_count_variance_total: int = 0
    alerts_raised: int = 0
    alerts_delivered: int = 0
    total_runtime_seconds: float = 0.0
    median_run_seconds: float = 0.0
    slowest_run_seconds: float = 0.0
    warehouse_orders: int = 0
    warehouse_order_lines: int = 0
    failed_check_breakdown: list[dict] = field(default_factory=list)
    quarantine_breakdown: list[dict] = field(default_factory=list)
    runs: list[dict] = field(default_factory=list)


def _count(condition) -> object:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0))


def collect(store: Store, now: str) -> Metrics:
    """Every figure from the store's tables; runs still open have no outcome and are left out."""
    table = lambda name: store.table(name, SCHEMAS[name])
    ended = run_log(store).where("status <> 'Running'")
    trigger, status = F.col("run_trigger"), F.col("status")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    seconds = F.col("duration_seconds")
    runs = ended.agg(
        F.count("*").alias("total_runs"), _count(trigger == "Scheduled").alias("scheduled_runs"), _count(trigger == "Manual").alias("manual_runs"), _count(trigger == "Backfill").alias("backfill_runs"),
        _count(status == "Succeeded").alias("succeeded"), _count(status == "CompletedWithWarnings").alias("completed_with_warnings"), _count(status == "Failed").alias("failed"),
        _count(F.col("required_manual_intervention")).alias("runs_requiring_manual_intervention"), total("rows_extracted").alias("rows_extracted"), total("rows_loaded").alias("rows_loaded"),
        total("rows_rejected").alias("rows_quarantined"), F.round(total(seconds), 3).alias("total_runtime_seconds"), F.round(F.coalesce(F.max(seconds), F.lit(0.0)), 3).alias("slowest_run_seconds"),
        F.round(F.coalesce(F.percentile(seconds, 0.5), F.lit(0.0)), 3).alias("median_run_seconds"),
    ).first().asDict()
    counts, rows = F.col("check_type") == "RowCountReconciliation", F.abs(F.coalesce("variance", F.lit(0.0)))
    log = table("validation_log").agg(
        F.count("*").alias("checks_executed"), _count(status == "PASS").alias("checks_passed"), _count(status == "FAIL").alias("checks_failed"),
        _count((status == "FAIL") & (F.col("severity") == "Critical")).alias("critical_checks_failed"), _count(counts).alias("reconciliation_checks"),
        _count(counts & (status == "PASS")).alias("reconciliation_passed"), total(F.when(counts, rows)).cast("long").alias("row_count_variance_total"),
    ).first().asDict()
    alerts = AlertLog(store).rows().agg(F.count("*").alias("alerts_raised"), _count(F.col("delivered")).alias("alerts_delivered")).first().asDict()
    out = Metrics(now, **runs, **log, **alerts)
    out.autonomous_run_rate_pct = percent(out.total_runs - out.runs_requiring_manual_intervention, out.total_runs)
    out.row_load_rate_pct = percent(out.rows_loaded, out.rows_extracted)
    out.check_pass_rate_pct = percent(out.checks_passed, out.checks_executed)
    out.reconciliation_pass_rate_pct = percent(out.reconciliation_passed, out.reconciliation_checks)
    out.warehouse_orders, out.warehouse_order_lines = table(HEADER.name).count(), table(DETAIL.name).count()
    failed = table("validation_log").where("status = 'FAIL'").groupBy("check_name", "check_type", "severity").agg(F.count("*").alias("occurrences"))
    # The lists have a row for each check, rule or run, as the control tables have.
    out.failed_check_breakdown = [r.asDict() for r in failed.orderBy(F.desc("occurrences"), "check_name").collect()]
    held = table("rejected_row").groupBy("entity_name", "rejection_reason").agg(F.count("*").alias("rows_quarantined"))
    out.quarantine_breakdown = [r.asDict() for r in held.orderBy(F.desc("rows_quarantined"), "rejection_reason", "entity_name").collect()]
    out.runs = [r.asDict() for r in ended.orderBy("run_id").collect()]
    return out


def as_json(m: Metrics) -> str:
    return json.dumps(asdict(m), indent=2, default=str)


_SECTIONS = (
    ("Runs", "total_runs scheduled_runs manual_runs backfill_runs succeeded completed_with_warnings failed runs_requiring_manual_intervention autonomous_run_rate_pct"),
    ("Rows", "rows_extracted rows_loaded rows_quarantined row_load_rate_pct warehouse_orders warehouse_order_lines"),
    ("Checks", "checks_executed checks_passed checks_failed critical_checks_failed check_pass_rate_pct"),
    ("Reconciliation", "reconciliation_checks reconciliation_passed reconciliation_pass_rate_pct row_count_variance_total"),
    ("Alerts", "alerts_raised alerts_delivered"),
    ("Run time", "median_run_seconds slowest_run_seconds total_runtime_seconds"),
)
_LISTS = (
    ("Failed checks", "failed_check_breakdown", "check_name check_type severity occurrences"),
    ("Quarantined rows", "quarantine_breakdown", "entity_name rejection_reason rows_quarantined"),
    ("Run log", "runs", "run_id run_trigger load_type status rows_extracted rows_loaded rows_rejected checks_run checks_failed duration_seconds"),
)


def _label(name: str) -> str:
    text = name.removesuffix("_pct").replace("_", " ")
    return text[0].upper() + text[1:] + (" (%)" if name.endswith("_pct") else "")


def _shown(value: object) -> str:
    if isinstance(value, float):
        return f"{value:,.3f}"
    return f"{value:,}" if isinstance(value, int) and not isinstance(value, bool) else "" if value is None else str(value).replace("|", "\\|")


def _table(head: list[str], rows: list[list[object]]) -> list[str]:
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return [line(head), line(["---"] * len(head)), *[line([_shown(x) for x in r]) for r in rows], ""]


def as_markdown(m: Metrics) -> str:
    """A table for each group of figures, and one for each list that has rows."""
    out, values = ["# Run history in figures", "", f"As of {m.generated_at_utc} (UTC).", ""], asdict(m)
    for title, names in _SECTIONS:
        out += [f"## {title}", "", *_table(["Figure", "Value"], [[_label(n), values[n]] for n in names.split()])]
    for title, name, columns in _LISTS:
        if values[name]:
            out += [f"## {title}", "", *_table([_label(c) for c in columns.split()], [[r[c] for c in columns.split()] for r in values[name]])]
    return "\n".join(out)


def write(m: Metrics, folder: str) -> list[str]:
    os.makedirs(folder, exist_ok=True)
    paths = []
    for name, text in (("metrics.md", as_markdown(m)), ("metrics.json", as_json(m))):
        paths.append(os.path.join(folder, name))
        with open(paths[-1], "w", encoding="utf-8") as out:
            out.write(text)
    return paths
