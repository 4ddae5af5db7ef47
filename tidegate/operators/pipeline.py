"""One validated incremental run: extract a window, quarantine, upsert, check, and only then move the bookmarks.

A run opens with a row of status Running. Commit A holds the warehouse buckets that the window touches and the rejected
rows (a failed run keeps its good rows); commit B holds the validation log, the run's status and, unless a critical
check failed, both bookmarks. A run that dies between them reads the same window again, and the upsert is idempotent.
Clock and window end are parameters. Logs grow by a folder a run, nothing of the past is rewritten.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import alerts, checks, load, rules
from tidegate.operators.constraints import Constraints
from tidegate.sources.entities import DETAIL, ENTITIES, HEADER, Entity, schema_of, stamp
from tidegate.sources.store import BUCKET, Store, bucket_of

CONFIG = {"rowcount.tolerance_rows": "0", "financial.tolerance_amount": "0.01", "freshness.max_lag_hours": "24", "initial.watermark": "1900-01-01 00:00:00"}
FALLBACK = CONFIG | {"freshness.max_lag_hours": "48"}
LOAD_TYPES, TRIGGERS = ("Incremental", "Full"), ("Scheduled", "Manual", "Backfill")
LINEAGE = [T.StructField("etl_run_id", T.LongType()), T.StructField("etl_inserted_at", T.TimestampNTZType()), T.StructField("etl_updated_at", T.TimestampNTZType())]
REJECTED = "run_id long, entity_name string, business_key string, rejection_reason string, rejection_detail string, row_payload string"
LOG = "run_id long, check_name string, check_type string, entity_name string, column_name string, expected_value string, actual_value string, variance double, status string, severity string, message string"
RUNS = (
    "run_id long, state int, run_trigger string, load_type string, start_time string, duration_seconds double, watermark_from string, watermark_to string, status string, rows_extracted long, "
    "rows_loaded long, rows_rejected long, checks_run long, checks_passed long, checks_failed long, critical_failed long, required_manual_intervention boolean, error_message string"
)
MARKS = "entity_name string, watermark_value string, last_run_id long"
ENTITY_LOG = "run_id long, entity_name string, source_rows long, rows_extracted long, rows_loaded long, rows_rejected long"
SCHEMAS = {name: schema_of(text) for name, text in (("rejected_row", REJECTED), ("validation_log", LOG), ("run_log", RUNS), ("watermark", MARKS), ("run_entity", ENTITY_LOG))}
SCHEMAS["alert"] = alerts.ALERTS
SCHEMAS |= {e.name: T.StructType(e.schema.fields + LINEAGE) for e in ENTITIES}


def setting(config: dict[str, str], key: str, kind=float):
    """A tuned value, or the fallback if it can't be read."""
    try:
        return kind(config.get(key, CONFIG[key]))
    except ValueError:
        return kind(FALLBACK[key])


def run_log(store: Store) -> DataFrame:
    """A row for each run: its last state."""
    last = Window.partitionBy("run_id").orderBy(F.desc("state"))
    return store.table("run_log", SCHEMAS["run_log"]).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "state")


@dataclass
class Outcome:
    run_id: int
    status: str
    trigger: str = "Manual"
    load_type: str = "Incremental"
    window: tuple[str, str] = ("", "")
    source: dict[str, int] = field(default_factory=dict)
    extracted: dict[str, int] = field(default_factory=dict)
    loaded: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)
    checks_run: int = 0
    failed_checks: list[str] = field(default_factory=list)
    critical: int = 0
    error: str | None = None
    seconds: float = 0.0
    alert: alerts.Alert | None = None

    @property
    def exit_code(self) -> int:
        return 1 if self.status == "Failed" else 0

    def summary(self) -> str:
        """The run in a few lines of text."""
        out = [f"Run {self.run_id}, {self.trigger}, {self.load_type}: {self.status} after {self.seconds:.2f} s", f"window {self.window[0]} to {self.window[1]}"]
        for name in self.extracted:
            out.append(f"{name}: source {self.source[name]:,}, staged {self.extracted[name]:,}, loaded {self.loaded[name]:,}, rejected {self.rejected[name]:,}")
        out.append(f"checks: {self.checks_run}, failed {len(self.failed_checks)}, critical {self.critical}")
        out += [f"failed: {', '.join(self.failed_checks)}"] * bool(self.failed_checks) + [f"error: {self.error}"] * bool(self.error)
        if self.alert:
            out.append(f"alert {self.alert.alert_id}: {'delivered' if self.alert.delivered else 'not delivered'} ({self.alert.delivery_detail})")
        return "\n".join(out)


class Pipeline:
    """``source``: entity name to DataFrame, read anew for every use so that expected counts are independent.

    ``buckets``: parts of each warehouse table; a run reads and rewrites those that its window touches. It is fixed for a
    store (a part should hold some 100 MB).
    """

    def __init__(
        self, spark: SparkSession, store: Store, source, config: dict[str, str] | None = None, rule_set=rules.RULES, alert_folder: str | None = None, webhook: str | None = None, buckets: int = 32,
        constraints: Constraints | None = None, keep: int = 3,
    ):
        self.spark, self.store, self.source = spark, store, source
        self.config, self.rules, self.constraints = CONFIG | (config or {}), rule_set, constraints or Constraints()
        self.alert_folder, self.webhook, self.buckets, self.keep = alert_folder, webhook, buckets, keep
        self.alerts = alerts.AlertLog(store)

    def _rows(self, name: str) -> list:
        return self.store.table(name, SCHEMAS[name]).collect()  # control tables: a few rows a run

    def warehouse(self, entity: Entity, buckets: list[int] | None = None) -> DataFrame:
        return self.store.table(entity.name, SCHEMAS[entity.name], buckets)

    def window(self, load_type: str, now: str) -> tuple[str, str]:
        marks = {r["entity_name"]: r["watermark_value"] for r in self._rows("watermark")}
        start = self.config["initial.watermark"]
        if load_type == "Incremental" and all(e.name in marks for e in ENTITIES):
            start = min(marks.values())
        return start, now

    def run(self, now: str, load_type: str = "Incremental", asked: str | None = None, trigger: str = "Manual") -> Outcome:
        if load_type not in LOAD_TYPES:
            raise ValueError(f"load type {load_type!r} is none of {LOAD_TYPES}")
        if trigger not in TRIGGERS:
            raise ValueError(f"trigger {trigger!r} is none of {TRIGGERS}")
        began = time.monotonic()
        last = self.store.table("run_log", SCHEMAS["run_log"]).agg(F.max("run_id")).first()[0]
        outcome = Outcome((last or 0) + 1, "Running", trigger, load_type, self.window(load_type, now))
        self._append("run_log", [self._run_row(outcome, now, 0)])
        log: list[tuple] = []
        try:
            self._load_and_check(outcome, log, now)
            failed = [x for x in log if x[8] == "FAIL"]
            outcome.critical = sum(x[9] == "Critical" for x in failed)
            outcome.failed_checks = [x[1] for x in sorted(failed, key=lambda x: (x[9] != "Critical", x[1]))]
            outcome.status = "Failed" if outcome.critical or asked == "Failed" else "CompletedWithWarnings" if failed else "Succeeded"
        except Exception as problem:  # a run always ends with a status
            outcome.status, outcome.error = "Failed", str(problem)[:4000]
        outcome.checks_run = len(log)
        if outcome.status == "Failed":
            kind = "PipelineError" if outcome.error else "ValidationFailure"
            details = {"failedChecks": outcome.failed_checks, "error": outcome.error}
            outcome.alert = alerts.dispatch(self.alerts, outcome.run_id, kind, "Critical", f"Run {outcome.run_id} failed", details, now, self.webhook, self.alert_folder)
        outcome.seconds = time.monotonic() - began
        self._close(outcome, log, now)
        self.store.vacuum(self.keep)
        return outcome

    def _load_and_check(self, outcome: Outcome, log: list[tuple], now: str) -> None:
        number = self.store.manifest()["number"]
        start, stop = (stamp(x) for x in outcome.window)
        tables, held, parents, entity_rows, rejected = {}, [], None, [], None
        try:
            for entity in ENTITIES:
                inside = (F.col(entity.watermark) >= start) & (F.col(entity.watermark) < stop)
                source_rows = self.source(entity.name).where(inside).count()
                staged = entity.extract(self.source(entity.name), start, stop).withColumn("etl_run_id", F.lit(outcome.run_id).cast("long")).persist()
                batch = rules.evaluate(staged, entity, now, self.rules).persist()
                held += [staged, batch]
                counts = batch.agg(F.count("*").alias("n"), F.count("first_rule").alias("bad"), *rules.tallies(entity, self.rules)).first()
                for rule in rules.rules_of(entity, self.rules):
                    n = counts[f"n_{rule.number}"]
                    log.append((outcome.run_id, rule.name, rule.kind, entity.name, rule.column, "0", str(n), float(n), "FAIL" if n else "PASS", rule.severity, rules.message(rule, n)))
                bad = rules.rejected_in_detail(batch, entity, [*entity.columns, "etl_run_id"], self.rules).withColumn("run_id", F.lit(outcome.run_id).cast("long"))
                rejected = bad if rejected is None else rejected.unionByName(bad)
                good = entity.latest_rows(rules.survivors(batch))
                if entity is DETAIL:
                    good = load.with_parent(good, parents)
                good = good.withColumn(BUCKET, bucket_of(entity.key, self.buckets)).persist()
                held.append(good)
                touched = sorted(r[0] for r in good.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
                old = self.warehouse(entity, touched)
                incoming = good.withColumn("etl_inserted_at", stamp(now)).withColumn("etl_updated_at", stamp(now)).select(old.columns)
                done = load.upsert(old, incoming, entity, ("etl_inserted_at",)).persist()
                held.append(done)
                asked = self.constraints.tallies(entity)
                n = done.agg(*load.tallies(), *asked.values()).first()
                outcome.source[entity.name] = source_rows
                outcome.extracted[entity.name], outcome.rejected[entity.name], outcome.loaded[entity.name] = counts["n"], counts["bad"], n["rows_loaded"]
                entity_rows.append((outcome.run_id, entity.name, source_rows, counts["n"], n["rows_loaded"], counts["bad"]))
                rest = [b for b in range(self.buckets) if b not in touched]
                if entity is HEADER:
                    parents = done.select(entity.key).union(self.warehouse(entity, rest).select(entity.key))
                self.constraints.require({c: n[c] for c in asked}, done, entity, parents if entity is DETAIL else None)
                tables[entity.name] = done.drop("_action").select(old.columns).withColumn(BUCKET, bucket_of(entity.key, self.buckets))
            log_rows = self.spark.createDataFrame(entity_rows, SCHEMAS["run_entity"])
            self.store.commit({}, number, {"rejected_row": rejected.select(SCHEMAS["rejected_row"].names), "run_entity": log_rows}, tables)
        finally:
            for df in held:
                df.unpersist()
        self._post_load(outcome, log, entity_rows)

    def _post_load(self, outcome: Outcome, log: list[tuple], entity_rows: list[tuple]) -> None:
        def add(name, kind, entity, expected, actual, variance, good, severity="Critical"):
            status = good if isinstance(good, str) else "PASS" if good else "FAIL"
            said = None if status == "PASS" else f"expected {expected}, found {actual}"
            log.append((outcome.run_id, name, kind, entity, None, str(expected), str(actual), None if variance is None else float(variance), status, severity, said))

        for _, name, source, extracted, loaded, bad in entity_rows:
            add("RECON_SourceToStaging", "RowCountReconciliation", name, source, extracted, extracted - source, abs(source - extracted) <= setting(self.config, "rowcount.tolerance_rows", int))
            add("RECON_StagingToWarehouse", "RowCountReconciliation", name, extracted, loaded + bad, loaded + bad - extracted, loaded + bad == extracted)
        headers, lines = self.warehouse(HEADER), self.warehouse(DETAIL)
        tolerance = str(setting(self.config, "financial.tolerance_amount"))
        after = {
            "ORPHAN_DetailWithoutHeader": ("ReferentialCheck", checks.orphans(lines, headers), "Critical"),
            "ORPHAN_HeaderWithoutDetail": ("ReferentialCheck", checks.without_lines(headers, lines), "Warning"),
            "RECON_HeaderSubTotalVsLines": ("FinancialReconciliation", checks.subtotal_mismatches(headers, lines, tolerance), "Critical"),
            "DUP_WarehouseOrderID": ("DuplicateCheck", checks.duplicate_groups(headers, "SalesOrderID"), "Critical"),
            "TYPE_WarehouseDetailDomains": ("TypeCheck", checks.outside_domain(lines), "Critical"),
        }
        pairs = ((HEADER, headers), (DETAIL, lines))
        # All counts and high waters in one job: scans and shuffles that are the same are made once.
        none = F.lit(None).cast("timestamp_ntz")
        asked = [found.agg(F.count("*").alias("n"), none.alias("l")).select(F.lit(name).alias("name"), "n", "l") for name, (_, found, _) in after.items()]
        for side, rows in (("dw", dict((e.name, r) for e, r in pairs)), ("source", {e.name: self.source(e.name) for e, _ in pairs})):
            asked += [rows[e.name].agg(F.lit(0).cast("long").alias("n"), F.max(e.watermark).alias("l")).select(F.lit(f"{side} {e.name}").alias("name"), "n", "l") for e, _ in pairs]
        got = {r["name"]: r for r in reduce(DataFrame.unionByName, asked).collect()}
        for name, (kind, _, severity) in after.items():
            n = got[name]["n"]
            add(name, kind, "warehouse", 0, n, n, n == 0, severity)
        most = setting(self.config, "freshness.max_lag_hours")
        for entity, _ in pairs:
            loaded, there = got[f"dw {entity.name}"]["l"], got[f"source {entity.name}"]["l"]
            if there is not None:
                lag = None if loaded is None else max(0.0, (there.replace(second=0, microsecond=0) - loaded.replace(second=0, microsecond=0)).total_seconds() / 3600)
                add("FRESH_PipelineLag", "FreshnessCheck", entity.name, most, lag, lag, "WARN" if lag is None else "PASS" if lag <= most else "FAIL", "Warning")

    def _run_row(self, outcome: Outcome, now: str, state: int, passed: int = 0) -> tuple:
        total = lambda d: sum(d.values())
        failed = outcome.status == "Failed"
        return (
            outcome.run_id, state, outcome.trigger, outcome.load_type, now, outcome.seconds if state else None, *outcome.window, outcome.status, total(outcome.extracted), total(outcome.loaded),
            total(outcome.rejected), outcome.checks_run, passed, len(outcome.failed_checks), outcome.critical, failed, outcome.error,
        )

    def _append(self, name: str, rows: list[tuple]) -> None:
        self.store.commit({}, self.store.manifest()["number"], {name: self.spark.createDataFrame(rows, SCHEMAS[name])})

    def _close(self, outcome: Outcome, log: list[tuple], now: str) -> None:
        made = self.spark.createDataFrame
        passed = sum(x[8] == "PASS" for x in log)
        appended = {"run_log": made([self._run_row(outcome, now, 1, passed)], SCHEMAS["run_log"]), "validation_log": made(log, SCHEMAS["validation_log"])}
        tables = {}
        if outcome.status != "Failed":
            marks = {r["entity_name"]: (r["watermark_value"], r["last_run_id"]) for r in self._rows("watermark")}
            for e in ENTITIES:
                before = marks.get(e.name, ("", 0))[0]
                marks[e.name] = (max(before, outcome.window[1]), outcome.run_id)  # never backwards
            tables["watermark"] = made([(k, *v) for k, v in sorted(marks.items())], SCHEMAS["watermark"]).coalesce(1)
        self.store.commit(tables, self.store.manifest()["number"], appended)
