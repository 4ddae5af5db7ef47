"""Alerts: recorded in the store first, then posted as JSON or written as a file, then marked; none of it ever raises."""

from __future__ import annotations

import json
import os
import urllib.request
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.sources.entities import schema_of
from tidegate.sources.store import Store

PIPELINE = "LoadSalesData"


@dataclass
class Alert:
    alert_id: int
    run_id: int
    alert_type: str
    severity: str
    subject: str
    details: dict = field(default_factory=dict)
    delivered: bool = False
    delivery_detail: str = ""

    def payload(self, raised_at: str) -> str:
        body = {"alertType": self.alert_type, "severity": self.severity, "subject": self.subject, "runId": self.run_id, "pipeline": PIPELINE, "raisedAtUtc": raised_at, "details": self.details}
        return json.dumps(body, default=str)


def deliver(alert: Alert, raised_at: str, webhook: str | None = None, folder: str | None = None) -> Alert:
    """Mark the alert with what became of it; the detail is cut to 1000 characters."""
    try:
        if webhook:
            request = urllib.request.Request(webhook, alert.payload(raised_at).encode(), {"Content-Type": "application/json"})
            with urllib.request.urlopen(request, timeout=15) as answer:
                alert.delivered, alert.delivery_detail = 200 <= answer.status < 300, f"HTTP {answer.status}"
        elif folder:
            os.makedirs(folder, exist_ok=True)
            path = os.path.join(folder, f"alert-{alert.alert_id}.json")
            with open(path, "w") as out:
                out.write(alert.payload(raised_at))
            alert.delivered, alert.delivery_detail = True, path
        else:
            alert.delivery_detail = "no channel"
    except Exception as error:  # an alert must never end a run
        alert.delivered, alert.delivery_detail = False, str(error)[:1000]
    return alert


ALERTS = schema_of(
    "alert_id long, run_id long, alert_type string, severity string, subject string, body string, channel string, raised_at string, delivered boolean, delivery_detail string, state int"
)


class AlertLog:
    """The alert table of a store. Raising and marking each append a row; of an alert the last state counts."""

    def __init__(self, store: Store):
        self.store = store

    def rows(self) -> DataFrame:
        last = Window.partitionBy("alert_id").orderBy(F.desc("state"))
        return self.store.table("alert", ALERTS).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")

    def _append(self, *row) -> None:
        made = self.store.spark.createDataFrame([row], ALERTS)
        self.store.commit({}, self.store.manifest()["number"], {"alert": made})

    def raise_(self, run_id: int, kind: str, severity: str, subject: str, details: dict, raised_at: str, channel: str) -> Alert:
        before = self.store.table("alert", ALERTS).agg(F.max("alert_id")).first()[0]
        alert = Alert((before or 0) + 1, run_id, kind, severity, subject, details)
        self._append(alert.alert_id, run_id, kind, severity, subject, alert.payload(raised_at), channel, raised_at, False, None, 0)
        return alert

    def mark(self, run_id: int, delivered: bool, detail: str = "", alert_id: int | None = None) -> int:
        """Of the named alert, or the latest of the run; its id."""
        mine = self.rows().where(F.col("run_id") == run_id)
        if alert_id is not None:
            mine = mine.where(F.col("alert_id") == alert_id)
        found = mine.orderBy(F.desc("alert_id")).first()
        if found is None:
            raise ValueError(f"run {run_id} has no alert to mark")
        values = found.asDict() | {"delivered": delivered, "delivery_detail": detail[:1000], "state": found["state"] + 1}
        self._append(*[values[c] for c in ALERTS.names])
        return found["alert_id"]


def dispatch(log: AlertLog, run_id: int, kind: str, severity: str, subject: str, details: dict, raised_at: str, webhook: str | None = None, folder: str | None = None) -> Alert:
    """Record, deliver, mark. A record that fails does not keep the alert from going out, nor ends the run."""
    recorded = True
    try:
        alert = log.raise_(run_id, kind, severity, subject, details, raised_at, "Webhook" if webhook else "File")
    except Exception:
        alert, recorded = Alert(0, run_id, kind, severity, subject, details), False
    deliver(alert, raised_at, webhook, folder)
    if recorded:
        try:
            log.mark(run_id, alert.delivered, alert.delivery_detail, alert.alert_id)
        except Exception as error:
            alert.delivery_detail = f"{alert.delivery_detail}; not marked: {error}"[:1000]
    return alert
