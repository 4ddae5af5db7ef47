"""Command line: ``python -m tidegate.cli COMMAND``. Settings come from TIDEGATE_* variables (see ``tidegate.settings``).

run      one run; exit 0 (loaded, perhaps with warnings), 1 (failed) or 2 (bad call or settings)
report   the run history in figures, as Markdown or JSON; 1 if no run has ended
verify   whether the store's tables and the rules are in place; 1 if not
mark     an alert as delivered
reset    drop the store
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from tidegate.operators import metrics, rules
from tidegate.operators.alerts import AlertLog
from tidegate.operators.pipeline import LOAD_TYPES, SCHEMAS, TRIGGERS, Pipeline
from tidegate.settings import BadSettings, Settings
from tidegate.sources.connectors import Source, jdbc_source, parquet_source
from tidegate.sources.store import Store


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tidegate", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = out.add_subparsers(dest="command", required=True)
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    run = commands.add_parser("run")
    run.add_argument("--load-type", choices=LOAD_TYPES, default="Incremental")
    run.add_argument("--trigger", choices=TRIGGERS, default="Manual")
    report = commands.add_parser("report")
    report.add_argument("--json", action="store_true")
    report.add_argument("--write", action="store_true", help="also write both forms to the report folder")
    mark = commands.add_parser("mark")
    mark.add_argument("run_id", type=int)
    mark.add_argument("--alert-id", type=int)
    for each in (run, report, mark):
        each.add_argument("--now", default=now, help="the clock, UTC; the end of the window")
    commands.add_parser("verify")
    commands.add_parser("reset").add_argument("--yes", action="store_true", required=True)
    return out


def source(spark: SparkSession, settings: Settings) -> Source:
    if settings.source.startswith("jdbc:"):
        return jdbc_source(spark, settings.source, settings.user, settings.password, settings.driver, settings.partitions)
    return parquet_source(spark, settings.source)


def verify(store: Store) -> list[str]:
    """What is missing: tables that every run writes, and columns of theirs; seeded rules that are gone."""
    held = store.manifest()["tables"]
    wrong = [f"no table {name}" for name in SCHEMAS if name not in held and name not in ("alert", "watermark")]
    for name, paths in held.items():
        some = next(iter(paths.values() if isinstance(paths, dict) else paths), None)
        missing = set(SCHEMAS[name].names) - set(store.spark.read.parquet(some).columns) if some and name in SCHEMAS else ()
        wrong += [f"{name} has no column {c}" for c in sorted(missing)]
    return wrong + ["fewer than 25 rules"] * (len(rules.RULES) < 25)


def main(args: list[str], spark: SparkSession | None = None) -> int:
    try:
        asked = parser().parse_args(args)
        settings = Settings.read()
    except SystemExit as done:
        return int(done.code or 0)
    except BadSettings as problem:
        print(problem, file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    store = Store(spark, settings.store)
    if asked.command == "run":
        outcome = Pipeline(spark, store, source(spark, settings), settings.config, alert_folder=settings.alert_folder, webhook=settings.webhook or None, buckets=settings.buckets).run(asked.now, asked.load_type, trigger=asked.trigger)
        print(outcome.summary())
        return outcome.exit_code
    if asked.command == "report":
        found = metrics.collect(store, asked.now)
        if not found.total_runs:
            print("no run has ended yet", file=sys.stderr)
            return 1
        print(metrics.as_json(found) if asked.json else metrics.as_markdown(found))
        if asked.write:
            print("\n".join(f"wrote {p}" for p in metrics.write(found, settings.report_folder)), file=sys.stderr)
        return 0
    if asked.command == "mark":
        try:
            print(AlertLog(store).mark(asked.run_id, True, f"marked at {asked.now}", asked.alert_id))
        except ValueError as problem:
            print(problem, file=sys.stderr)
            return 1
        return 0
    if asked.command == "reset":
        store.reset()
        return 0
    wrong = verify(store)
    print("\n".join(wrong) or "in place")
    return int(bool(wrong))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
