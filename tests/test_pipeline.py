"""Rules against a row-by-row loop, run life cycle, bookmarks, reconciliation, alerts, report, command line, store."""

import datetime as dt
import json
import random
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidegate import cli
from tidegate.operators import alerts, checks, constraints, experiment, harness, metrics, rules
from tidegate.operators.pipeline import SCHEMAS, Pipeline, run_log, setting
from tidegate.settings import BadSettings, Settings
from tidegate.sources import connectors
from tidegate.sources.entities import DETAIL, HEADER
from tidegate.sources.store import BUCKET, Conflict, Store, bucket_of
from tidegate.streaming import incremental

DAY = dt.datetime(2031, 3, 17, 9, 30)
H = dict.fromkeys(HEADER.columns) | {
    "SalesOrderID": 71, "RevisionNumber": 4, "OrderDate": DAY, "DueDate": DAY + dt.timedelta(16), "ShipDate": DAY + dt.timedelta(3), "Status": 2, "OnlineOrderFlag": False, "SalesOrderNumber": "N-71", "CustomerID": 3301,
    "BillToAddressID": 12, "ShipToAddressID": 13, "ShipMethodID": 1, "SubTotal": D("61.2500"), "TaxAmt": D("4.75"), "Freight": D("9.125"), "TotalDue": D("75.125"), "ModifiedDate": DAY,
}
L = dict.fromkeys(DETAIL.columns) | {"SalesOrderID": 71, "SalesOrderDetailID": 505, "OrderQty": 7, "ProductID": 44, "SpecialOfferID": 2, "UnitPrice": D("12.5"), "UnitPriceDiscount": D("0.3"), "LineTotal": D("61.25"), "ModifiedDate": DAY}
NOW = "2031-06-30 00:00:00"
OF = {HEADER.name: (HEADER, H), DETAIL.name: (DETAIL, L)}


def frame(spark, entity, *rows):
    return spark.createDataFrame([tuple(r[c] for c in entity.columns) for r in rows], entity.schema)


def failed(spark, entity, *rows, rule_set=rules.RULES):
    batch = rules.evaluate(frame(spark, entity, *rows), entity, NOW, rule_set)
    return {r["check_name"]: r["bad_rows"] for r in rules.results(batch, entity, rule_set).collect() if r["bad_rows"]}, rules.survivors(batch).count()


#: Each column that a null rule names, cleared in turn.
NULL_CASES = [(r.entity, {c: None}, r.name) for r in rules.RULES if r.kind == "NullCheck" for c in re.findall(r"`(\w+)` IS NULL", r.predicate)]
EARLY = DAY - dt.timedelta(40)
OTHER_CASES = [
    (HEADER.name, {"TaxAmt": D("-0.0001")}, "NEG_Amounts"), (HEADER.name, {"TotalDue": D(-7)}, "NEG_Amounts"), (HEADER.name, {"DueDate": EARLY}, "DATE_DueBeforeOrder"), (HEADER.name, {"ShipDate": EARLY}, "DATE_ShipBeforeOrder"),
    (DETAIL.name, {"OrderQty": 0}, "QTY_NonPositive"), (DETAIL.name, {"UnitPrice": D("-0.5")}, "PRICE_Negative"), (DETAIL.name, {"UnitPriceDiscount": D("1.0001")}, "DISCOUNT_OutOfRange"), (DETAIL.name, {"UnitPriceDiscount": D(-1)}, "DISCOUNT_OutOfRange"),
]


@pytest.mark.parametrize("name", [HEADER.name, DETAIL.name])
def test_bad_rows_are_quarantined_once(spark, name):
    """All cases of an entity in one batch, each row under a key of its own."""
    entity, good = OF[name]
    cases = [c for c in NULL_CASES + OTHER_CASES if c[0] == name]
    rows = [good | {entity.key: 9000 + k} | change for k, (_, change, _) in enumerate(cases)]
    batch = rules.evaluate(frame(spark, entity, *rows, good), entity, NOW)
    taken = {r["business_key"]: r["rejection_reason"] for r in rules.rejected(batch, entity, list(entity.columns)).collect()}
    assert taken == {f"{entity.key}={'' if c == {entity.key: None} else 9000 + k}": n for k, (_, c, n) in enumerate(cases)}
    assert rules.survivors(batch).count() == 1 and len(cases) >= 11


def test_warnings_stay(spark):
    assert failed(spark, DETAIL, L | {"LineTotal": D("61.2601")}) == ({"LINETOTAL_Mismatch": 1}, 1)
    assert failed(spark, DETAIL, L | {"LineTotal": D("61.26")}) == ({}, 1)
    assert failed(spark, HEADER, H, H | {"RevisionNumber": 5}) == ({"DUP_SalesOrderID": 2}, 2)
    assert failed(spark, HEADER, H | {c: dt.datetime(2031, 7, 2) for c in ("OrderDate", "DueDate", "ShipDate")}) == ({"DATE_OrderInFuture": 1}, 1)
    assert failed(spark, HEADER) == ({}, 0)


def test_engine_equals_a_loop_over_rules(spark):
    """Row-local, duplicate and subquery rules, quarantining or not, against counting and deleting rule by rule."""
    rnd = random.Random(5)
    rows = [L | {"SalesOrderDetailID": rnd.choice([None, *range(30)]), "OrderQty": rnd.choice([None, -1, 0, 1, 2]), "ProductID": rnd.choice([None, 1, 2]), "UnitPrice": D(rnd.randint(-2, 9))} for _ in range(120)]
    tests = {
        "OrderQty <= 0": lambda r, b: r["OrderQty"] is not None and r["OrderQty"] <= 0, "ProductID IS NULL": lambda r, b: r["ProductID"] is None, "UnitPrice < 0 OR OrderQty > 1": lambda r, b: r["UnitPrice"] < 0 or (r["OrderQty"] or 0) > 1,
        "UnitPrice = (SELECT max(UnitPrice) FROM batch)": lambda r, b: r["UnitPrice"] == max(x["UnitPrice"] for x in b),
        "EXISTS (SELECT 1 FROM batch AS o WHERE o.ProductID = s.ProductID AND o.OrderQty = 2)": lambda r, b: r["ProductID"] is not None and any(x["ProductID"] == r["ProductID"] and x["OrderQty"] == 2 for x in b),
        "": lambda r, b: r["SalesOrderDetailID"] is not None and sum(x["SalesOrderDetailID"] == r["SalesOrderDetailID"] for x in b) > 1,
    }
    for _ in range(4):
        chosen = rnd.sample(sorted(tests), 5)
        mine = tuple(rules.Rule(k, DETAIL.name, f"R{k}", "DuplicateCheck" if not p else "DomainCheck", "SalesOrderDetailID" if not p else "OrderQty", p, rnd.random() < 0.6) for k, p in enumerate(chosen, 1))
        left, expected = rows, {}
        for r in mine:
            bad = [x for x in left if tests[r.predicate](x, left)]
            if bad:
                expected[r.name] = len(bad)
            if r.quarantine:
                left = [x for x in left if not any(x is y for y in bad)]
        assert failed(spark, DETAIL, *rows, rule_set=mine) == (expected, len(left))


def test_rules_are_switched_and_seeded_again(spark):
    off = rules.toggled(rules.RULES, "QTY_NonPositive", False)
    assert failed(spark, DETAIL, L | {"OrderQty": -2, "LineTotal": D("-17.5")}, rule_set=off) == ({}, 1)
    own = rules.Rule(99, DETAIL.name, "OWN", "DomainCheck", "OrderQty", "OrderQty > 5")
    again = {(r.entity, r.name): r.enabled for r in rules.seeded((*off, own))}
    assert not again[DETAIL.name, "QTY_NonPositive"] and again[DETAIL.name, "OWN"] and len(again) == 26
    assert rules.message(own, 0) is None and "quarantined" in rules.message(own, 2)


def test_latest_revision_wins(spark):
    two = frame(spark, HEADER, H, H | {"RevisionNumber": 5}, H | {"RevisionNumber": 1, "ModifiedDate": DAY - dt.timedelta(1)})
    assert [r["RevisionNumber"] for r in HEADER.latest_rows(two).collect()] == [5]


@pytest.fixture
def made(spark, tmp_path):
    data = {HEADER.name: [H], DETAIL.name: [L]}
    store = Store(spark, f"file://{tmp_path}/store")
    return data, store, Pipeline(spark, store, lambda n: frame(spark, OF[n][0], *data[n]), alert_folder=str(tmp_path / "alerts"), buckets=4)


def marks(store):
    return {r["entity_name"]: r["watermark_value"] for r in store.table("watermark", SCHEMAS["watermark"]).collect()}


def test_fault_holds_the_bookmark_and_recovery_loads(spark, made, tmp_path):
    data, store, pipeline = made
    first = pipeline.run("2031-03-18 00:00:00", "Full", trigger="Backfill")
    assert (first.status, first.loaded) == ("Succeeded", {HEADER.name: 1, DETAIL.name: 1})
    assert set(marks(store).values()) == {"2031-03-18 00:00:00"}
    before = store.manifest()["tables"][DETAIL.name]
    at_end = dt.datetime(2031, 3, 19)
    data[HEADER.name].append(H | {"SalesOrderID": 72, "ModifiedDate": dt.datetime(2031, 3, 18), "DueDate": EARLY})
    data[HEADER.name].append(H | {"SalesOrderID": 73, "ModifiedDate": at_end})
    data[DETAIL.name].append(L | {"SalesOrderID": 72, "SalesOrderDetailID": 506, "ModifiedDate": dt.datetime(2031, 3, 18)})
    bad = pipeline.run("2031-03-19 00:00:00", trigger="Scheduled")
    assert bad.status == "Failed" and bad.extracted[HEADER.name] == 1  # the row at the window's end waits
    assert bad.rejected[HEADER.name] == 1 and "DATE_DueBeforeOrder" in bad.failed_checks and bad.alert.delivered
    assert set(marks(store).values()) == {"2031-03-18 00:00:00"}
    assert pipeline.warehouse(HEADER).count() == 1 and store.manifest()["tables"][DETAIL.name] == before  # no bucket touched, none rewritten
    data[HEADER.name][1]["DueDate"] = DAY + dt.timedelta(7)
    data[DETAIL.name].append(L | {"SalesOrderID": 73, "SalesOrderDetailID": 507, "ModifiedDate": at_end})
    data[DETAIL.name][0] = L | {"ModifiedDate": at_end, "SpecialOfferID": 9}
    good = pipeline.run("2031-03-20 00:00:00")
    assert good.status == "Succeeded" and pipeline.warehouse(DETAIL).count() == 3
    line = pipeline.warehouse(DETAIL).where("SalesOrderDetailID = 505").first()
    assert (line["SpecialOfferID"], line["etl_inserted_at"], line["etl_updated_at"]) == (9, dt.datetime(2031, 3, 18), dt.datetime(2031, 3, 20))
    detail = store.table("rejected_row", SCHEMAS["rejected_row"]).first()
    assert detail["rejection_detail"] == "bad if DueDate < OrderDate" and json.loads(detail["row_payload"])["SalesOrderID"] == 72

    found = metrics.collect(store, NOW)
    assert (found.total_runs, found.scheduled_runs, found.manual_runs, found.backfill_runs, found.succeeded, found.failed) == (3, 1, 1, 1, 2, 1)
    assert (found.alerts_raised, found.alerts_delivered, found.warehouse_orders, found.warehouse_order_lines) == (1, 1, 3, 3)
    assert found.rows_extracted == found.rows_loaded + found.rows_quarantined + 1 and found.rows_quarantined == 1  # one line waited for its header
    assert found.runs_requiring_manual_intervention == 1 and found.autonomous_run_rate_pct == 66.6667 and found.row_count_variance_total == 1
    assert 0 < found.median_run_seconds <= found.slowest_run_seconds <= found.total_runtime_seconds and found.checks_executed == 3 * 36
    assert found.quarantine_breakdown == [{"entity_name": HEADER.name, "rejection_reason": "DATE_DueBeforeOrder", "rows_quarantined": 1}]
    paths = metrics.write(found, str(tmp_path / "reports"))
    text = open(paths[0], encoding="utf-8").read()
    assert "| Rows quarantined | 1 |" in text and "| 2 | Scheduled | Incremental | Failed |" in text and json.load(open(paths[1]))["failed"] == 1
    alert = pipeline.alerts.rows().first()
    assert alert["delivered"] and json.loads(alert["body"])["runId"] == 2 and alert["channel"] == "File"


def test_late_rows_need_a_full_load_and_a_dead_run_is_repeated(spark, made):
    data, store, pipeline = made
    pipeline.run("2031-03-18 00:00:00")
    data[HEADER.name].append(H | {"SalesOrderID": 72, "ModifiedDate": DAY - dt.timedelta(1)})  # stamped below the bookmark
    data[DETAIL.name].append(L | {"SalesOrderID": 72, "SalesOrderDetailID": 506, "ModifiedDate": DAY - dt.timedelta(1)})
    assert pipeline.run("2031-03-19 00:00:00").extracted == {HEADER.name: 0, DETAIL.name: 0}
    close, pipeline._close = pipeline._close, lambda *a: (_ for _ in ()).throw(KeyboardInterrupt)
    with pytest.raises(KeyboardInterrupt):  # after commit A, before commit B
        pipeline.run("2031-03-20 00:00:00", "Full")
    assert run_log(store).where("status = 'Running'").count() == 1 and metrics.collect(store, NOW).total_runs == 2
    pipeline._close = close
    again = pipeline.run("2031-03-20 00:00:00", "Full")
    assert again.run_id == 4 and again.status == "Succeeded" and pipeline.warehouse(DETAIL).count() == pipeline.warehouse(HEADER).count() == 2


def test_duplicates_fail_reconciliation_and_errors_close_the_run(spark, made):
    data, store, pipeline = made
    data[HEADER.name].append(H | {"RevisionNumber": 5})
    assert "RECON_StagingToWarehouse" in pipeline.run("2031-03-18 00:00:00").failed_checks
    pipeline.source = lambda name: 1 / 0
    broken = pipeline.run("2031-03-19 00:00:00")
    assert (broken.status, broken.exit_code, broken.alert.alert_type) == ("Failed", 1, "PipelineError")
    assert marks(store) == {} and [r["status"] for r in run_log(store).orderBy("run_id").collect()] == ["Failed", "Failed"]
    assert "error: division by zero" in broken.summary() and not spark.sparkContext._jsc.getPersistentRDDs()
    with pytest.raises(ValueError):
        pipeline.run("2031-03-19 00:00:00", "incremental")
    with pytest.raises(ValueError):
        pipeline.run("2031-03-19 00:00:00", trigger="Someday")


def test_constraints_guard_what_a_switched_off_rule_lets_through(spark, made):
    data, store, pipeline = made
    data[HEADER.name].append(H | {"SalesOrderID": 72, "DueDate": EARLY})
    pipeline.rules = rules.toggled(rules.RULES, "DATE_DueBeforeOrder", False)
    stopped = pipeline.run("2031-03-18 00:00:00")
    assert "CK_DueDate (1 rows)" in stopped.error and pipeline.warehouse(HEADER).count() == 0
    pipeline.constraints.toggle("CK_DueDate", False)
    assert pipeline.run("2031-03-18 00:00:00").loaded[HEADER.name] == 2
    pipeline.constraints.toggle("CK_DueDate", True)
    with pytest.raises(constraints.Violation):
        pipeline.constraints.validate(pipeline.warehouse(HEADER), HEADER)
    with pytest.raises(constraints.Violation):
        constraints.Constraints().validate(frame(spark, DETAIL, L, L), DETAIL, frame(spark, HEADER))


def test_store_has_one_winner_and_forgets(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.commit({"t": spark.range(3)}, 0)
    with pytest.raises(Conflict):
        store.commit({"t": spark.range(9)}, 0)
    other = Store(spark, f"file://{tmp_path}/s")
    kept = other.manifest
    other.manifest = lambda number=None: {"number": 1, "tables": kept(1)["tables"]}  # it has not seen the next commit
    store.commit({}, 1, {"log": spark.range(1)}, {"b": spark.range(50).withColumn(BUCKET, bucket_of("id", 4))})
    with pytest.raises(Conflict):
        other.commit({"t": spark.range(7)}, 1)
    schema = spark.range(1).schema
    assert store.table("t", schema).count() == 3 and store.table("b", schema).count() == 50
    old = store.manifest()["tables"]["b"]
    some = store.table("b", schema, [2]).withColumn(BUCKET, F.lit(2))
    store.commit({}, 2, {"log": spark.range(2)}, {"b": some.where("id % 2 = 0")})
    now = store.manifest()["tables"]["b"]
    assert [b for b in sorted(old) if old[b] != now[b]] == ["2"] and store.table("log", schema).count() == 3
    assert store.table("b", schema).count() < 50
    for k in range(3, 8):
        store.commit({"t": spark.range(k)}, k)
    gone = store.vacuum(2)
    assert gone >= 5 and store.table("t", schema).count() == 7 and store.table("b", schema).count() > 30 and store.manifest()["number"] == 8
    store.reset()
    assert store.manifest()["number"] == 0


def test_alerts_are_recorded_first(spark, tmp_path):
    log = alerts.AlertLog(Store(spark, f"file://{tmp_path}/s"))
    with pytest.raises(ValueError):
        log.mark(1, True)
    lost = alerts.dispatch(log, 1, "ValidationFailure", "Critical", "s", {"a": 1}, NOW, webhook="http://127.0.0.1:9/x")
    kept = alerts.dispatch(log, 1, "ValidationFailure", "Critical", "s", {}, NOW, folder=str(tmp_path / "a"))
    assert not lost.delivered and kept.delivered and json.load(open(kept.delivery_detail))["raisedAtUtc"] == NOW
    assert [r["delivered"] for r in log.rows().orderBy("alert_id").collect()] == [False, True]
    assert log.mark(1, True, "by hand", 1) == 1 and log.rows().where("delivered").count() == 2
    log.store = None  # neither the record nor the mark can be written
    assert alerts.dispatch(log, 2, "PipelineError", "Critical", "s", {}, NOW, folder=str(tmp_path / "a")).delivered
    assert setting({"freshness.max_lag_hours": "x"}, "freshness.max_lag_hours") == 48


def test_status_and_lag(spark):
    one = spark.range(1)
    s = lambda c, f, a=None: one.select(checks.status(F.lit(c), F.lit(f), F.lit(a).cast("string"))).first()[0]
    assert [s(1, 1, "Succeeded"), s(0, 1), s(0, 0), s(0, 0, "Failed")] == ["Failed", "CompletedWithWarnings", "Succeeded", "Failed"]
    lag = one.select(checks.lag_hours(F.lit("2031-01-01 00:59:59").cast("timestamp_ntz"), F.lit("2031-01-01 01:00:00").cast("timestamp_ntz"))).first()[0]
    assert abs(lag - 1 / 60) < 1e-9


def test_stream_accounts_for_every_row_and_repeats_change_nothing(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    frame(spark, HEADER, H, H | {"RevisionNumber": 5}, H | {"SalesOrderID": 72, "CustomerID": None}).write.parquet(f"{tmp_path}/h")
    frame(spark, DETAIL, L, L | {"SalesOrderDetailID": 506, "SalesOrderID": 80}, L | {"SalesOrderDetailID": 507, "OrderQty": 0}).write.parquet(f"{tmp_path}/l")
    load = lambda e, at, clean: incremental.available_now(spark, f"{tmp_path}/{at}", store, e, NOW, f"{tmp_path}/cp-{at}", clean, "headers" if e is DETAIL else None, 4)
    for _ in range(2):
        load(HEADER, "h", "headers")
        load(DETAIL, "l", "lines")
    assert [r["RevisionNumber"] for r in store.table("headers", HEADER.schema).collect()] == [5]
    assert [r["SalesOrderDetailID"] for r in store.table("lines", DETAIL.schema).collect()] == [505]
    log = store.table("lines_batches", incremental.BATCHES).collect()
    assert [tuple(r)[2:] for r in log] == [(3, 1, 1, 1, 0, "QTY_NonPositive")]
    assert store.table("headers_batches", incremental.BATCHES).first()["rows_superseded"] == 1
    assert store.table("headers_rejected", incremental.REJECTED).first()["rejection_reason"] == "NULL_CustomerID"
    frame(spark, HEADER, H | {"SalesOrderID": 80}).write.mode("append").parquet(f"{tmp_path}/h")
    frame(spark, DETAIL, L | {"SalesOrderDetailID": 508}).write.mode("append").parquet(f"{tmp_path}/l")
    load(HEADER, "h", "headers")
    load(DETAIL, "l", "lines")
    assert sorted(r["SalesOrderDetailID"] for r in store.table("lines", DETAIL.schema).collect()) == [505, 506, 508]
    assert store.table("lines_waiting", DETAIL.schema).count() == 0


def orders(spark, n):
    heads = [H | {"SalesOrderID": 100 + k, "SalesOrderNumber": f"N-{100 + k}"} for k in range(n)]
    return frame(spark, HEADER, *heads), frame(spark, DETAIL, *[L | {"SalesOrderID": h["SalesOrderID"], "SalesOrderDetailID": 1000 + k} for k, h in enumerate(heads)])


def test_experiment_runs_a_history(spark, tmp_path):
    pipeline = Pipeline(spark, Store(spark, f"file://{tmp_path}/dw"), None, alert_folder=str(tmp_path / "a"), buckets=4)
    made = experiment.Experiment(spark, Store(spark, f"file://{tmp_path}/src"), *orders(spark, 12), pipeline)
    outcomes = made.history("2031-03-18 02:00:00", nights=1, orders=3, faults=3)
    assert [o.status for o in outcomes] == ["Succeeded", "Succeeded", "Failed", "Succeeded"]
    assert outcomes[1].loaded[HEADER.name] >= 4 and outcomes[2].rejected[HEADER.name] == 3 and outcomes[3].loaded[HEADER.name] == 3
    assert pipeline.warehouse(HEADER).count() == 15 and pipeline.warehouse(HEADER).where("Comment like 'FAULT%'").count() == 0
    headers = made.source(HEADER.name)
    one, two = (sorted(r["SalesOrderID"] for r in harness.sample(h, "SalesOrderID", 5, "x").collect()) for h in (headers, headers.repartition(7)))
    assert one == two != sorted(r["SalesOrderID"] for r in harness.sample(headers, "SalesOrderID", 5, "y").collect())


def test_command_line_on_clean_data(spark, tmp_path, monkeypatch, capsys):
    heads, lines = orders(spark, 20)
    heads.write.parquet(f"{tmp_path}/in/{HEADER.name}.parquet")
    lines.withColumnRenamed("OrderQty", "orderqty").withColumn("more", F.lit(1)).write.parquet(f"{tmp_path}/in/{DETAIL.name}")
    monkeypatch.chdir(tmp_path)
    assert cli.main(["run"], spark) == 2
    (tmp_path / ".env").write_text(f"# comment\nTIDEGATE_STORE=file://{tmp_path}/dw\nexport TIDEGATE_SOURCE='{tmp_path}/nowhere'\n")
    monkeypatch.setenv("TIDEGATE_SOURCE", f"{tmp_path}/in")  # the environment wins
    monkeypatch.setenv("TIDEGATE_FRESHNESS_MAX_LAG_HOURS", "72")
    assert cli.main(["report"], spark) == 1 and cli.main(["verify"], spark) == 1 and cli.main(["sing"], spark) == 2
    assert cli.main(["run", "--load-type", "Full", "--trigger", "Scheduled", "--now", "2031-04-01 00:00:00"], spark) == 0
    assert "Succeeded" in capsys.readouterr().out
    assert cli.main(["verify"], spark) == 0 and cli.main(["report", "--json", "--write"], spark) == 0
    out = capsys.readouterr().out
    assert json.loads(out[out.index("{") :])["rows_loaded"] == 40 and (tmp_path / "reports/metrics.md").exists()
    assert cli.main(["mark", "1"], spark) == 1 and cli.main(["reset", "--yes"], spark) == 0 and cli.main(["report"], spark) == 1
    with pytest.raises(connectors.Drift):
        connectors.typed(heads.drop("Freight"), HEADER)
    with pytest.raises(BadSettings):
        Settings.read({"TIDEGATE_STORE": "x", "TIDEGATE_SOURCE": "jdbc:a:b"}, "nofile")
    shown = repr(Settings.read({"TIDEGATE_STORE": "x", "TIDEGATE_SOURCE": "jdbc:a:b", "TIDEGATE_SOURCE_USER": "u", "TIDEGATE_SOURCE_PASSWORD": "hidden", "TIDEGATE_ALERT_WEBHOOK": "hidden"}, "nofile"))
    assert "hidden" not in shown


def test_source_behind_jdbc(spark, tmp_path):
    """Written and read through JDBC by the database that Spark brings along, if there is one."""
    heads, _ = orders(spark, 30)
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    try:
        heads.withColumn("OnlineOrderFlag", F.col("OnlineOrderFlag").cast("int")).write.jdbc(url, HEADER.name, properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver", "user": "app", "password": "app"})
    except Exception as error:
        pytest.skip(f"no embedded database: {str(error)[:80]}")
    read = connectors.jdbc_source(spark, url, "app", "app", "org.apache.derby.jdbc.EmbeddedDriver", 3)
    found = read(HEADER.name)
    assert found.schema == HEADER.schema and found.rdd.getNumPartitions() == 3 and found.count() == 30
    assert found.where("SalesOrderID < 110").count() == 10
