"""Queries of extraction, rules, quarantine, load and checks over the mapped entities, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.tsql import concat, iso, minutes_between
from tidegate.operators import checks, load, rules
from tidegate.plans.driver_tables import MAPPED_DETAIL as DETAIL
from tidegate.plans.driver_tables import SOURCE_SQL, detail, header, read
from tidegate.sources.entities import HEADER, Entity, stamp

START, STOP, SPLIT, AS_OF = "1998-01-01 00:00:00", "1999-01-01 00:00:00", "1998-01-01 00:00:00", "2001-01-01 00:00:00"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name, with the SQL that checks it ({S} stands for the mapping's CTEs)."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql.replace("{S}", SOURCE_SQL.strip())
        return f

    return add


def evaluated(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    rows = (header if entity is HEADER else detail)(spark, sf_dir)
    return rules.evaluate(rows, entity, AS_OF)


# Extraction


@query(f"WITH {{S}} SELECT SalesOrderID, OrderDate, CustomerID, TotalDue, ModifiedDate FROM h WHERE ModifiedDate >= TIMESTAMP '{START}' AND ModifiedDate < TIMESTAMP '{STOP}'")
def extract_header_window(spark, sf_dir):
    return HEADER.extract(header(spark, sf_dir, (START, STOP)), stamp(START), stamp(STOP)).select("SalesOrderID", "OrderDate", "CustomerID", "TotalDue", "ModifiedDate")


@query(f"WITH {{S}} SELECT * EXCLUDE (l_tax, l_returnflag, l_linestatus) FROM d WHERE ModifiedDate >= TIMESTAMP '{START}' AND ModifiedDate < TIMESTAMP '{STOP}'")
def extract_detail_window(spark, sf_dir):
    return DETAIL.extract(detail(spark, sf_dir), stamp(START), stamp(STOP))


@query(
    f"""SELECT 'SalesOrderHeader' AS entity_name, count(*) AS source_rows FROM orders WHERE o_orderdate >= TIMESTAMP '{START}' AND o_orderdate < TIMESTAMP '{STOP}'
    UNION ALL SELECT 'SalesOrderDetail', count(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '{START}' AND l_shipdate < TIMESTAMP '{STOP}'"""
)
def source_window_count(spark, sf_dir):
    def one(table, mark, entity):
        inside = read(spark, sf_dir, table).where((F.col(mark) >= stamp(START)) & (F.col(mark) < stamp(STOP)))
        return inside.agg(F.count("*").alias("source_rows")).select(F.lit(entity).alias("entity_name"), "source_rows")

    return one("orders", "o_orderdate", HEADER.name).unionByName(one("lineitem", "l_shipdate", DETAIL.name))


@query("SELECT 'SalesOrderHeader' AS entity_name, max(o_orderdate) AS high_water FROM orders UNION ALL SELECT 'SalesOrderDetail', max(l_shipdate) FROM lineitem")
def source_high_water(spark, sf_dir):
    one = lambda t, c, e: read(spark, sf_dir, t).agg(F.max(c).alias("high_water")).select(F.lit(e).alias("entity_name"), "high_water")
    return one("orders", "o_orderdate", HEADER.name).unionByName(one("lineitem", "l_shipdate", DETAIL.name))


@query(f"SELECT (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '{START}' AND o_orderdate < TIMESTAMP '{STOP}') AS row_count, (SELECT max(o_orderdate) FROM orders) AS high_water")
def source_count_and_high_water(spark, sf_dir):
    inside = (F.col("o_orderdate") >= stamp(START)) & (F.col("o_orderdate") < stamp(STOP))
    return read(spark, sf_dir, "orders").agg(F.count(F.when(inside, 1)).alias("row_count"), F.max("o_orderdate").alias("high_water"))


@query(
    """SELECT 'orders' AS table_name, count(*) AS n_rows, min(o_orderdate) AS earliest, max(o_orderdate) AS latest FROM orders
    UNION ALL SELECT 'lineitem', count(*), min(l_shipdate), max(l_shipdate) FROM lineitem"""
)
def source_baseline_union(spark, sf_dir):
    def one(table, mark):
        return read(spark, sf_dir, table).agg(F.count("*").alias("n_rows"), F.min(mark).alias("earliest"), F.max(mark).alias("latest")).select(F.lit(table).alias("table_name"), "*")

    return one("orders", "o_orderdate").unionByName(one("lineitem", "l_shipdate"))


@query(f"WITH {{S}} SELECT SalesOrderDetailID, LineTotal, CAST(7 AS BIGINT) AS etl_run_id, TIMESTAMP '{AS_OF}' AS etl_loaded_at FROM d")
def stage_with_lineage(spark, sf_dir):
    return detail(spark, sf_dir).select("SalesOrderDetailID", "LineTotal", F.lit(7).cast("long").alias("etl_run_id"), stamp(AS_OF).alias("etl_loaded_at"))


@query("SELECT (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(19,4))) AS DECIMAL(29,4)) FROM orders) AS header_total, (SELECT count(*) FROM lineitem) AS detail_rows")
def source_totals(spark, sf_dir):
    total = read(spark, sf_dir, "orders").agg(F.sum(F.col("o_totalprice").cast("decimal(19,4)")).cast("decimal(29,4)").alias("header_total"))
    return total.crossJoin(read(spark, sf_dir, "lineitem").agg(F.count("*").alias("detail_rows")))  # one row each


# Rules. The oracle filters survivors rule by rule; the query evaluates all rules in one pass.

_HEADER_CHAIN = (
    (1, "SalesOrderID IS NULL"), (2, "OrderDate IS NULL"), (3, "DueDate IS NULL"), (4, "CustomerID IS NULL"), (5, "Status IS NULL"), (6, "SalesOrderID IS NULL"),
    (7, "SubTotal IS NULL OR TaxAmt IS NULL OR Freight IS NULL OR TotalDue IS NULL"), (8, "ModifiedDate IS NULL"), (9, "CustomerID IS NULL"), (10, "RevisionNumber IS NULL"),
    (11, "SubTotal < 0 OR TaxAmt < 0 OR Freight < 0 OR TotalDue < 0"), (12, "DueDate < OrderDate"), (13, "ShipDate < OrderDate"),
)
_DETAIL_CHAIN = (
    (16, "SalesOrderDetailID IS NULL"), (17, "SalesOrderID IS NULL"), (18, "ProductID IS NULL OR SpecialOfferID IS NULL"),
    (19, "OrderQty IS NULL OR UnitPrice IS NULL OR UnitPriceDiscount IS NULL OR LineTotal IS NULL"), (20, "ModifiedDate IS NULL"), (21, "OrderQty <= 0"), (22, "UnitPrice < 0"),
    (23, "UnitPriceDiscount < 0 OR UnitPriceDiscount > 1"),
)


def _chain(base: str, steps, mark: str) -> tuple[str, str]:
    """CTEs s_<rule> of the rows left after each rule, and the name of the last."""
    out, before = [], base
    for number, bad in steps:
        out.append(f"{mark}{number} AS (SELECT * FROM {before} WHERE NOT coalesce({bad}, false))")
        before = f"{mark}{number}"
    return ", ".join(out), before


_HC, _HL = _chain("h", _HEADER_CHAIN, "hs")
_DC, _DL = _chain("d", _DETAIL_CHAIN, "ds")
_MISMATCH = "abs(LineTotal - CAST(CAST(UnitPrice AS DECIMAL(12,4)) * (CAST(1 AS DECIMAL(6,4)) - CAST(UnitPriceDiscount AS DECIMAL(6,4))) * OrderQty AS DECIMAL(38,6))) > 0.01"


def _rule_sql(numbers: list[int]) -> str:
    parts = []
    for n in numbers:
        rule = next(r for r in rules.RULES if r.number == n)
        steps, base, last, mark = (_HEADER_CHAIN, "h", _HL, "hs") if rule.entity == HEADER.name else (_DETAIL_CHAIN, "d", _DL, "ds")
        by = dict(steps)
        if n in by:
            earlier = [k for k in by if k < n]
            source = f"{mark}{earlier[-1]}" if earlier else base
            count = f"SELECT count(*) FROM {source} WHERE {by[n]}"
        elif rule.kind == "DuplicateCheck":
            count = f"SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM {last} WHERE {rule.column} IS NOT NULL GROUP BY {rule.column} HAVING count(*) > 1)"
        else:
            bad = f"OrderDate > TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY" if n == 14 else _MISMATCH
            count = f"SELECT count(*) FROM {last} WHERE {bad}"
        parts.append(f"SELECT {n} AS rule_id, '{rule.entity}' AS entity_name, '{rule.name}' AS check_name, '{rule.kind}' AS check_type, '{rule.severity}' AS severity, CAST(({count}) AS BIGINT) AS bad_rows")
    return f"WITH {SOURCE_SQL.strip()}, {_HC}, {_DC}, r AS ({' UNION ALL '.join(parts)}) SELECT *, CASE WHEN bad_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM r"


def _rule_query(name: str, entities: tuple[Entity, ...], numbers: list[int]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = None
        for entity in entities:
            one = rules.results(evaluated(spark, sf_dir, entity), entity).where(F.col("rule_id").isin(numbers))
            found = one if found is None else found.unionByName(one)
        return found

    QUERIES[name], ORACLES[name] = run, _rule_sql(numbers)


_rule_query("rule_null_checks_header", (HEADER,), list(range(1, 11)))
_rule_query("rule_null_checks_detail", (DETAIL,), list(range(16, 21)))
_rule_query("rule_domain_header", (HEADER,), [11, 12, 13, 14])
_rule_query("rule_domain_detail", (DETAIL,), [21, 22, 23, 24])
_rule_query("rule_date_contradictions", (HEADER,), [12, 13])
_rule_query("rule_future_orders", (HEADER,), [14])
_rule_query("rule_dup_header", (HEADER,), [15])
_rule_query("rule_dup_detail", (DETAIL,), [25])
_rule_query("rule_results", (DETAIL, HEADER), list(range(1, 26)))


#: Rules of a user: a duplicate key that quarantines, a predicate with a subquery over what the rules before have left.
OWN_RULES = (
    rules.Rule(1, DETAIL.name, "OWN_Quantity", "DomainCheck", "OrderQty", "OrderQty <= 0"),
    rules.Rule(2, DETAIL.name, "OWN_Repeated", "DuplicateCheck", "SalesOrderDetailID", ""),
    rules.Rule(3, DETAIL.name, "OWN_Dearest", "DomainCheck", "UnitPrice", "UnitPrice = (SELECT max(UnitPrice) FROM batch)"),
    rules.Rule(4, DETAIL.name, "OWN_Product", "NullCheck", "ProductID", "ProductID IS NULL", False),
)


@query(
    """WITH {S}, o1 AS (SELECT * FROM d WHERE OrderQty > 0), o2 AS (SELECT * FROM o1 WHERE SalesOrderDetailID NOT IN (SELECT SalesOrderDetailID FROM o1 GROUP BY 1 HAVING count(*) > 1)),
    o3 AS (SELECT * FROM o2 WHERE UnitPrice < (SELECT max(UnitPrice) FROM o2))
    SELECT 1 AS rule_id, 'Critical' AS severity, (SELECT count(*) FROM d) - (SELECT count(*) FROM o1) AS bad_rows UNION ALL
    SELECT 2, 'Critical', (SELECT count(*) FROM o1) - (SELECT count(*) FROM o2) UNION ALL
    SELECT 3, 'Critical', (SELECT count(*) FROM o2) - (SELECT count(*) FROM o3) UNION ALL
    SELECT 4, 'Warning', (SELECT count(*) FROM o3 WHERE ProductID IS NULL)"""
)
def rule_engine_own_rules(spark, sf_dir):
    batch = rules.evaluate(detail(spark, sf_dir), DETAIL, AS_OF, OWN_RULES)
    return rules.results(batch, DETAIL, OWN_RULES).select("rule_id", "severity", "bad_rows")


@query(
    """WITH {S}, o1 AS (SELECT * FROM d WHERE OrderQty > 0), twice AS (SELECT SalesOrderDetailID AS k FROM o1 GROUP BY 1 HAVING count(*) > 1)
    SELECT 'OWN_Quantity' AS rejection_reason, 'bad if OrderQty <= 0' AS rejection_detail, count(*) AS rejected FROM d WHERE OrderQty <= 0 UNION ALL
    SELECT 'OWN_Repeated', 'SalesOrderDetailID occurs more than once in the batch', count(*) FROM o1 WHERE SalesOrderDetailID IN (FROM twice) UNION ALL
    SELECT 'OWN_Dearest', 'bad if UnitPrice = (SELECT max(UnitPrice) FROM batch)', count(*) FROM o1
      WHERE SalesOrderDetailID NOT IN (FROM twice) AND UnitPrice = (SELECT max(UnitPrice) FROM o1 WHERE SalesOrderDetailID NOT IN (FROM twice))"""
)
def rejection_details(spark, sf_dir):
    batch = rules.evaluate(detail(spark, sf_dir), DETAIL, AS_OF, OWN_RULES)
    return rules.rejected_in_detail(batch, DETAIL, ["SalesOrderDetailID"], OWN_RULES).groupBy("rejection_reason", "rejection_detail").agg(F.count("*").alias("rejected"))


def _taken(chain, base: str, mark: str, columns: str) -> str:
    parts, before = [], base
    for number, bad in chain:
        name = next(r.name for r in rules.RULES if r.number == number)
        parts.append(f"SELECT {columns}, {number} AS rule_id, '{name}' AS rejection_reason FROM {before} WHERE {bad}")
        before = f"{mark}{number}"
    return " UNION ALL ".join(parts)


_REJECTED = f"""WITH {SOURCE_SQL.strip()}, {_HC}, {_DC}, rejected AS (
  SELECT 'SalesOrderHeader' AS entity_name, 'SalesOrderID=' || coalesce(CAST(SalesOrderID AS VARCHAR), '') AS business_key, rule_id, rejection_reason
  FROM ({_taken(_HEADER_CHAIN, "h", "hs", "SalesOrderID")})
  UNION ALL
  SELECT 'SalesOrderDetail', 'SalesOrderDetailID=' || coalesce(CAST(SalesOrderDetailID AS VARCHAR), ''), rule_id, rejection_reason
  FROM ({_taken(_DETAIL_CHAIN, "d", "ds", "SalesOrderDetailID")})
)"""


def all_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = rules.rejected(evaluated(spark, sf_dir, HEADER), HEADER, list(HEADER.columns))
    return h.unionByName(rules.rejected(evaluated(spark, sf_dir, DETAIL), DETAIL, list(DETAIL.columns)))


@query(f"{_REJECTED} SELECT entity_name, business_key, rule_id FROM rejected")
def rule_attribution(spark, sf_dir):
    def one(entity):
        bad = evaluated(spark, sf_dir, entity).where("first_rule is not null")
        return bad.select(F.lit(entity.name).alias("entity_name"), rules.business_key(entity).alias("business_key"), F.col("first_rule").alias("rule_id"))

    return one(HEADER).unionByName(one(DETAIL))


@query(f"{_REJECTED} SELECT entity_name, business_key, rejection_reason FROM rejected")
def quarantine_rows(spark, sf_dir):
    return all_rejected(spark, sf_dir).select("entity_name", "business_key", "rejection_reason")


@query(f"{_REJECTED} SELECT entity_name, count(*) AS rows_rejected FROM rejected GROUP BY entity_name")
def quarantine_counts(spark, sf_dir):
    return all_rejected(spark, sf_dir).groupBy("entity_name").agg(F.count("*").alias("rows_rejected"))


@query(f"{_REJECTED} SELECT entity_name, rejection_reason, count(*) AS rejected FROM rejected GROUP BY ALL ORDER BY rejected DESC, entity_name, rejection_reason")
def quarantine_breakdown(spark, sf_dir):
    return all_rejected(spark, sf_dir).groupBy("entity_name", "rejection_reason").agg(F.count("*").alias("rejected")).orderBy(F.desc("rejected"), "entity_name", "rejection_reason")


@query(
    f"""WITH {{S}}, {_DC} SELECT SalesOrderDetailID,
    '{{"SalesOrderID":' || SalesOrderID || ',"SalesOrderDetailID":' || SalesOrderDetailID || ',"OrderQty":' || OrderQty || CASE WHEN ProductID IS NULL THEN '' ELSE ',"ProductID":' || ProductID END
    || ',"ModifiedDate":"' || strftime(ModifiedDate, '%Y-%m-%dT%H:%M:%S') || '.000"}}' AS row_payload
    FROM (SELECT * FROM d EXCEPT ALL SELECT * FROM {_DL})"""
)
def quarantine_payload_json(spark, sf_dir):
    bad = evaluated(spark, sf_dir, DETAIL).where("first_rule is not null")
    return bad.select("SalesOrderDetailID", rules.payload(["SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "ModifiedDate"]).alias("row_payload"))


@query(f"WITH {{S}}, {_HC} SELECT SalesOrderID, RevisionNumber, OrderDate, TotalDue FROM {_HL}")
def survivors_header(spark, sf_dir):
    return rules.survivors(evaluated(spark, sf_dir, HEADER)).select("SalesOrderID", "RevisionNumber", "OrderDate", "TotalDue")


@query(f"WITH {{S}}, {_DC} SELECT SalesOrderDetailID, SalesOrderID, ProductID, LineTotal FROM {_DL}")
def survivors_detail(spark, sf_dir):
    return rules.survivors(evaluated(spark, sf_dir, DETAIL)).select("SalesOrderDetailID", "SalesOrderID", "ProductID", "LineTotal")


# Load: what was modified before SPLIT is in the warehouse, the rest and every 7th key of it comes in.

_LATEST_H = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY SalesOrderID ORDER BY ModifiedDate DESC, RevisionNumber DESC) AS rn FROM h) WHERE rn = 1"


@query(f"WITH {{S}} SELECT SalesOrderID, RevisionNumber, ModifiedDate FROM ({_LATEST_H})")
def dedup_header_latest(spark, sf_dir):
    return HEADER.latest_rows(header(spark, sf_dir)).select("SalesOrderID", "RevisionNumber", "ModifiedDate")


@query("WITH {S} SELECT SalesOrderDetailID, ProductID, LineTotal, ModifiedDate FROM dl")
def dedup_detail_latest(spark, sf_dir):
    return DETAIL.latest_rows(detail(spark, sf_dir)).select("SalesOrderDetailID", "ProductID", "LineTotal", "ModifiedDate")


@query("WITH {S} SELECT SalesOrderDetailID, SalesOrderID FROM dl WHERE SalesOrderID IN (SELECT SalesOrderID FROM h WHERE SalesOrderID % 89 <> 0)")
def detail_parent_semi(spark, sf_dir):
    lines, headers = DETAIL.latest_rows(detail(spark, sf_dir)), header(spark, sf_dir).where("SalesOrderID % 89 <> 0")
    return load.with_parent(lines, headers).select("SalesOrderDetailID", "SalesOrderID")


def _sides(rows: DataFrame, entity: Entity) -> DataFrame:
    """A warehouse of older rows, and a batch of newer rows, of old rows again and of rows from the day before."""
    k, mark = F.col(entity.key), F.col(entity.watermark)
    old = rows.where(mark < stamp(SPLIT))
    again = old.where(k % 7 == 0).withColumn(entity.watermark, F.when(k % 2 == 0, mark).otherwise(mark - F.expr("interval 1 day")))
    return load.upsert(old, rows.where(mark >= stamp(SPLIT)).unionByName(again), entity)


def _upsert_sql(latest: str, key: str, value: str) -> str:
    return f"""latest AS ({latest}), old AS (SELECT {key}, {value}, ModifiedDate FROM latest WHERE ModifiedDate < TIMESTAMP '{SPLIT}'),
    incoming AS (SELECT {key}, {value}, ModifiedDate FROM latest WHERE ModifiedDate >= TIMESTAMP '{SPLIT}'
      UNION ALL SELECT {key}, {value}, CASE WHEN {key} % 2 = 0 THEN ModifiedDate ELSE ModifiedDate - INTERVAL 1 DAY END FROM old WHERE {key} % 7 = 0),
    up AS (SELECT coalesce(o.{key}, i.{key}) AS {key},
      CASE WHEN o.{key} IS NULL THEN 'INSERT' WHEN i.{key} IS NULL THEN 'KEEP' WHEN i.ModifiedDate >= o.ModifiedDate THEN 'UPDATE' ELSE 'STALE' END AS action_taken,
      CASE WHEN o.{key} IS NULL OR i.ModifiedDate >= o.ModifiedDate THEN i.{value} ELSE o.{value} END AS {value},
      CASE WHEN o.{key} IS NULL OR i.ModifiedDate >= o.ModifiedDate THEN i.ModifiedDate ELSE o.ModifiedDate END AS ModifiedDate
      FROM old o FULL OUTER JOIN incoming i ON o.{key} = i.{key})"""


@query(f"WITH {{S}}, {_upsert_sql(_LATEST_H, 'SalesOrderID', 'TotalDue')} SELECT * FROM up")
def upsert_header(spark, sf_dir):
    done = _sides(HEADER.latest_rows(header(spark, sf_dir)), HEADER)
    return done.select("SalesOrderID", F.col("_action").alias("action_taken"), "TotalDue", "ModifiedDate")


@query(f"WITH {{S}}, {_upsert_sql('SELECT * FROM dl', 'SalesOrderDetailID', 'LineTotal')} SELECT * FROM up")
def upsert_detail(spark, sf_dir):
    done = _sides(DETAIL.latest_rows(detail(spark, sf_dir)), DETAIL)
    return done.select("SalesOrderDetailID", F.col("_action").alias("action_taken"), "LineTotal", "ModifiedDate")


@query(
    f"""WITH {{S}}, {_upsert_sql('SELECT * FROM dl', 'SalesOrderDetailID', 'LineTotal')}
    SELECT count(*) FILTER (action_taken = 'INSERT') AS rows_inserted, count(*) FILTER (action_taken = 'UPDATE') AS rows_updated,
    count(*) FILTER (action_taken = 'STALE') AS rows_stale, count(*) FILTER (action_taken IN ('INSERT', 'UPDATE')) AS rows_loaded FROM up"""
)
def upsert_action_counts(spark, sf_dir):
    return load.counts(_sides(DETAIL.latest_rows(detail(spark, sf_dir)), DETAIL))


# Checks over the latest rows; headers lack every 89th order so that orphans exist.

_DW = "hw AS (SELECT * FROM h WHERE SalesOrderID % 89 <> 0 AND RevisionNumber = 1)"


def _warehouse(spark, sf_dir):
    return header(spark, sf_dir).where("SalesOrderID % 89 <> 0 AND RevisionNumber = 1"), DETAIL.latest_rows(detail(spark, sf_dir))


@query(f"WITH {{S}}, {_DW} SELECT count(*) AS orphans FROM dl WHERE NOT EXISTS (SELECT 1 FROM hw WHERE hw.SalesOrderID = dl.SalesOrderID)")
def check_orphan_detail(spark, sf_dir):
    headers, lines = _warehouse(spark, sf_dir)
    return checks.orphans(lines, headers).agg(F.count("*").alias("orphans"))


@query(f"WITH {{S}}, {_DW} SELECT count(*) AS childless FROM hw WHERE NOT EXISTS (SELECT 1 FROM dl WHERE hw.SalesOrderID = dl.SalesOrderID)")
def check_header_without_detail(spark, sf_dir):
    headers, lines = _warehouse(spark, sf_dir)
    return checks.without_lines(headers, lines).agg(F.count("*").alias("childless"))


_OFF = "SELECT hw.SalesOrderID, hw.SubTotal, CAST(t.total AS DECIMAL(38,6)) AS lines_total FROM hw JOIN (SELECT SalesOrderID, sum(LineTotal) AS total FROM dl GROUP BY 1) t USING (SalesOrderID) WHERE abs(SubTotal - total) > 0.01"


@query(f"WITH {{S}}, {_DW} SELECT count(*) AS mismatches FROM ({_OFF})")
def check_subtotal_vs_lines(spark, sf_dir):
    return checks.subtotal_mismatches(*_warehouse(spark, sf_dir)).agg(F.count("*").alias("mismatches"))


@query(f"WITH {{S}}, {_DW} {_OFF}")
def subtotal_mismatch_listing(spark, sf_dir):
    return checks.subtotal_mismatches(*_warehouse(spark, sf_dir)).select("SalesOrderID", "SubTotal", "lines_total")


@query("WITH {S} SELECT count(*) AS duplicate_groups FROM (SELECT SalesOrderID FROM h GROUP BY SalesOrderID HAVING count(*) > 1)")
def check_dup_order_id(spark, sf_dir):
    return checks.duplicate_groups(header(spark, sf_dir), "SalesOrderID").agg(F.count("*").alias("duplicate_groups"))


@query("WITH {S} SELECT count(*) AS bad_lines FROM dl WHERE coalesce(OrderQty <= 0 OR UnitPrice < 0 OR UnitPriceDiscount < 0 OR UnitPriceDiscount > 1 OR LineTotal IS NULL OR ProductID IS NULL, false)")
def check_detail_domains(spark, sf_dir):
    return checks.outside_domain(_warehouse(spark, sf_dir)[1]).agg(F.count("*").alias("bad_lines"))


@query(
    f"""SELECT e.entity_name, s.n AS source_rows, x.n AS extracted_rows, x.n - s.n AS variance, CASE WHEN abs(x.n - s.n) <= 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT 'SalesOrderHeader' AS entity_name) e, (SELECT count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '{START}' AND o_orderdate < TIMESTAMP '{STOP}') s,
    (SELECT count(*) + count(*) FILTER (o_orderkey % 139 = 0 AND o_orderdate < TIMESTAMP '{STOP}' - INTERVAL 1 DAY AND o_orderdate >= TIMESTAMP '{START}') AS n FROM orders WHERE o_orderdate >= TIMESTAMP '{START}' AND o_orderdate < TIMESTAMP '{STOP}') x0,
    (WITH {{S}} SELECT count(*) AS n FROM h WHERE ModifiedDate >= TIMESTAMP '{START}' AND ModifiedDate < TIMESTAMP '{STOP}') x"""
)
def recon_source_staging(spark, sf_dir):
    source = read(spark, sf_dir, "orders").where((F.col("o_orderdate") >= stamp(START)) & (F.col("o_orderdate") < stamp(STOP))).agg(F.count("*").alias("source_rows"))
    staged = HEADER.extract(header(spark, sf_dir), stamp(START), stamp(STOP)).agg(F.count("*").alias("extracted_rows"))
    both = source.crossJoin(staged)  # one row each, from separate scans
    return both.select(F.lit(HEADER.name).alias("entity_name"), "source_rows", "extracted_rows", (F.col("extracted_rows") - F.col("source_rows")).alias("variance"), checks.reconciled(F.col("extracted_rows"), F.col("source_rows")).alias("status"))


@query(
    f"""WITH {{S}}, {_DC}, n AS (SELECT (SELECT count(*) FROM d) AS extracted_rows, (SELECT count(DISTINCT SalesOrderDetailID) FROM {_DL}) AS loaded_rows, (SELECT count(*) FROM d) - (SELECT count(*) FROM {_DL}) AS rejected_rows)
    SELECT 'SalesOrderDetail' AS entity_name, *, loaded_rows + rejected_rows - extracted_rows AS variance, CASE WHEN loaded_rows + rejected_rows = extracted_rows THEN 'PASS' ELSE 'FAIL' END AS status FROM n"""
)
def recon_staging_warehouse(spark, sf_dir):
    batch = evaluated(spark, sf_dir, DETAIL)
    alive = F.col("first_rule").isNull()
    n = batch.agg(F.count("*").alias("extracted_rows"), F.countDistinct(F.when(alive, F.col(DETAIL.key))).alias("loaded_rows"), F.count(F.when(~alive, 1)).alias("rejected_rows"))
    total = F.col("loaded_rows") + F.col("rejected_rows")
    return n.select(F.lit(DETAIL.name).alias("entity_name"), "*", (total - F.col("extracted_rows")).alias("variance"), checks.reconciled(total, F.col("extracted_rows")).alias("status"))


@query(
    """WITH m AS (SELECT 'SalesOrderHeader' AS entity_name, max(o_orderdate) FILTER (o_orderkey % 5 = 0) - INTERVAL 61 MINUTE AS loaded, max(o_orderdate) AS source FROM orders
      UNION ALL SELECT 'SalesOrderDetail', max(l_shipdate) FILTER (l_orderkey % 5 = 0) - INTERVAL 90 SECOND, max(l_shipdate) FROM lineitem),
    g AS (SELECT entity_name, greatest(date_diff('minute', loaded, source) / 60.0, 0.0) AS lag_hours FROM m)
    SELECT entity_name, round(CAST(lag_hours AS DOUBLE), 4) AS lag_hours, CASE WHEN lag_hours IS NULL THEN 'WARN' WHEN lag_hours <= 24 THEN 'PASS' ELSE 'FAIL' END AS status FROM g"""
)
def freshness_lag(spark, sf_dir):
    def one(table, mark, key, late, entity):
        loaded = F.max(F.when(F.col(key) % 5 == 0, F.col(mark))) - F.expr(late)
        return read(spark, sf_dir, table).agg(loaded.alias("loaded"), F.max(mark).alias("source")).select(F.lit(entity).alias("entity_name"), checks.lag_hours(F.col("loaded"), F.col("source")).alias("lag"))

    both = one("orders", "o_orderdate", "o_orderkey", "interval 61 minute", HEADER.name).unionByName(one("lineitem", "l_shipdate", "l_orderkey", "interval 90 second", DETAIL.name))
    return both.select("entity_name", F.round("lag", 4).alias("lag_hours"), checks.freshness_status(F.col("lag"), 24).alias("status"))


# Views


@query(
    """WITH {S}, g AS (SELECT CAST(OrderDate AS DATE) AS order_date, count(DISTINCT SalesOrderID) AS n_orders, CAST(sum(SubTotal) AS DECIMAL(29,4)) AS sub_total, CAST(sum(TaxAmt) AS DECIMAL(29,4)) AS tax,
      CAST(sum(Freight) AS DECIMAL(29,4)) AS freight, CAST(sum(TotalDue) AS DECIMAL(29,4)) AS total_due, count(TotalDue) AS n, CAST(sum(CAST(TotalDue * 10000 AS BIGINT)) AS BIGINT) AS units FROM h GROUP BY 1)
    SELECT order_date, n_orders, sub_total, tax, freight, total_due, CAST(((2 * units + n) // (2 * n)) AS DECIMAL(19,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS avg_due FROM g"""
)
def view_daily_sales(spark, sf_dir):
    return daily_sales(header(spark, sf_dir))


def daily_sales(headers: DataFrame) -> DataFrame:
    total = lambda c, n: F.sum(c).cast("decimal(29,4)").alias(n)
    return headers.groupBy(F.to_date("OrderDate").alias("order_date")).agg(
        F.countDistinct("SalesOrderID").alias("n_orders"), total("SubTotal", "sub_total"), total("TaxAmt", "tax"), total("Freight", "freight"), total("TotalDue", "total_due"),
        F.avg("TotalDue").cast("decimal(23,4)").alias("avg_due"),
    )


@query(
    """WITH {S} SELECT ProductID AS product_id, count(*) AS n_lines, CAST(sum(OrderQty) AS BIGINT) AS units, CAST(sum(LineTotal) AS DECIMAL(38,6)) AS revenue, min(OrderDate) AS first_order, max(OrderDate) AS last_order
    FROM dl JOIN h USING (SalesOrderID) WHERE RevisionNumber = 1 GROUP BY 1"""
)
def view_product_sales(spark, sf_dir):
    return product_sales(header(spark, sf_dir).where("RevisionNumber = 1"), DETAIL.latest_rows(detail(spark, sf_dir)))


def product_sales(headers: DataFrame, lines: DataFrame) -> DataFrame:
    joined = lines.join(headers.select("SalesOrderID", "OrderDate"), "SalesOrderID")
    return joined.groupBy(F.col("ProductID").alias("product_id")).agg(
        F.count("*").alias("n_lines"), F.sum(F.col("OrderQty").cast("long")).alias("units"), F.sum("LineTotal").cast("decimal(38,6)").alias("revenue"), F.min("OrderDate").alias("first_order"), F.max("OrderDate").alias("last_order")
    )


# Harness


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25")
def sample_topn(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(25)


@query(
    f"""WITH {{S}}, picked AS (SELECT SalesOrderDetailID FROM dl WHERE SalesOrderDetailID % 50 = 0 ORDER BY SalesOrderDetailID LIMIT 40)
    SELECT SalesOrderDetailID, CAST(CASE WHEN p.SalesOrderDetailID IS NOT NULL THEN OrderQty + 1 ELSE OrderQty END AS SMALLINT) AS OrderQty, CASE WHEN p.SalesOrderDetailID IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE ModifiedDate END AS ModifiedDate
    FROM dl LEFT JOIN picked p USING (SalesOrderDetailID)"""
)
def simulate_amend(spark, sf_dir):
    from tidegate.operators import harness

    lines = DETAIL.latest_rows(detail(spark, sf_dir))
    return harness.amend(lines, lines.where("SalesOrderDetailID % 50 = 0").orderBy("SalesOrderDetailID").limit(40), AS_OF).select("SalesOrderDetailID", "OrderQty", "ModifiedDate")


@query(
    f"""WITH {{S}}, one AS (SELECT * FROM h WHERE RevisionNumber = 1 AND OrderDate IS NOT NULL ORDER BY SalesOrderID LIMIT 12), n AS (SELECT *, row_number() OVER (ORDER BY SalesOrderID) AS k FROM one)
    SELECT SalesOrderID, CASE k % 3 WHEN 1 THEN OrderDate - INTERVAL 5 DAY ELSE DueDate END AS DueDate, CASE k % 3 WHEN 2 THEN OrderDate - INTERVAL 2 DAY ELSE ShipDate END AS ShipDate,
    CASE k % 3 WHEN 0 THEN CAST(-25 AS DECIMAL(19,4)) ELSE Freight END AS Freight, 'FAULT_' || CASE k % 3 WHEN 1 THEN 'due' WHEN 2 THEN 'ship' ELSE 'freight' END AS Comment FROM n"""
)
def inject_faults(spark, sf_dir):
    from tidegate.operators import harness

    picked = header(spark, sf_dir).where("RevisionNumber = 1 AND OrderDate IS NOT NULL").orderBy("SalesOrderID").limit(12)
    return harness.with_faults(picked).select("SalesOrderID", "DueDate", "ShipDate", "Freight", "Comment")


@query("SELECT p_name, p_type FROM part WHERE p_name LIKE '%l_e%'")
def fault_marker_like(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_name", "p_type").where(F.col("p_name").like("%l_e%"))


@query(
    """SELECT o_orderkey, 'K=' || CAST(o_orderkey AS VARCHAR) || coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, '') AS joined, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso_date,
    abs(CAST(o_orderkey AS BIGINT) - 1000) AS distance, date_diff('minute', o_orderdate, o_orderdate + INTERVAL 61 SECOND) AS minutes, TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number,
    greatest(o_orderkey - 500, 0) AS clamped, o_orderdate + INTERVAL 1 DAY AS next_day, CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DECIMAL(19,2)) AS rounded, trim('  x ') AS trimmed FROM orders"""
)
def scalar_functions(spark, sf_dir):
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        k, concat(F.lit("K="), "o_orderkey", F.when(k % 2 == 0, F.col("o_orderpriority"))).alias("joined"), iso(F.col("o_orderdate")).alias("iso_date"), F.abs(k - 1000).alias("distance"),
        minutes_between(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("interval 61 second")).alias("minutes"), F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
        F.greatest(k - 500, F.lit(0).cast("long")).alias("clamped"), (F.col("o_orderdate") + F.expr("interval 1 day")).alias("next_day"), F.col("o_totalprice").cast("decimal(19,4)").cast("decimal(19,2)").alias("rounded"), F.trim(F.lit("  x ")).alias("trimmed"),
    )


@query("SELECT SalesOrderID FROM (SELECT o_orderkey AS SalesOrderID, md5('night-1:' || o_orderkey) AS pick FROM orders) ORDER BY pick, SalesOrderID LIMIT 50")
def seeded_sample(spark, sf_dir):
    from tidegate.operators import harness

    return harness.sample(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("SalesOrderID")), "SalesOrderID", 50, "night-1")
