"""Declarative data-quality rules with the semantics of rule-by-rule quarantine, evaluated in as few passes as they allow.

A rule's predicate is TRUE for a bad row. Rules run in order; a row failing a quarantining rule leaves the batch, so it
is rejected once, by the first such rule, and later rules do not see it. Instead of counting and deleting once a rule,
``evaluate`` finds each row's first failing quarantining rule in one projection for a run of rules that look at one row;
what rule i would count is then the rows whose predicate holds and that no earlier rule took. A rule that looks at other
rows (duplicates, or a predicate with a subquery over the view ``batch``) sees the survivors of the rules before it:
duplicate keys are counted by an aggregate with map-side combine and joined, null keys spread by their row's hash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.tsql import concat, holds, quoted
from tidegate.sources.entities import DETAIL, HEADER, Entity


@dataclass(frozen=True)
class Rule:
    number: int
    entity: str
    name: str
    kind: str
    column: str
    predicate: str
    quarantine: bool = True
    enabled: bool = True
    detail: str = ""

    @property
    def severity(self) -> str:
        return "Critical" if self.quarantine else "Warning"

    @property
    def over_rows(self) -> bool:
        """Whether the rule looks at more than one row."""
        return self.kind == "DuplicateCheck" or re.search(r"(?i)\bselect\b", self.predicate) is not None

    @property
    def description(self) -> str:
        return self.detail or (f"{self.column} occurs more than once in the batch" if self.kind == "DuplicateCheck" else f"bad if {self.predicate}")


def _null(*columns: str) -> str:
    return " OR ".join(f"{quoted(c)} IS NULL" for c in columns)


_H, _D = HEADER.name, DETAIL.name
#: The seeded rules, in order; ``{as_of}`` is the run's clock.
RULES = (
    Rule(1, _H, "NULL_SalesOrderID", "NullCheck", "SalesOrderID", _null("SalesOrderID")),
    Rule(2, _H, "NULL_OrderDate", "NullCheck", "OrderDate", _null("OrderDate")),
    Rule(3, _H, "NULL_DueDate", "NullCheck", "DueDate", _null("DueDate")),
    Rule(4, _H, "NULL_CustomerID", "NullCheck", "CustomerID", _null("CustomerID")),
    Rule(5, _H, "NULL_Status", "NullCheck", "Status", _null("Status")),
    Rule(6, _H, "NULL_SalesOrderNumber", "NullCheck", "SalesOrderNumber", _null("SalesOrderNumber")),
    Rule(7, _H, "NULL_Amounts", "NullCheck", "TotalDue", _null("SubTotal", "TaxAmt", "Freight", "TotalDue")),
    Rule(8, _H, "NULL_ModifiedDate", "NullCheck", "ModifiedDate", _null("ModifiedDate")),
    Rule(9, _H, "NULL_AddressIDs", "NullCheck", "BillToAddressID", _null("BillToAddressID", "ShipToAddressID", "ShipMethodID")),
    Rule(10, _H, "NULL_RevisionNumber", "NullCheck", "RevisionNumber", _null("RevisionNumber", "OnlineOrderFlag")),
    Rule(11, _H, "NEG_Amounts", "DomainCheck", "TotalDue", "SubTotal < 0 OR TaxAmt < 0 OR Freight < 0 OR TotalDue < 0"),
    Rule(12, _H, "DATE_DueBeforeOrder", "DomainCheck", "DueDate", "DueDate < OrderDate"),
    Rule(13, _H, "DATE_ShipBeforeOrder", "DomainCheck", "ShipDate", "ShipDate IS NOT NULL AND ShipDate < OrderDate"),
    Rule(14, _H, "DATE_OrderInFuture", "DomainCheck", "OrderDate", "OrderDate > cast('{as_of}' as timestamp_ntz) + interval 1 day", False),
    Rule(15, _H, "DUP_SalesOrderID", "DuplicateCheck", "SalesOrderID", "", False),
    Rule(16, _D, "NULL_SalesOrderDetailID", "NullCheck", "SalesOrderDetailID", _null("SalesOrderDetailID")),
    Rule(17, _D, "NULL_SalesOrderID", "NullCheck", "SalesOrderID", _null("SalesOrderID")),
    Rule(18, _D, "NULL_ProductID", "NullCheck", "ProductID", _null("ProductID", "SpecialOfferID")),
    Rule(19, _D, "NULL_Amounts", "NullCheck", "LineTotal", _null("OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal")),
    Rule(20, _D, "NULL_ModifiedDate", "NullCheck", "ModifiedDate", _null("ModifiedDate")),
    Rule(21, _D, "QTY_NonPositive", "DomainCheck", "OrderQty", "OrderQty <= 0"),
    Rule(22, _D, "PRICE_Negative", "DomainCheck", "UnitPrice", "UnitPrice < 0"),
    Rule(23, _D, "DISCOUNT_OutOfRange", "DomainCheck", "UnitPriceDiscount", "UnitPriceDiscount < 0 OR UnitPriceDiscount > 1"),
    Rule(24, _D, "LINETOTAL_Mismatch", "TypeCheck", "LineTotal", "abs(LineTotal - UnitPrice * (1 - UnitPriceDiscount) * OrderQty) > 0.01", False),
    Rule(25, _D, "DUP_SalesOrderDetailID", "DuplicateCheck", "SalesOrderDetailID", "", False),
)


def rules_of(entity: Entity, rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    return sorted((r for r in rules if r.entity == entity.name and r.enabled), key=lambda r: r.number)


def toggled(rules: tuple[Rule, ...], name: str, enabled: bool) -> tuple[Rule, ...]:
    return tuple(replace(r, enabled=enabled) if r.name == name else r for r in rules)


def predicate(rule: Rule, as_of: str) -> Column:
    return holds(F.expr(rule.predicate.format(as_of=as_of)))


def seeded(existing: tuple[Rule, ...], seed: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """``seed`` over ``existing``: definitions are refreshed, what is switched on or off stays, and own rules stay."""
    state = {(r.entity, r.name): r.enabled for r in existing}
    fresh = {(r.entity, r.name) for r in seed}
    return (*[replace(r, enabled=state.get((r.entity, r.name), r.enabled)) for r in seed], *[r for r in existing if (r.entity, r.name) not in fresh])


def evaluate(rows: DataFrame, entity: Entity, as_of: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``rows`` with ``first_rule`` (number of the rule that rejects the row, or null) and ``bad_<number>`` for each rule."""
    columns, out = rows.columns, rows.withColumn("first_rule", F.lit(None).cast("int"))
    waiting: list[Rule] = []

    def settle(out: DataFrame) -> DataFrame:
        """All waiting rules of one row each in one projection."""
        if not waiting:
            return out
        mine, alive = list(waiting), F.col("first_rule").isNull()
        waiting.clear()
        first = F.coalesce(*[F.when(predicate(r, as_of), F.lit(r.number)) for r in mine if r.quarantine], F.lit(None).cast("int"))
        out = out.withColumn("_first", F.when(alive, first))
        for r in mine:
            out = out.withColumn(f"bad_{r.number}", predicate(r, as_of) & alive & (F.col("_first").isNull() | (F.col("_first") >= r.number)))
        return out.withColumn("first_rule", F.coalesce("first_rule", "_first")).drop("_first")

    for r in rules_of(entity, rules):
        if not r.over_rows:
            waiting.append(r)
            continue
        out = settle(out)
        alive = F.col("first_rule").isNull()
        if r.kind == "DuplicateCheck":
            key = quoted(r.column or entity.key)
            copies = out.where(alive & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_copies")).where("_copies > 1")
            # Rows that cannot be duplicates have a null key; the salt keeps them from meeting in one task.
            salt = F.when(~alive | F.col(key).isNull(), F.xxhash64(*[F.col(quoted(c)) for c in columns])).otherwise(F.lit(0))
            salted = out.withColumn("_salt", salt).withColumn("_own", F.when(F.col("_salt") == 0, F.col(key)))
            joined = salted.join(copies.withColumn("_zero", F.lit(0).cast("long")), (F.col("_own") == F.col("_key")) & (F.col("_salt") == F.col("_zero")), "left")
            bad = alive & F.col("_copies").isNotNull()
            out = joined.withColumn(f"bad_{r.number}", bad).drop("_salt", "_own", "_key", "_zero", "_copies")
        else:
            # A subquery sees the batch as the rules before have left it, under the name ``batch``.
            view = f"batch_{uuid4().hex}"
            out.where(alive).select(*[F.col(quoted(c)) for c in columns]).createOrReplaceTempView(view)
            held = out.withColumn("_alive", alive)
            held.createOrReplaceTempView(f"{view}_all")
            text = re.sub(r"(?i)\bbatch\b", view, r.predicate.format(as_of=as_of))
            out = rows.sparkSession.sql(f"SELECT *, _alive AND coalesce(({text}), false) AS bad_{r.number} FROM {view}_all AS s").drop("_alive")
        if r.quarantine:
            out = out.withColumn("first_rule", F.when(F.col(f"bad_{r.number}"), F.lit(r.number)).otherwise(F.col("first_rule")))
    return settle(out)


def tallies(entity: Entity, rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """Aggregates over an evaluated batch: the bad rows of each rule."""
    return [F.coalesce(F.sum(F.col(f"bad_{r.number}").cast("long")), F.lit(0)).alias(f"n_{r.number}") for r in rules_of(entity, rules)]


def results(evaluated: DataFrame, entity: Entity, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A check row for each rule: one aggregate over the batch, turned into rows."""
    mine = rules_of(entity, rules)
    counts = evaluated.agg(*tallies(entity, rules))
    rows = F.array(*[F.struct(F.lit(r.number).alias("rule_id"), F.lit(entity.name).alias("entity_name"), F.lit(r.name).alias("check_name"), F.lit(r.kind).alias("check_type"), F.lit(r.severity).alias("severity"), F.col(f"n_{r.number}").alias("bad_rows")) for r in mine])
    flat = counts.select(F.explode(rows).alias("r")).select("r.*")
    return flat.withColumn("status", F.when(F.col("bad_rows") > 0, "FAIL").otherwise("PASS"))


def message(rule: Rule, bad_rows: int) -> str | None:
    """What a check row says about its count."""
    if not bad_rows:
        return None
    return f"{bad_rows} rows failed and were " + ("quarantined" if rule.quarantine else "reported only")


def business_key(entity: Entity) -> Column:
    return concat(F.lit(f"{entity.key}="), entity.key)


def payload(columns: list[str]) -> Column:
    """The whole row as JSON text; null columns are left out, time stamps in ISO form."""
    return F.to_json(F.struct(*columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS"})


def rejected(evaluated: DataFrame, entity: Entity, columns: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """entity_name, business_key, rejection_reason, row_payload of each quarantined row."""
    return rejected_in_detail(evaluated, entity, columns, rules).drop("rejection_detail")


def rejected_in_detail(evaluated: DataFrame, entity: Entity, columns: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """As ``rejected``, with ``rejection_detail``, the rule's description."""
    mine = rules_of(entity, rules)
    of = lambda what: F.create_map(*[x for r in mine for x in (F.lit(r.number), F.lit(what(r)))])[F.col("first_rule")]
    bad = evaluated.where("first_rule is not null")
    return bad.select(
        F.lit(entity.name).alias("entity_name"), business_key(entity).alias("business_key"), of(lambda r: r.name).alias("rejection_reason"),
        of(lambda r: r.description).alias("rejection_detail"), payload(columns).alias("row_payload"),
    )


def survivors(evaluated: DataFrame) -> DataFrame:
    return evaluated.where("first_rule is null").drop("first_rule", *[c for c in evaluated.columns if c.startswith("bad_")])
