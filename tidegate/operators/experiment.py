"""A made history on a store: a full load, nights of booked and amended orders, a night of faults, its recovery."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import harness
from tidegate.operators.pipeline import Outcome, Pipeline
from tidegate.sources.entities import DETAIL, HEADER
from tidegate.sources.store import Store


class Experiment:
    """Keeps the mutated sources as tables of a store of their own, so each step reads what the last one wrote."""

    def __init__(self, spark: SparkSession, sources: Store, headers: DataFrame, lines: DataFrame, pipeline: Pipeline):
        self.spark, self.sources, self.pipeline = spark, sources, pipeline
        pipeline.source = self.source
        self._write(headers, lines)

    def source(self, name: str) -> DataFrame:
        entity = next(e for e in (HEADER, DETAIL) if e.name == name)
        return self.sources.table(name, entity.schema)

    def _write(self, headers: DataFrame, lines: DataFrame) -> None:
        self.sources.commit({HEADER.name: headers.select(*HEADER.columns), DETAIL.name: lines.select(*DETAIL.columns)}, self.sources.manifest()["number"])

    def book(self, n: int, seed: str, now: str) -> None:
        self._write(*harness.book(self.source(HEADER.name), self.source(DETAIL.name), n, seed, now))

    def amend(self, n: int, seed: str, now: str) -> None:
        """More of some lines, and their headers' subtotals with them."""
        headers, lines = self.source(HEADER.name), self.source(DETAIL.name)
        picked = harness.sample(lines, "SalesOrderDetailID", n, seed)
        after = harness.amend(lines, picked, now)
        total = (F.col("UnitPrice") * (1 - F.col("UnitPriceDiscount")) * F.col("OrderQty")).cast("decimal(38,6)")
        after = after.join(picked.select("SalesOrderDetailID", F.lit(True).alias("_p")), "SalesOrderDetailID", "left").withColumn("LineTotal", F.when(F.col("_p"), total).otherwise(F.col("LineTotal"))).drop("_p")
        touched = picked.select("SalesOrderID").distinct()
        sums = after.join(touched, "SalesOrderID", "left_semi").groupBy("SalesOrderID").agg(F.sum("LineTotal").cast("decimal(19,4)").alias("_sum"))
        changed = headers.join(sums, "SalesOrderID", "left")
        hit = F.col("_sum").isNotNull()
        changed = changed.withColumn("SubTotal", F.coalesce("_sum", "SubTotal")).withColumn("ModifiedDate", F.when(hit, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("ModifiedDate")))
        self._write(changed, after)

    def inject(self, n: int, seed: str, now: str) -> DataFrame:
        """Faults in sampled headers; the rows as they were."""
        headers = self.source(HEADER.name)
        picked = harness.sample(headers.where("OrderDate IS NOT NULL"), "SalesOrderID", n, seed)
        bad = harness.with_faults(picked).withColumn("ModifiedDate", F.lit(now).cast("timestamp_ntz"))
        rest = headers.join(picked.select("SalesOrderID"), "SalesOrderID", "left_anti")
        before = self.spark.createDataFrame(picked.collect(), HEADER.schema)  # ``n`` rows
        self._write(rest.unionByName(bad.select(headers.columns)), self.source(DETAIL.name))
        return before

    def revert(self, before: DataFrame, now: str) -> None:
        good = before.withColumn("ModifiedDate", F.lit(now).cast("timestamp_ntz"))
        self._write(harness.reverted(self.source(HEADER.name), good), self.source(DETAIL.name))

    def history(self, start: str, nights: int = 3, orders: int = 20, faults: int = 6) -> list[Outcome]:
        """Full load, nights, a night of faults and the night after; each run one day later than the last."""
        at = lambda k, hour=2: (dt.datetime.fromisoformat(start) + dt.timedelta(days=k, hours=hour - 2)).strftime("%Y-%m-%d %H:%M:%S")
        out = [self.pipeline.run(at(0), "Full")]
        for k in range(1, nights + 1):
            self.book(orders, f"book-{k}", at(k, 0))
            self.amend(orders, f"amend-{k}", at(k, 1))
            out.append(self.pipeline.run(at(k), trigger="Scheduled"))
        before = self.inject(faults, "faults", at(nights + 1, 0))
        out.append(self.pipeline.run(at(nights + 1), trigger="Scheduled"))
        self.revert(before, at(nights + 2, 0))
        out.append(self.pipeline.run(at(nights + 2), trigger="Scheduled"))
        return out
