"""Mutations of a source for tests and experiments: seeded samples, new orders, amended lines, injected and reverted faults."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.sources.entities import MONEY, stamp

FAULTS = ("due", "ship", "freight")
MARK = "FAULT_"


def sample(rows: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows picked by a seeded hash of their key: the same ones again for the same seed, whatever the partitions."""
    return rows.withColumn("_pick", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))).orderBy("_pick", key).limit(n).drop("_pick")


def book(headers: DataFrame, lines: DataFrame, n: int, seed: str, now: str) -> tuple[DataFrame, DataFrame]:
    """New orders: the sources with ``n`` sampled orders and their lines booked again under new keys, modified now."""
    top, top_line = headers.agg(F.max("SalesOrderID")).first()[0] or 0, lines.agg(F.max("SalesOrderDetailID")).first()[0] or 0
    picked = sample(headers.join(lines.select("SalesOrderID").distinct(), "SalesOrderID", "left_semi"), "SalesOrderID", n, seed)
    # At most ``n`` orders and their lines are numbered, so the windows see a bounded sample.
    new_id = (F.lit(top) + F.row_number().over(Window.orderBy("SalesOrderID"))).cast("int")
    numbered = picked.withColumn("_new", new_id).withColumn("_gap", stamp(now) - F.col("OrderDate"))
    again = numbered.withColumn("SalesOrderNumber", F.concat(F.lit("SO"), F.col("_new").cast("string")))
    for c in ("OrderDate", "DueDate", "ShipDate"):
        again = again.withColumn(c, F.col(c) + F.col("_gap"))
    again = again.withColumn("RevisionNumber", F.lit(1).cast("smallint")).withColumn("ModifiedDate", stamp(now)).withColumn("_old", F.col("SalesOrderID")).withColumn("SalesOrderID", F.col("_new"))
    keys = again.select(F.col("_old").alias("SalesOrderID"), "_new")
    more = lines.join(keys, "SalesOrderID").withColumn("SalesOrderID", F.col("_new"))
    line_id = (F.lit(top_line) + F.row_number().over(Window.orderBy("_new", "SalesOrderDetailID"))).cast("int")
    more = more.withColumn("SalesOrderDetailID", line_id).withColumn("ModifiedDate", stamp(now))
    return headers.unionByName(again.select(headers.columns)), lines.unionByName(more.select(lines.columns))


def amend(lines: DataFrame, picked: DataFrame, now: str) -> DataFrame:
    """One more of each picked line, modified now; ``picked`` is a bounded sample of keys."""
    keys = picked.select("SalesOrderDetailID", F.lit(True).alias("_picked"))
    hit = F.coalesce("_picked", F.lit(False))
    out = lines.join(keys, "SalesOrderDetailID", "left")
    quantity = F.when(hit, F.col("OrderQty") + 1).otherwise(F.col("OrderQty")).cast("smallint")
    return out.withColumn("OrderQty", quantity).withColumn("ModifiedDate", F.when(hit, stamp(now)).otherwise(F.col("ModifiedDate"))).drop("_picked")


def with_faults(headers: DataFrame) -> DataFrame:
    """A bounded sample of headers, each with one of the three faults in turn and a mark in its comment."""
    k = F.row_number().over(Window.orderBy("SalesOrderID")) % 3
    rows = headers.withColumn("_k", k)
    return (
        rows.withColumn("DueDate", F.when(F.col("_k") == 1, F.col("OrderDate") - F.expr("interval 5 day")).otherwise(F.col("DueDate")))
        .withColumn("ShipDate", F.when(F.col("_k") == 2, F.col("OrderDate") - F.expr("interval 2 day")).otherwise(F.col("ShipDate")))
        .withColumn("Freight", F.when(F.col("_k") == 0, F.lit(-25).cast(MONEY)).otherwise(F.col("Freight")))
        .withColumn("Comment", F.concat(F.lit(MARK), F.when(F.col("_k") == 1, "due").when(F.col("_k") == 2, "ship").otherwise("freight")))
        .drop("_k")
    )


def reverted(headers: DataFrame, original: DataFrame) -> DataFrame:
    """Marked headers replaced by their original rows."""
    marked = F.coalesce(F.col("Comment").like(f"{MARK}%"), F.lit(False))
    return headers.where(~marked).unionByName(original.join(headers.where(marked).select("SalesOrderID"), "SalesOrderID", "left_semi").select(headers.columns))
