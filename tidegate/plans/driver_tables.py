"""The driver's tables as sources of the entities, with faults at fixed keys so that every rule has something to find."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sources.entities import DETAIL, MONEY, TOTAL, stamp
from tidegate.sources.entities import T as types

#: Lines as mapped here have three more columns that break ties.
MAPPED_DETAIL = replace(DETAIL, latest=(*DETAIL.latest, "l_tax", "l_returnflag", "l_linestatus"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines mapped from ``lineitem``, with faults at fixed keys and the columns that break ties."""
    k, price, rate = F.col("l_orderkey"), F.col("l_extendedprice").cast(MONEY), F.col("l_discount").cast(MONEY)
    quantity = F.col("l_quantity").cast("smallint")
    total = (price * (F.lit(1) - rate) * quantity).cast(TOTAL) + F.when(k % 137 == 0, F.lit(1)).otherwise(F.lit(0)).cast(types.DecimalType(1, 0))
    return read(spark, sf_dir, "lineitem").select(
        k.cast("int").alias("SalesOrderID"),
        (k * 10 + F.col("l_linenumber")).cast("int").alias("SalesOrderDetailID"),
        F.lit(None).cast("string").alias("CarrierTrackingNumber"),
        F.when(k % 101 == 0, F.lit(0).cast("smallint")).otherwise(quantity).alias("OrderQty"),
        F.when(k % 103 != 0, F.col("l_partkey").cast("int")).alias("ProductID"),
        F.col("l_suppkey").cast("int").alias("SpecialOfferID"),
        price.alias("UnitPrice"),
        F.when(k % 107 == 0, F.lit("1.5").cast(MONEY)).otherwise(rate).alias("UnitPriceDiscount"),
        total.cast(TOTAL).alias("LineTotal"),
        F.col("l_shipdate").alias("ModifiedDate"),
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    )


def header(spark: SparkSession, sf_dir: str, window: tuple[str, str] | None = None) -> DataFrame:
    """Orders mapped from ``orders``; every 139th order comes a second time as a later revision, modified a day later.

    With a ``window`` of modification dates the scan itself is filtered; rows just outside may still come.
    """
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    money = lambda x: F.lit(x).cast(MONEY)
    sums = MAPPED_DETAIL.latest_rows(detail(spark, sf_dir)).groupBy("SalesOrderID").agg(F.sum("LineTotal").cast(MONEY).alias("lines"))
    orders = read(spark, sf_dir, "orders")
    if window:
        orders = orders.where((F.col("o_orderdate") >= stamp(window[0]) - F.expr("interval 1 day")) & (F.col("o_orderdate") < stamp(window[1])))
    rows = orders.join(sums, F.col("o_orderkey") == F.col("SalesOrderID"), "left")
    days = lambda n: F.expr(f"interval {n} day")
    mapped = rows.select(
        k.cast("int").alias("SalesOrderID"),
        F.lit(1).cast("smallint").alias("RevisionNumber"),
        F.when(k % 109 != 0, day).alias("OrderDate"),
        F.when(k % 113 == 0, day - days(5)).otherwise(day + days(7)).alias("DueDate"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("timestamp_ntz")).when(k % 127 == 0, day - days(2)).otherwise(day + days(5)).alias("ShipDate"),
        F.when(F.col("o_orderstatus") == "F", 5).when(F.col("o_orderstatus") == "O", 1).otherwise(2).cast("smallint").alias("Status"),
        F.lit(True).alias("OnlineOrderFlag"),
        F.concat(F.lit("SO"), k.cast("string")).alias("SalesOrderNumber"),
        F.lit(None).cast("string").alias("PurchaseOrderNumber"),
        F.lit(None).cast("string").alias("AccountNumber"),
        F.col("o_custkey").cast("int").alias("CustomerID"),
        F.lit(None).cast("int").alias("SalesPersonID"),
        F.lit(None).cast("int").alias("TerritoryID"),
        F.col("o_custkey").cast("int").alias("BillToAddressID"),
        F.col("o_custkey").cast("int").alias("ShipToAddressID"),
        F.lit(5).alias("ShipMethodID"),
        F.when(k % 97 == 0, F.col("o_totalprice").cast(MONEY)).otherwise(F.coalesce("lines", money(0))).alias("SubTotal"),
        money(0).alias("TaxAmt"),
        F.when(k % 131 == 0, money(-25)).otherwise(money(0)).alias("Freight"),
        F.col("o_totalprice").cast(MONEY).alias("TotalDue"),
        F.lit(None).cast("string").alias("Comment"),
        day.alias("ModifiedDate"),
    )
    again = F.explode(F.when(F.col("SalesOrderID") % 139 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    twice = mapped.withColumn("_again", again)
    return twice.withColumn("RevisionNumber", (F.col("RevisionNumber") + F.col("_again")).cast("smallint")).withColumn("ModifiedDate", F.when(F.col("_again") == 1, F.col("ModifiedDate") + days(1)).otherwise(F.col("ModifiedDate"))).drop("_again")


#: The same mappings for the oracle: CTEs ``d`` (lines), ``dl`` (latest lines) and ``h`` (orders).
SOURCE_SQL = """
d AS (
  SELECT CAST(l_orderkey AS INTEGER) AS SalesOrderID, CAST(l_orderkey * 10 + l_linenumber AS INTEGER) AS SalesOrderDetailID,
         CAST(NULL AS VARCHAR) AS CarrierTrackingNumber,
         CASE WHEN l_orderkey % 101 = 0 THEN CAST(0 AS SMALLINT) ELSE CAST(l_quantity AS SMALLINT) END AS OrderQty,
         CASE WHEN l_orderkey % 103 = 0 THEN NULL ELSE CAST(l_partkey AS INTEGER) END AS ProductID,
         CAST(l_suppkey AS INTEGER) AS SpecialOfferID, CAST(l_extendedprice AS DECIMAL(19,4)) AS UnitPrice,
         CASE WHEN l_orderkey % 107 = 0 THEN CAST(1.5 AS DECIMAL(19,4)) ELSE CAST(l_discount AS DECIMAL(19,4)) END AS UnitPriceDiscount,
         CAST(CAST(l_extendedprice AS DECIMAL(12,4)) * (CAST(1 AS DECIMAL(6,4)) - CAST(l_discount AS DECIMAL(6,4))) * CAST(l_quantity AS SMALLINT) AS DECIMAL(38,6))
           + CASE WHEN l_orderkey % 137 = 0 THEN 1 ELSE 0 END AS LineTotal,
         l_shipdate AS ModifiedDate, l_tax, l_returnflag, l_linestatus
  FROM lineitem
), dl AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY SalesOrderDetailID ORDER BY ModifiedDate DESC NULLS LAST, LineTotal DESC NULLS LAST, ProductID DESC NULLS LAST,
    SpecialOfferID DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn FROM d) WHERE rn = 1
), h1 AS (
  SELECT CAST(o_orderkey AS INTEGER) AS SalesOrderID, CASE WHEN o_orderkey % 109 = 0 THEN NULL ELSE o_orderdate END AS OrderDate,
         CASE WHEN o_orderkey % 113 = 0 THEN o_orderdate - INTERVAL 5 DAY ELSE o_orderdate + INTERVAL 7 DAY END AS DueDate,
         CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderkey % 127 = 0 THEN o_orderdate - INTERVAL 2 DAY ELSE o_orderdate + INTERVAL 5 DAY END AS ShipDate,
         CAST(CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'O' THEN 1 ELSE 2 END AS SMALLINT) AS Status, CAST(o_custkey AS INTEGER) AS CustomerID,
         CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_totalprice AS DECIMAL(19,4)) ELSE coalesce(CAST(lines AS DECIMAL(19,4)), CAST(0 AS DECIMAL(19,4))) END AS SubTotal,
         CAST(0 AS DECIMAL(19,4)) AS TaxAmt, CAST(CASE WHEN o_orderkey % 131 = 0 THEN -25 ELSE 0 END AS DECIMAL(19,4)) AS Freight,
         CAST(o_totalprice AS DECIMAL(19,4)) AS TotalDue, o_orderdate AS day
  FROM orders LEFT JOIN (SELECT SalesOrderID AS id, sum(LineTotal) AS lines FROM dl GROUP BY SalesOrderID) ON o_orderkey = id
), h AS (
  SELECT * EXCLUDE (day), CAST(1 AS SMALLINT) AS RevisionNumber, day AS ModifiedDate FROM h1
  UNION ALL
  SELECT * EXCLUDE (day), CAST(2 AS SMALLINT), day + INTERVAL 1 DAY FROM h1 WHERE SalesOrderID % 139 = 0
)"""
