"""Entities of the incremental load: their schemas, keys, windows and latest rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY, TOTAL = T.DecimalType(19, 4), T.DecimalType(38, 6)
STAMP, INT, SHORT, TEXT = T.TimestampNTZType(), T.IntegerType(), T.ShortType(), T.StringType()

_KINDS = {"long": T.LongType(), "int": INT, "string": TEXT, "double": T.DoubleType(), "boolean": T.BooleanType()}


def schema_of(text: str) -> T.StructType:
    """Of columns written as ``name kind, name kind``; needs no session."""
    return T.StructType([T.StructField(n, _KINDS[k], True) for n, k in (c.split() for c in text.split(", "))])


HEADER_COLUMNS = {
    "SalesOrderID": INT, "RevisionNumber": SHORT, "OrderDate": STAMP, "DueDate": STAMP, "ShipDate": STAMP, "Status": SHORT, "OnlineOrderFlag": T.BooleanType(),
    "SalesOrderNumber": TEXT, "PurchaseOrderNumber": TEXT, "AccountNumber": TEXT, "CustomerID": INT, "SalesPersonID": INT, "TerritoryID": INT, "BillToAddressID": INT,
    "ShipToAddressID": INT, "ShipMethodID": INT, "SubTotal": MONEY, "TaxAmt": MONEY, "Freight": MONEY, "TotalDue": MONEY, "Comment": TEXT, "ModifiedDate": STAMP,
}
DETAIL_COLUMNS = {
    "SalesOrderID": INT, "SalesOrderDetailID": INT, "CarrierTrackingNumber": TEXT, "OrderQty": SHORT, "ProductID": INT, "SpecialOfferID": INT,
    "UnitPrice": MONEY, "UnitPriceDiscount": MONEY, "LineTotal": TOTAL, "ModifiedDate": STAMP,
}


@dataclass(frozen=True)
class Entity:
    """A source table with explicit columns, its key, its watermark column and the order that makes a latest row."""

    name: str
    columns: dict
    key: str
    nullable: frozenset
    latest: tuple[str, ...]
    watermark: str = "ModifiedDate"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.columns.items()])

    def extract(self, source: DataFrame, start: Column, stop: Column) -> DataFrame:
        """Named columns of the half-open window; the filter reaches the scan."""
        return source.where((F.col(self.watermark) >= start) & (F.col(self.watermark) < stop)).select(*self.columns)

    def latest_rows(self, rows: DataFrame) -> DataFrame:
        """One row per key: the last modified, ties by all other columns, so the choice never depends on row order."""
        rest = [c for c in rows.columns if c not in (self.key, *self.latest)]
        order = [F.col(c).desc_nulls_last() for c in (*self.latest, *rest) if c in rows.columns]
        return rows.withColumn("_n", F.row_number().over(Window.partitionBy(self.key).orderBy(*order))).where("_n = 1").drop("_n")


HEADER = Entity("SalesOrderHeader", HEADER_COLUMNS, "SalesOrderID", frozenset(["ShipDate", "PurchaseOrderNumber", "AccountNumber", "SalesPersonID", "TerritoryID", "Comment"]), ("ModifiedDate", "RevisionNumber"))
DETAIL = Entity("SalesOrderDetail", DETAIL_COLUMNS, "SalesOrderDetailID", frozenset(["CarrierTrackingNumber"]), ("ModifiedDate", "LineTotal", "ProductID", "SpecialOfferID"))
ENTITIES = (HEADER, DETAIL)


def stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")
