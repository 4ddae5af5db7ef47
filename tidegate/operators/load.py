"""Upsert as a full-outer join that makes the next snapshot, with the action taken for every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.sources.entities import DETAIL, Entity


def upsert(existing: DataFrame, incoming: DataFrame, entity: Entity, first_only: tuple[str, ...] = ()) -> DataFrame:
    """All columns and ``_action``: INSERT, UPDATE (at least as new), STALE (older: the old row stays) or KEEP.

    Both sides have unique keys (``Entity.latest_rows``). Columns ``first_only`` keep the old row's value. One shuffle by key.
    """
    columns = [c for c in existing.columns]
    old, new = F.struct(*[F.col(c) for c in columns]).alias("old"), F.struct(*[F.col(c) for c in columns]).alias("new")
    left = existing.select(F.col(entity.key).alias("_k"), old)
    right = incoming.select(F.col(entity.key).alias("_k"), new)
    both = left.join(right, "_k", "full_outer")
    mark = entity.watermark
    action = F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "KEEP").when(F.col(f"new.{mark}") >= F.col(f"old.{mark}"), "UPDATE").otherwise("STALE")
    chosen = F.when(action.isin("INSERT", "UPDATE"), F.col("new")).otherwise(F.col("old"))
    held = both.select(action.alias("_action"), chosen.alias("row"), F.struct(*[F.col(f"old.{c}") for c in first_only]).alias("_old") if first_only else F.lit(None).alias("_old"))
    picked = [F.coalesce(f"_old.{c}", f"row.{c}").alias(c) if c in first_only else F.col(f"row.{c}") for c in columns]
    return held.select(*picked, "_action")


def with_parent(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines whose header is in the warehouse; the others are held back."""
    return lines.join(headers.select("SalesOrderID"), "SalesOrderID", "left_semi")


def tallies() -> list[Column]:
    """Aggregates over upserted rows: how many were inserted, updated, stale, and loaded."""
    n = lambda *a: F.coalesce(F.sum(F.col("_action").isin(*a).cast("long")), F.lit(0))
    return [n("INSERT").alias("rows_inserted"), n("UPDATE").alias("rows_updated"), n("STALE").alias("rows_stale"), n("INSERT", "UPDATE").alias("rows_loaded")]


def counts(upserted: DataFrame) -> DataFrame:
    return upserted.agg(*tallies())


__all__ = ["DETAIL", "counts", "tallies", "upsert", "with_parent"]
