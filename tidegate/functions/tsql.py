"""Scalar helpers with the semantics of the SQL dialect that the rules and checks were written for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat(*parts: Column | str) -> Column:
    """Null parts count as empty text."""
    return F.concat_ws("", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts])


def minutes_between(start: Column, stop: Column) -> Column:
    """Minute boundaries crossed, not whole minutes elapsed."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", stop))


def seconds_between(start: Column, stop: Column) -> Column:
    return (F.timestamp_diff("MILLISECOND", start, stop) / 1000).cast("decimal(12,3)")


def iso(value: Column) -> Column:
    """ISO text with milliseconds only where there are any."""
    return F.regexp_replace(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSS"), r"\.000$", "")


def percent(part: Column, whole: Column) -> Column:
    """Four decimals; 0 where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(F.lit(100.0) * part / whole, 4))


def holds(predicate: Column) -> Column:
    """UNKNOWN does not hold."""
    return F.coalesce(predicate, F.lit(False))


def quoted(name: str) -> str:
    """An identifier that may hold any character."""
    return "`" + name.replace("`", "``") + "`"
