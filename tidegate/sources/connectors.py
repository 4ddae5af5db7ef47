"""Sources of the entities: Parquet folders or tables behind JDBC, read with explicit columns and types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.tsql import quoted
from tidegate.sources.entities import ENTITIES, Entity

Source = Callable[[str], DataFrame]


class Drift(ValueError):
    """A source table lacks a column that the entity names."""


def typed(rows: DataFrame, entity: Entity) -> DataFrame:
    """The entity's columns (names in any case) and types; a missing column is an error, further ones are ignored."""
    there = {c.lower(): c for c in rows.columns}
    missing = [c for c in entity.columns if c.lower() not in there]
    if missing:
        raise Drift(f"{entity.name} has no column {', '.join(missing)}")
    return rows.select(*[F.col(quoted(there[c.lower()])).cast(t).alias(c) for c, t in entity.columns.items()])


def parquet_source(spark: SparkSession, folder: str) -> Source:
    """``folder`` holds ``<entity>.parquet`` or ``<entity>`` for each entity; filters reach its scan."""
    known = {e.name: e for e in ENTITIES}
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def read(name: str) -> DataFrame:
        paths = [f"{folder.rstrip('/')}/{name}{end}" for end in (".parquet", "")]
        found = [p for p in paths if (at := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(at)]
        if not found:
            raise FileNotFoundError(f"no table {name} in {folder}")
        return typed(spark.read.parquet(found[0]), known[name])

    return read


def jdbc_source(spark: SparkSession, url: str, user: str, password: str, driver: str = "", partitions: int = 8, tables: dict[str, str] | None = None, fetch: int = 10_000) -> Source:
    """Tables behind JDBC (by default named as the entities), read in ``partitions`` ranges of their key.

    The range's ends come from one aggregate that the database runs. The window's filter and the columns are pushed down.
    """
    known = {e.name: e for e in ENTITIES}
    dialect = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    options = {"url": url, "user": user, "password": password, "fetchsize": str(fetch)} | ({"driver": driver} if driver else {})

    def read(name: str) -> DataFrame:
        entity, table = known[name], (tables or {}).get(name, name)
        key = dialect.quoteIdentifier(entity.key)
        ends = spark.read.format("jdbc").options(**options).option("query", f"SELECT MIN({key}) AS a, MAX({key}) AS b FROM {table}").load().first()
        reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
        if ends[0] is not None and ends[1] > ends[0]:
            reader = reader.options(partitionColumn=entity.key, lowerBound=str(ends[0]), upperBound=str(ends[1]), numPartitions=str(partitions))
        return typed(reader.load(), entity)

    return read
