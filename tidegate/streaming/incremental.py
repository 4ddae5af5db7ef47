"""Arrivals as a stream: every micro-batch of staged rows goes through the same rules, parent test and upsert as a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import load, rules
from tidegate.sources.entities import DETAIL, HEADER, Entity, schema_of
from tidegate.sources.store import BUCKET, Store, bucket_of

REJECTED = schema_of("batch long, entity_name string, business_key string, rejection_reason string, rejection_detail string, row_payload string")
BATCHES = schema_of("batch long, entity_name string, rows_staged long, rows_loaded long, rows_rejected long, rows_waiting long, rows_superseded long, failed_checks string")


def tables_of(clean: str) -> tuple[str, str, str]:
    """Names of the tables beside ``clean``: rejected rows, lines without a header yet, the log of batches."""
    return f"{clean}_rejected", f"{clean}_waiting", f"{clean}_batches"


def available_now(spark: SparkSession, folder: str, store: Store, entity: Entity, as_of: str, checkpoint: str, clean: str, parents: str | None = None, buckets: int = 32) -> None:
    """Load what has arrived in ``folder`` (Parquet of the entity's columns) and stop; a repeated batch changes nothing.

    Rejected rows are kept with their rule; lines whose header is not in the table ``parents`` wait and come again with
    the next batch; of rows of one key all but the latest are counted as superseded. The log's row of a batch, written in
    the same commit, holds these counts (staged = loaded + rejected + waiting + superseded + stale) and the rules that failed.
    """
    bad_table, waiting_table, log_table = tables_of(clean)

    def apply(batch: DataFrame, number: int) -> None:
        done = store.table(log_table, BATCHES)
        if not done.where(F.col("batch") == number).isEmpty():
            return  # the batch was committed before the stream's own progress was
        at = store.manifest()["number"]
        rows = batch.select(*entity.columns)
        if entity is DETAIL and parents:
            rows = rows.unionByName(store.table(waiting_table, entity.schema))
        staged = rows.persist()
        found = rules.evaluate(staged, entity, as_of).persist()
        try:
            failed = [r["check_name"] for r in rules.results(found, entity).where("bad_rows > 0").collect()]
            bad = rules.rejected_in_detail(found, entity, list(entity.columns)).select(F.lit(number).cast("long").alias("batch"), "*")
            good, waiting = entity.latest_rows(rules.survivors(found)), None
            latest = good.count()
            if entity is DETAIL and parents:
                known = store.table(parents, HEADER.schema)
                waiting = good.join(known.select("SalesOrderID"), "SalesOrderID", "left_anti").select(*entity.columns)
                good = load.with_parent(good, known)
            good = good.withColumn(BUCKET, bucket_of(entity.key, buckets)).persist()
            touched = sorted(r[0] for r in good.select(BUCKET).distinct().collect())
            old = store.table(clean, entity.schema, touched)
            merged = load.upsert(old, good.select(old.columns), entity).persist()
            n, rejected = load.counts(merged).first(), found.where("first_rule is not null").count()
            total, passed = found.count(), good.count()
            row = (number, entity.name, total, n["rows_loaded"], rejected, latest - passed, total - rejected - latest, ", ".join(sorted(failed)))
            tables = {waiting_table: waiting} if waiting is not None else {}
            log = spark.createDataFrame([row], BATCHES)
            store.commit(tables, at, {bad_table: bad.select(REJECTED.names), log_table: log}, {clean: merged.drop("_action").withColumn(BUCKET, bucket_of(entity.key, buckets))})
            good.unpersist()
            merged.unpersist()
        finally:
            found.unpersist()
            staged.unpersist()

    stream = spark.readStream.schema(entity.schema).parquet(folder)
    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
