"""Mixing sources to target weights by capped water-filling (operator 7).

Every source asks for its weight's share of the mix; a source that would be read more than ``max_epochs`` times is held
at that, and what it leaves is shared among the others by weight until none is above. The level where this settles has
a closed form: in the order of size over weight, the sources held are a prefix of all sources.

A document is taken ``floor(target / source_size)`` whole times, and once more if it is in the seeded draw that fills
the fraction left: the draw goes through a source's documents in the order of a seeded hash until the goal is nearest,
so a source misses its target by less than one document. Where the draw ends is one hash per source, found in two
levels: running totals over (source, hash bucket), then over the documents of the one bucket in which a source's goal
lies. So no source is sorted in one task, and each document's repeats follow from its own row and its source's.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a source of size 0 has
target 0 and nothing of it is taken; rows with equal doc_id in a source are taken alike; an empty table gives no rows;
extra columns are ignored (``repeated`` keeps all columns of its input).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.common import documents, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = (3, 2)
MAX_EPOCHS = 2
SEED = "mix-1"
BUCKET_HEX = 4


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """Place of a document in its source's seeded order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size (words), draw: the narrow table that everything else is made from."""
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), draw(F.col("doc_id"), seed).alias("draw"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target of each source. The windows see one row per source."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight)
    whole = Window.partitionBy(F.lit(1))
    before = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    # In units of 1 / share[1] words: what the sources from here on share if all before are held.
    left = F.sum("source_size").over(whole) * share[0] - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * (share[1] * max_epochs)
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = ranked.withColumn("left", left).withColumn("weight_left", weight_left)
    free = F.col("left") * F.col("weight") <= F.col("source_size") * (share[1] * max_epochs) * F.col("weight_left")
    levels = levels.withColumn("free", free)
    # Weights are positive, so of the free sources the first has the greatest weight left.
    levels = levels.withColumn("level", F.max(F.when(F.col("free"), F.struct("weight_left", "left"))).over(whole))
    shared = (F.col("level.left") * F.col("weight")).cast("double") / (F.col("level.weight_left") * share[1]).cast("double")
    return levels.select("source", "source_size", F.when(F.col("free"), shared).otherwise((F.col("source_size") * max_epochs).cast("double")).alias("target"))


def plan(sized: DataFrame, **options) -> DataFrame:
    """source, source_size, target, whole (repeats of every document), until (the last draw taken once more; null: none)."""
    goals = targets(sized, **options)
    some = F.col("source_size") > 0
    goals = goals.withColumn("whole", F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goals = table(goals.withColumn("goal", F.when(some, F.col("target") - F.col("whole") * F.col("source_size")).otherwise(F.lit(0.0))), "mix-goals")
    bucket = F.substring("draw", 1, BUCKET_HEX)
    before = F.coalesce(F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("bucket_size")).withColumn("before", before)
    g = goals.select(F.col("source").alias("g_source"), "goal")
    last = (
        buckets.join(g, F.col("source").eqNullSafe(F.col("g_source")))
        .where("before < goal")
        .groupBy("source")
        .agg(F.max(F.struct("bucket", "before", "goal")).alias("last"))
        .select(F.col("source").alias("l_source"), "last.*")
    )
    inside = sized.join(last, F.col("source").eqNullSafe(F.col("l_source")) & (bucket == F.col("bucket")))
    drawn = inside.groupBy("source", "draw", "before", "goal").agg(F.sum("size").alias("size"))
    sofar = F.col("before") + F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = drawn.withColumn("sofar", sofar).where("2 * sofar + size < 2 * goal").groupBy("source").agg(F.max("draw").alias("in_bucket"))
    ends = last.join(taken.withColumnRenamed("source", "t_source"), F.col("l_source").eqNullSafe(F.col("t_source")), "left")
    # Where none of the bucket is taken, the draw ends just below the bucket.
    ends = ends.select("l_source", F.coalesce("in_bucket", "bucket").alias("until"))
    return table(
        goals.join(ends, F.col("source").eqNullSafe(F.col("l_source")), "left").select("source", "source_size", "target", "whole", "until"), "mix-plan"
    )


def repeats() -> Column:
    """Of a row with its source's plan and its own draw."""
    return F.col("whole") + F.coalesce((F.col("draw") <= F.col("until")).cast("long"), F.lit(0))


def with_plan(rows: DataFrame, made: DataFrame) -> DataFrame:
    made = made.withColumnRenamed("source", "plan_source")
    return rows.join(made, rows["source"].eqNullSafe(made["plan_source"])).drop("plan_source")


def mix(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """doc_id, size, source_size, target, repeats, taken of each row."""
    sized = table(sizes(docs, seed), "mix-sizes")
    rows = with_plan(sized, plan(sized, **options)).withColumn("repeats", repeats())
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def repeated(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, with its own columns."""
    made = plan(table(sizes(docs, seed), "mix-sizes"), **options).select(F.col("source").alias("p_source"), F.col("whole"), F.col("until"))
    own = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])
    rows = docs.select(own.alias("own"), F.col("source").alias("source"), draw(F.col("doc_id"), seed).alias("draw"))
    rows = rows.join(made, F.col("source").eqNullSafe(F.col("p_source"))).withColumn("times", repeats()).where("times > 0")
    return rows.select("own", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("own.*")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents
), ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS BIGINT) AS weight
  FROM sized GROUP BY source
), lefts AS (
  SELECT a.source, a.source_size, a.weight,
         3 * (SELECT sum(source_size) FROM ranked) - 4 * coalesce(sum(b.source_size), 0) AS left_over,
         (SELECT sum(weight) FROM ranked) - coalesce(sum(b.weight), 0) AS weight_left
  FROM ranked a LEFT JOIN ranked b
    ON b.source_size / b.weight < a.source_size / a.weight
       OR (b.source_size / b.weight = a.source_size / a.weight AND (b.source < a.source OR (a.source IS NULL AND b.source IS NOT NULL)))
  GROUP BY a.source, a.source_size, a.weight
), levels AS (
  SELECT *, left_over * weight <= 4 * source_size * weight_left AS free FROM lefts
), targets AS (
  SELECT source, source_size,
         CASE WHEN free
              THEN CAST((SELECT arg_max(left_over, weight_left) FROM levels WHERE free) * weight AS DOUBLE)
                   / CAST((SELECT max(weight_left) FROM levels WHERE free) * 2 AS DOUBLE)
              ELSE CAST(2 * source_size AS DOUBLE) END AS target
  FROM levels
), goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
), drawn AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.whole,
         CASE WHEN g.source_size > 0 THEN g.target - g.whole * g.source_size ELSE 0.0 END AS goal,
         s.source, s.draw
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), running AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar FROM drawn
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN 2 * sofar + size < 2 * goal THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running
"""
