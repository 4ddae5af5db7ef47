"""Document fingerprints by SimHash, in DataFrame and SQL functions only (operator 3).

Terms are runs of three lower-cased words (fewer words: all of them as one term), weighted by how often they occur. The
64-bit hash of a term votes on every bit of the fingerprint; a bit is set if more than half the weight votes for it.
Two counters share a 64-bit sum, so a term costs 32 additions inside generated code; partial sums leave the map side.

``within`` finds all fingerprints in a Hamming radius of stated queries: fingerprints are cut into ``radius + 3``
blocks, at least three of which are equal in any two fingerprints within the radius, so one permuted table for each
choice of three blocks, keyed by their bits, holds every answer. Only distinct fingerprints enter the tables.

Defined results: every row gives its row; a null text is the empty text; a text without words has fingerprint 0. Rows
are in order by doc_id, nulls first, then by the MD5 of their text; of rows that repeat doc_id and text each is
followed by the next one, and after the last row comes the first. An empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.common import documents, shuffle_partitions, table

BITS = 64
RADIUS = 3


def terms(words: Column) -> Column:
    """Hashes of the runs of three words in an array of words."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    few = F.when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", words))))
    return F.when(n >= 3, runs).otherwise(F.coalesce(few, F.array().cast("array<bigint>")))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and fingerprint (a 64-bit integer) of each row; ``keys`` tell the rows apart."""
    words = texts.select(*keys, F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("_words"))
    hashed = words.select(*keys, F.explode_outer(terms(F.col("_words"))).alias("_h"))
    pair = F.lit(1 | 1 << 32)
    votes = [F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(pair)).alias(f"_v{i}") for i in range(32)]
    summed = hashed.groupBy(*keys).agg(F.count("_h").alias("_n"), *votes)
    half = F.col("_n") / 2
    bits = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"_v{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"_v{i}"), 32)
        bits = bits.bitwiseOR(F.when(low > half, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
        at = (1 << (i + 32)) - (1 << 64 if i == 31 else 0)
        bits = bits.bitwiseOR(F.when(high > half, F.lit(at).cast("long")).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, bits.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def masks(radius: int) -> list[int]:
    """Bits of each permuted table as a signed 64-bit integer."""
    cuts = [BITS * k // (radius + 3) for k in range(radius + 4)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for m in (sum(c) for c in combinations(blocks, 3))]


def within(queries: DataFrame, classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """query, fingerprint, distance: for each distinct ``queries.fingerprint`` all of ``classes`` in the radius."""

    def keyed(df: DataFrame) -> DataFrame:
        keys = F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks(radius)])
        return df.select("fingerprint", F.posexplode(keys).alias("table", "key"))

    sought = keyed(queries.select("fingerprint").distinct()).withColumnRenamed("fingerprint", "query")
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint")))
    met = keyed(classes.select("fingerprint").distinct()).join(sought, ["table", "key"]).where(distance <= radius)
    return met.select("query", "fingerprint", distance.alias("distance")).distinct()


def followers(ids: DataFrame) -> DataFrame:
    """The columns of ``ids`` (unique id and raw), ``key`` (their number in order, with gaps) and ``next``, the id, raw
    and key of the following row, after the last the first.

    Rows are range-partitioned; inside a partition the next row is a lead, at its end it is the first row of the next
    partition, which a table of one row per partition tells.
    """
    parts, order = shuffle_partitions(ids.sparkSession), [F.col("id").asc_nulls_first(), F.col("raw")]
    ranged = ids.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id().cast("long"))
    inside = Window.partitionBy("_part").orderBy(*order)
    ranged = table(ranged, "followers").withColumn("key", F.col("_part") * (1 << 40) + F.row_number().over(inside))
    me = F.struct("id", "raw", "key")
    ranged = table(ranged.withColumn("_lead", F.lead(me).over(inside)), "followers-inside")
    firsts = ranged.groupBy("_part").agg(F.min_by(me, "key").alias("_first"))
    first_of_all = F.min_by("_first", "_part").over(Window.partitionBy(F.lit(1)))
    firsts = firsts.select("_part", F.coalesce(F.lead("_first").over(Window.orderBy("_part")), first_of_all).alias("_first"))
    return ranged.join(firsts, "_part").select(*ids.columns, "key", F.coalesce("_lead", "_first").alias("next"))


def edited_fingerprints(docs: DataFrame, radius: int = RADIUS, query_every: int = 100) -> DataFrame:
    """See the module; ``n_within`` of a row whose id ``query_every`` divides counts the other rows in the radius."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("raw"), text.alias("text"))
    ids = table(plain.groupBy("id", "raw").agg(F.count("*").alias("n"), F.max(F.length("text")).cast("long").alias("n_chars")), "fingerprint-ids")
    if not ids.where("n > 1").isEmpty():
        plain = plain.dropDuplicates(["id", "raw"])
    chain = table(followers(ids), "fingerprint-chain")
    # Of n equal rows n - 1 are followed by themselves, so such rows have two edited texts.
    me = F.struct("id", "raw", "key")
    chain = chain.withColumn("_after", F.explode(F.when(F.col("n") > 1, F.array(F.struct(F.col("next"), F.lit(1).cast("long").alias("times")), F.struct(me.alias("next"), (F.col("n") - 1).alias("times")))).otherwise(F.array(F.struct(F.col("next"), F.lit(1).cast("long").alias("times"))))))
    chain = chain.select("id", "raw", "key", "n_chars", "_after.*")

    def same(name: str) -> Column:
        return F.col("id").eqNullSafe(F.col(f"{name}_id")) & (F.col("raw") == F.col(f"{name}_raw"))

    # Both joins look for rows of ``plain`` by id and raw, so its texts are shuffled once, and the heads to where they are added.
    half = F.floor(F.col("n_chars") / 2).cast("int").alias("half")
    following = chain.select(F.col("next.id").alias("next_id"), F.col("next.raw").alias("next_raw"), F.col("id").alias("own_id"), F.col("raw").alias("own_raw"), "key", F.col("next.key").alias("next"), "times", "n_chars", half)
    heads = plain.join(following, same("next")).select("own_id", "own_raw", "key", "next", "times", "n_chars", "half", F.expr("substring(text, 1, half)").alias("head"))
    joined = plain.join(heads, same("own")).select("id", "key", "next", "times", "half", "n_chars", "text", "head")
    edited = F.concat(F.expr("substring(text, 1, length(text) - half)"), F.col("head"))
    both = joined.select("id", "key", "next", "times", "n_chars", "text", edited.alias("edited"))
    keys = ["id", "key", "next", "times", "n_chars", "edited_sha256"]
    both = both.select(*keys[:-1], F.sha2("edited", 256).alias("edited_sha256"), F.posexplode(F.array("text", "edited")).alias("which", "text"))
    found = fingerprints(both, [*keys, "which"])
    of = lambda which: F.max(F.when(F.col("which") == which, F.col("fingerprint")))
    rows = table(found.groupBy(*keys).agg(of(0).alias("fingerprint"), of(1).alias("edited")), "fingerprints")

    following = rows.select(F.col("key").alias("next"), F.col("fingerprint").alias("next_fingerprint")).dropDuplicates(["next"])
    out = rows.join(following, "next")
    asked = F.coalesce(F.col("id") % query_every == 0, F.lit(False))
    copies = rows.groupBy("fingerprint").agg(F.sum("times").alias("copies"))
    counts = within(rows.where(asked), copies, radius).join(copies, "fingerprint").groupBy(F.col("query").alias("fingerprint")).agg((F.sum("copies") - 1).alias("_within"))
    out = out.join(counts, "fingerprint", "left").withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return out.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_hex(F.col("fingerprint")).alias("fingerprint"),
        as_hex(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.when(asked, F.col("_within")).alias("n_within"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))
