"""Near-duplicate embeddings by randomised-rotation binary codes with correction factors (operator 8).

A unit vector is turned by a seeded random rotation and stored as the signs of its coordinates (one bit each), one
correction factor, its inner product with the vector that the signs stand for, and a rounding to ``PLANES`` bits for its
part as a query. From the code of one vector and the rounding of the other, bit counts give an unbiased estimate of the
inner product of the two. Its error shrinks with the root of 1 - product squared, so the factor bounds it for all pairs
at the threshold or above. A pair whose upper bound is below the threshold is dropped; every other pair is recomputed
exactly in double precision, so nothing below the threshold links.

Codes are made once and meet in hash tables, each keyed by ``bits`` of further seeded rotations. Bits grow with the
logarithm of the rows, so a key's expected rows do not grow, and tables follow from the recall aimed at for the worst
pair, one exactly at the threshold. Only codes are dealt to the tables; vectors are fetched for rows that have a pair
left. A pair that meets in several tables counts in the first only, which the full keys of both tell, so no list of
pairs is ever made: a task sends on, per vector, its number of links and one edge. A key with more than ``LIMIT`` vectors
is cut into blocks whose pairs are compared in separate tasks.

Equal vectors (by two hashes of 64 bits with seeds of their own) are compared once; their copies count as links. Defined
results: vectors that are null, empty, zero or hold null or non-finite components link with nothing (component_id =
vec_id); vectors of different lengths never link; rows that share a vec_id each have their own vector's links; a null
vec_id gives 0 links, null component_id and kept false; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import connected_components, settle, ship, shuffle_partitions, table, whole_groups

THRESHOLD = 0.9
RECALL = 0.95
LIMIT = 4096
#: Standard deviations of the estimate's error that the confidence bound allows for.
SIGMAS = 4.0
SEED = 8
PLANES = 6
#: Above the number of tables, a power of two: the last bits of a group's name tell its table.
_TABLES = 1 << 13


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def plan(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a key, tables) for so many distinct vectors."""
    bits = min(48, max(6, math.ceil(math.log2(max(rows, 2))) - 7))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log1p(-agree))


def keys(units: np.ndarray, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """A row of ``tables`` integer keys for each unit vector."""
    dim = units.shape[1]
    need = bits * tables
    turned = np.concatenate([units @ rotation(dim, seed + 1 + k) for k in range(-(-need // dim))], 1)[:, :need] > 0
    return turned.reshape(len(units), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def stored(dim: int, tables: int) -> np.dtype:
    """What is kept of a vector of that length: factor, code, range and bit planes of its rounding, and its keys."""
    words = -(-dim // 64)
    return np.dtype([("factor", "<f8"), ("low", "<f8"), ("step", "<f8"), ("code", "<u8", (words,)), ("planes", "<u8", (PLANES, words)), ("keys", "<u8", (tables,))])


def _packed(bits: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros((len(bits), words * 64), np.uint8)
    out[:, : bits.shape[1]] = bits
    return np.packbits(out, axis=1, bitorder="little").view("<u8")


def encode(units: np.ndarray, own: np.ndarray, seed: int = SEED) -> np.ndarray:
    """The stored form of unit vectors with the keys ``own``."""
    n, dim = units.shape
    turned = units @ rotation(dim, seed)
    out = np.zeros(n, stored(dim, own.shape[1]))
    out["factor"] = np.abs(turned).sum(1) / math.sqrt(dim)
    words = out["code"].shape[1]
    out["code"] = _packed(turned > 0, words)
    low, high = turned.min(1, keepdims=True), turned.max(1, keepdims=True)
    out["low"], out["step"] = low[:, 0], ((high - low) / (2**PLANES - 1))[:, 0]
    step = np.where(out["step"] > 0, out["step"], 1.0)[:, None]
    dither = np.random.default_rng([seed, 4]).random((1, dim))
    level = np.clip(np.floor((turned - low) / step + dither), 0, 2**PLANES - 1).astype(np.uint8)
    for k in range(PLANES):
        out["planes"][:, k] = _packed(level >> k & 1, words)
    out["keys"] = own
    return out


class Codes:
    """Bounds of inner products from stored forms of vectors of length ``dim``."""

    def __init__(self, held: np.ndarray, dim: int):
        self.dim, self.factor, self.low, self.step = dim, held["factor"], held["low"], held["step"]
        self.code, self.keys = np.ascontiguousarray(held["code"]), held["keys"]
        self.planes = [np.ascontiguousarray(held["planes"][:, k]) for k in range(PLANES)]
        self.total = sum(np.bitwise_count(p).sum(1).astype(np.int64) << k for k, p in enumerate(self.planes))
        self.ones = np.bitwise_count(self.code).sum(1).astype(np.int64)
        # Of the estimate itself, and of the rounding (at most one step in each coordinate).
        f2 = np.clip(self.factor**2, 1e-9, 1.0)
        self.error = SIGMAS * np.sqrt((1 - f2) / f2 / max(1, dim - 1))
        self.rounding = SIGMAS * self.step / 2

    def upper(self, data: np.ndarray, query: np.ndarray, threshold: float = 0.0) -> np.ndarray:
        """Upper confidence bound of inner products of ``threshold`` or more: binary code of one, rounding of the other."""
        met = np.zeros(len(data), np.int64)
        for k, plane in enumerate(self.planes):
            met += np.bitwise_count(self.code[data] & plane[query]).sum(1).astype(np.int64) << k
        signs = self.step[query] * (2 * met - self.total[query]) + self.low[query] * (2 * self.ones[data] - self.dim)
        estimate = signs / math.sqrt(self.dim) / self.factor[data]
        return estimate + self.error[data] * math.sqrt(1 - threshold**2) + self.rounding[query] / self.factor[data]


def _units(rows: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as unit vectors in double precision."""
    flat = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    values = values / np.abs(values).max(1, keepdims=True)  # no overflow or underflow in the squares
    return values / np.sqrt((values * values).sum(1, keepdims=True))


def _pairs_inside(starts: np.ndarray, n: int) -> np.ndarray:
    """For each position the number of later positions in its group."""
    sizes = np.diff(np.append(starts, n))
    return np.repeat(starts + sizes, sizes) - np.arange(n) - 1


def left_over(codes: Codes, ends: np.ndarray, side: np.ndarray, number: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (a, b) of pairs that the codes cannot drop and whose first common table is theirs.

    ``ends``: one past the last row of each row's group; ``side``: 0 if a row's group is one block, else 1 or 2 for the
    two blocks compared; ``number``: the table in which the rows meet.
    """
    n, at = len(ends), 0
    width = ends - np.arange(n) - 1
    upto = np.cumsum(width)
    while at < n:
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + (1 << 18), "right")))
        w = width[at:stop]
        a = np.repeat(np.arange(at, stop), w)
        b = np.arange(len(a)) - np.repeat(np.cumsum(w) - w, w) + a + 1
        keep = (side[a] == 0) | (side[a] != side[b])
        a, b = a[keep], b[keep]
        keep = codes.upper(a, b, threshold) >= threshold
        a, b = a[keep], b[keep]
        keep = (codes.keys[a] == codes.keys[b]).argmax(1) == number[a]
        yield a[keep], b[keep]
        at = stop


def _groups(batches: Iterator[pa.RecordBatch], tables: int):
    """Of rows (home, length, side, rep, code, ...): the table, ends of groups, table numbers and codes, groups of one left out."""
    for rows in whole_groups(batches, 2, 1 << 15):
        home, length = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        for dim in np.unique(length):
            mine = length == dim
            own = home[mine]
            opens = np.append(True, own[1:] != own[:-1])
            alone = opens & np.append(opens[1:], True)
            if alone.all():
                continue
            mine[mine] = ~alone
            kept, opens = rows.filter(pa.array(mine)), opens[~alone]
            held = np.frombuffer(b"".join(kept.column(4).to_pylist()), stored(int(dim), tables))
            n = len(held)
            ends = np.arange(n) + 1 + _pairs_inside(np.flatnonzero(opens), n)
            yield kept, ends, kept.column(0).to_numpy() & _TABLES - 1, Codes(held, int(dim))


def _with_pairs(threshold: float, tables: int):
    """The rows (home, length, side, rep) that have a pair left over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ends, number, codes in _groups(batches, tables):
            some = np.zeros(rows.num_rows, bool)
            for a, b in left_over(codes, ends, rows.column(2).to_numpy(), number, threshold):
                some[a] = some[b] = True
            if some.any():
                yield from rows.select([0, 1, 2, 3]).filter(pa.array(some)).to_batches()

    return run


def _links(threshold: float, tables: int):
    """Of rows (home, length, side, rep, code, copies, vector) each vector's links in its group, and one edge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ends, number, codes in _groups(batches, tables):
            side, rep, copies, units = rows.column(2).to_numpy(), rows.column(3).to_numpy(), rows.column(5).to_numpy(), _units(rows.column(6))
            count, labels = np.zeros(len(rep), np.int64), np.arange(len(rep))
            for a, b in left_over(codes, ends, side, number, threshold):
                keep = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
                a, b = a[keep], b[keep]
                np.add.at(count, a, copies[b])
                np.add.at(count, b, copies[a])
                labels = settle(labels, a, b)
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict({"rep": pa.array(rep[some], pa.int64()), "links": pa.array(count[some], pa.int64()), "low": pa.array(rep[labels[some]], pa.int64())})

    return run


def coded(reps: DataFrame, bits: int, tables: int) -> DataFrame:
    """rep, length, code (see ``stored``) and homes (a name for each table's key) of (rep, embedding)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column(1).offsets.to_numpy()) if batch.num_rows else np.zeros(0, int)
            for length in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == length)))
                units = _units(part.column(1))
                own = keys(units, bits, tables)
                code = encode(units, own)
                homes = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * tables, pa.int32()), pa.array(own.reshape(-1), pa.int64()))
                data = pa.array([x.tobytes() for x in code], pa.binary())
                yield pa.RecordBatch.from_pydict({"rep": part.column(0), "length": pa.array(np.full(len(own), length), pa.int32()), "code": data, "own": homes})

    return reps.select("rep", "embedding").mapInArrow(run, "rep long, length int, code binary, own array<long>")


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, limit: int = LIMIT) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of (vec_id, embedding)."""
    spark = vectors.sparkSession
    ship(spark)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))
    # A hash of several values is seeded by those before, so the second one is no function of the first.
    marks = vectors.withColumn("h1", F.when(usable, F.xxhash64("embedding"))).withColumn("h2", F.when(usable, F.xxhash64(F.lit(1), "embedding")))
    classes = marks.where("h1 is not null").groupBy("h1", "h2").agg(F.min("vec_id").alias("low_id"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding"))
    classes = table(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    bits, tables = plan(classes.count(), threshold, recall)
    assert tables <= _TABLES
    codes = table(coded(classes, bits, tables), "vector-codes")

    def keyed(some: DataFrame) -> DataFrame:
        spread = some.select("rep", "length", "code", F.posexplode("own").alias("number", "key"))
        home = F.xxhash64("key", "number").bitwiseAND(F.lit(-_TABLES)).bitwiseOR(F.col("number").cast("long"))
        return spread.select(home.alias("home"), "length", "rep", "code")

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition(shuffle_partitions(spark), "home").sortWithinPartitions("home", "length")

    # Which keys are cut is told from a sample: that changes the work of a task but no pair.
    every, rows, no_side = max(1, limit // 32), keyed(codes), F.lit(0).cast("long").alias("side")
    sampled = keyed(codes.where(F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(every)) == 0)).groupBy("home", "length").count()
    hot = table(sampled.where(F.col("count") * every > limit).select("home", "length", F.ceil(F.col("count") * every / limit).alias("blocks")), "vector-hot")
    if hot.isEmpty():
        dealt = rows.select("home", "length", no_side, "rep", "code")
    else:
        # Block pairs (i, j), i <= j: a row of block r takes part in (r, x) and (x, r).
        own, other = F.col("own"), F.col("other")
        blocks = rows.join(hot, ["home", "length"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        pair = F.xxhash64("home", F.least(own, other), F.greatest(own, other)).bitwiseAND(F.lit(-_TABLES)).bitwiseOR(F.col("home").bitwiseAND(F.lit(_TABLES - 1)))
        side = F.when(own == other, 0).when(own < other, 1).otherwise(2).cast("long").alias("side")
        dealt = rows.join(hot, ["home", "length"], "left_anti").select("home", "length", no_side, "rep", "code").union(blocks.select(pair.alias("home"), "length", side, "rep", "code"))
    left = table(together(dealt).mapInArrow(_with_pairs(threshold, tables), "home long, length int, side long, rep long"), "vector-pairs")
    whole = left.join(codes.select("rep", "code"), "rep").join(classes.select("rep", "copies", "embedding"), "rep").select("home", "length", "side", "rep", "code", "copies", "embedding")
    found = table(together(whole).mapInArrow(_links(threshold, tables), "rep long, links long, low long"), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("rep").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "rep")
    named = classes.drop("embedding").join(counts, "rep", "left").join(parts, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = table(named, "vector-named")
    least = named.groupBy("component").agg(F.min("low_id").alias("part"))
    named = named.join(least, "component").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "part")
    out = marks.drop("embedding").join(named, ["h1", "h2"], "left")
    component = F.coalesce("part", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
