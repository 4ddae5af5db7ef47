"""SimHash near-duplicates with a Gray-order hierarchical index (operator 9).

A fingerprint bit is set if it is set in over half of the hashes (XXH64, seed 42) of the text's runs of three words.
Documents link if at most ``RADIUS`` bits differ, and a component is what links reach.

Only distinct fingerprints are compared. Of ``RADIUS + 2`` blocks of bits at least two are equal in a linked pair, so
the fingerprints go to one partitioning for each choice of two blocks, keyed by their bits. Inside a key they are sorted
by Gray rank and indexed: a leaf is a fingerprint, a node stands for up to ``FANOUT`` consecutive children and keeps
the bits they share (mask and pattern), each level only those that the level above has not yet factored out. A search
goes down from the root, adds up the differing bits of each node's own mask and drops whole nodes once the sum is over
the radius. What leaves a task is one edge per fingerprint to the least of its task-local component, never all pairs.

A key with more than ``LIMIT`` fingerprints is refined exactly: what is equal is fixed, the bits left are cut into
blocks again, and so on; for a radius of 2, at most 256 distinct fingerprints can share a key after three steps. So no
task ever holds an unbounded group, whatever the copies. (A greater radius has more tables and is refined once.)
The index takes code words of any length: the pipeline's near-duplicate stage uses it over 256 bits.

Defined results: a null text is the empty text; without words the fingerprint is zero and linked like any other;
repeated rows each give their row; a null doc_id links with nothing and has a null component_id; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import connected_components, documents, settle, ship, shuffle_partitions, slices, table, union_all, whole_groups

RADIUS = 2
LIMIT = 4096
FANOUT = 8
_PIECE = 1 << 15


def _remixed(h: np.ndarray, count: int) -> np.ndarray:
    """(n, count): the hashes and further ones made of them by the finalizer of SplitMix64."""
    out = np.empty((len(h), count), np.uint64)
    out[:, 0] = h
    for k in range(1, count):
        z = h + np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1)
        z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        out[:, k] = z ^ z >> np.uint64(31)
    return out


def word_hashes(text: str, words_in_run: int) -> tuple[int, Iterator[int]]:
    """How many word runs the text has, and their hashes."""
    import xxhash

    words = text.encode("utf-8").lower().split()  # of bytes: only A-Z changes, and only ASCII white space divides
    n = len(words) - words_in_run + 1
    if n < 1:
        runs = iter([b" ".join(words)] if words else [])
        n = len(words[:1])
    else:
        runs = map(b" ".join, zip(*(words[k:] for k in range(words_in_run)), strict=False))
    return n, map(xxhash.xxh64_intdigest, runs, repeat(42))


def fingerprint(text: str, words_in_run: int = 3) -> int:
    return int(sketch(text, words_in_run, 1)[0])


def sketch(text: str, words_in_run: int, count: int) -> np.ndarray:
    """The fingerprint and ``count`` - 1 further ones."""
    n, hashes = word_hashes(text, words_in_run)
    votes = np.zeros(64 * count, np.int64)
    for at in range(0, n, _PIECE):
        h = np.fromiter(hashes, np.uint64, min(_PIECE, n - at))
        bits = np.unpackbits(_remixed(h, count).view(np.uint8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    return np.packbits(votes * 2 > n, bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, words_in_run: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed 64-bit integer) of each row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t or "", words_in_run) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": pa.array(found.view(np.int64), pa.int64())})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a code word in Gray order, as a signed integer that sorts like the unsigned one."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _choices(bits: list[int], radius: int) -> list[list[int]]:
    """For each choice of two of ``radius + 2`` blocks of ``bits``, the bits chosen."""
    n = radius + 2
    blocks = [bits[len(bits) * k // n : len(bits) * (k + 1) // n] for k in range(n)]
    return [a + b for a, b in combinations(blocks, 2)]


def _levels(radius: int) -> list[list[list[int]]]:
    """Of each level the masks of each group of the level above; a mask holds the masks above it."""
    masks, out, depth = [[]], [], 3 if radius <= 2 else 2
    for _ in range(depth):
        out.append([[m + c for c in _choices([b for b in range(64) if b not in m], radius)] for m in masks])
        masks = [m for group in out[-1] for m in group]
    return out


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


class GrayIndex:
    """The hierarchical index over groups of code words, each group sorted by Gray rank; one root per group.

    ``words``: a row for each 64 bits of the code, a column for each code word.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray):
        self.words, n = words, words.shape[1]
        sizes = np.diff(np.append(starts, n))
        all_of = none_of = words
        #: Bottom up: pattern, shared mask, children (first, one past the last) and one past the last leaf of each node.
        self.levels = []
        place, count, upto = np.arange(n) - np.repeat(starts, sizes), sizes, np.arange(1, n + 1)
        while count.max(initial=1) > 1 or not self.levels:
            opens = np.flatnonzero(place % FANOUT == 0)
            closes = np.append(opens[1:], len(place))
            all_of = np.bitwise_and.reduceat(all_of, opens, axis=1)
            none_of = np.bitwise_or.reduceat(none_of, opens, axis=1)
            upto = upto[closes - 1]
            self.levels.append((all_of, ~(all_of ^ none_of), opens, closes, upto))
            place = place[opens] // FANOUT
            count = -(-count // FANOUT)

    def pairs(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, other, bits apart) of all pairs within the radius, each once (other after query)."""
        q, node, apart = queries, roots, np.zeros(len(queries), np.int64)
        done = np.zeros((len(self.words), len(queries)), np.uint64)  # bits that the levels above have settled
        for pattern, mask, first, last, upto in reversed(self.levels):
            own = mask[:, node]
            apart = apart + np.bitwise_count((self.words[:, q] ^ pattern[:, node]) & own & ~done).sum(0, dtype=np.int64)
            keep = (apart <= radius) & (upto[node] > q + 1)
            q, node, apart, done = q[keep], node[keep], apart[keep], (done | own)[:, keep]
            width = last[node] - first[node]
            ends = np.cumsum(width)
            child = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - width, width) + np.repeat(first[node], width)
            if first is not self.levels[0][2]:
                apart, done = np.repeat(apart, width), np.repeat(done, width, axis=1)
            q, node = np.repeat(q, width), child
        keep = node > q
        q, node = q[keep], node[keep]
        apart = np.zeros(len(q), np.int64)
        for word in self.words:  # of whole code words, word by word
            apart = apart + np.bitwise_count(word[q] ^ word[node])
            keep = apart <= radius
            q, node, apart = q[keep], node[keep], apart[keep]
        return q, node, apart


def found_within(words: np.ndarray, starts: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs (positions, bits apart) in the radius, a few queries at a time, so they fit in memory even if all are alike."""
    index = GrayIndex(words, starts)
    n = words.shape[1]
    sizes = np.diff(np.append(starts, n))
    roots = np.repeat(np.arange(len(starts)), sizes)
    work = np.cumsum(np.repeat(sizes, sizes))
    at, most = 0, (1 << 20) // len(words)
    while at < n:
        upto = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + most, "right")))
        yield index.pairs(np.arange(at, upto), roots[at:upto], radius)
        at = upto


def linked(fp: np.ndarray, starts: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the first position of its component inside its group."""
    labels = np.arange(len(fp))
    for a, b, _ in found_within(fp[None], starts, radius):
        labels = settle(labels, a, b)
    return labels


def _search(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 2):
            path, key, fp, rep = (rows.column(k).to_numpy() for k in range(4))
            opens = np.append(True, (path[1:] != path[:-1]) | (key[1:] != key[:-1]))
            alone = opens & np.append(opens[1:], True)
            fp, rep, opens = fp[~alone].view(np.uint64), rep[~alone], opens[~alone]
            if not len(fp):
                continue
            labels = linked(fp, np.flatnonzero(opens), radius)
            a = np.flatnonzero(labels != np.arange(len(fp)))
            yield pa.RecordBatch.from_pydict({"a": pa.array(rep[a], pa.int64()), "b": pa.array(rep[labels[a]], pa.int64())})

    return run


def links(classes: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """Edges (a, b) between ``rep`` of ``classes`` (fp, rep; fp distinct) whose components are those of all links."""
    carried = ["fp", "rep"]
    spark = classes.sparkSession
    ship(spark)
    found, levels = [], _levels(radius)
    rows = classes.withColumn("path", F.lit(0))
    for depth, groups in enumerate(levels):
        width = len(groups[0])
        arrays = F.array(*[F.array(*[F.lit(_signed(m)).cast("long") for m in group]) for group in groups])
        chosen = F.element_at(arrays, F.col("path") + 1)
        spread = rows.select(*carried, "path", F.posexplode(chosen).alias("choice", "mask"))
        key = F.col("fp").bitwiseAND(F.col("mask")).alias("key")
        spread = spread.select("mask", key, *carried, (F.col("path") * width + F.col("choice")).alias("path"))
        if depth:  # the first level is read twice from the written classes, a refined one would redo its joins
            spread = table(spread, "gray-keys")
        small = spread
        if depth + 1 < len(levels):
            hot = table(spread.groupBy("path", "key").count().where(F.col("count") > limit).select("path", "key"), "gray-hot")
            if not hot.isEmpty():
                small, rows = spread.join(hot, ["path", "key"], "left_anti"), spread.join(hot, ["path", "key"], "left_semi")
                rows = rows.select(*carried, "path")
            else:
                rows = None
        dealt = small.select(F.col("path").cast("long").alias("path"), "key", *carried, gray_rank(F.col("fp")).alias("gray"))
        dealt = dealt.repartition(shuffle_partitions(spark), "path", "key").sortWithinPartitions("path", "key", "gray")
        found.append(dealt.drop("gray").mapInArrow(_search(radius), "a long, b long"))
        if depth + 1 == len(levels) or rows is None:
            break
    return union_all(found)


def components(prints: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """doc_id, fp, component_id of each row of ``prints`` (doc_id, fp), which is read more than once."""
    classes = table(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "gray-classes")
    parts = connected_components(links(classes, radius, limit)).withColumnRenamed("node", "rep")
    named = classes.join(parts, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    # Copies make hot fingerprints: a left join lets adaptive execution split the hot side.
    out = prints.join(named, "fp", "left")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hexadecimal), component_id of each row."""
    found = components(table(fingerprints(docs), "gray-prints"), radius)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
