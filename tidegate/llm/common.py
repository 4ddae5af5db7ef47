"""Shared pieces of the text operators: shipping code, scratch tables, components, worker caches."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Give every executor this package, once per Spark context (a cluster need not have it installed)."""
    context = spark.sparkContext
    if getattr(context, "_tidegate_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tidegate-"), "tidegate_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(_PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(_PACKAGE.parent))
    context.addPyFile(archive)
    context._tidegate_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``); a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        # A path without a scheme is on the cluster's default file system for every reader, Arrow included.
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(configured.rstrip("/"))
        whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
        return re.sub(r"^file:/(?!/)", "file:///", whole)
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    made = getattr(spark.sparkContext, "_tidegate_scratch", None)
    if made is None:
        made = spark.sparkContext._tidegate_scratch = f"file://{tempfile.mkdtemp(prefix='tidegate-scratch-')}"
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/tidegate-{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through Hadoop's file system, so any store works."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def forget_at_end(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that is there when the application ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read the table back. It is deleted when the application ends."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    forget_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, component) of every node on an edge, component being the smallest node reachable.

    Alternating large-star and small-star steps over ``edges(a, b)``: every step is an aggregate (with map-side
    combine) and a join, so nothing is gathered on the driver or in one task. Each round is written to the shared
    folder. An empty edge table gives an empty result; nulls and self-edges are ignored.
    """
    spark = edges.sparkSession

    def star(both: DataFrame, large: bool) -> DataFrame:
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        joined = both.join(low, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def both_ways(e: DataFrame) -> DataFrame:
        return e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = table(
        edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = state(current)
    for _ in range(rounds):
        if not seen[0]:
            break
        grown = star(both_ways(current), True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        after = table(star(grown, False), "edges")
        now = state(after)
        current = after
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


#: A cut is safe where a character that no library calls white space stands before a blank or a line end: no
#: pre-token of the byte-level pattern spans such a place, and its only look-ahead stays on one side.
SAFE_CHUNK = re.compile(r"(?s).[^ \n]*(?:(?<=\s)[ \n]+[^ \n]*)*")


_SPACES = [chr(c) for c in range(0x3001) if c != 32 and re.match(r"\s", chr(c))]


def _blank_after_space(text: str) -> bool:
    """Whether a blank stands behind white space, where it is no safe cut."""
    return "  " in text or any(f"{c} " in text for c in _SPACES if c in text)


class ChunkMemo:
    """Bytes of each text, put together from a bounded memo of its chunks between safe cuts.

    ``compute`` maps a list of chunks to their bytes. Texts without a blank behind other white space, nearly all, are
    cut at every blank, and their parts (but the first) stand for chunks that begin with that blank; other texts are
    cut by ``SAFE_CHUNK``. The memo has two generations: when the young one is full it becomes the old one, and what is
    used again moves over. Parts over ``longest`` characters are never kept.
    """

    def __init__(self, compute: Callable[[list[str]], list[bytes]], limit: int = 500_000, longest: int = 200):
        self.compute, self.limit, self.longest = compute, limit, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        first: list[list[str]] = []
        cut: list[list[str]] = []
        for text in texts:
            if _blank_after_space(text):
                first.append(SAFE_CHUNK.findall(text))
                cut.append([])
            else:
                parts = text.split(" ")
                first.append(parts[:1])
                cut.append(parts[1:])
        unseen = []
        for part in set().union(*cut).difference(young):
            value = old.get(part)
            if value is None:
                unseen.append(part)
            else:
                young[part] = value
        others = list(set().union(*first).difference(("",)))
        made = self.compute([f" {part}" for part in unseen] + others)
        young.update(zip(unseen, made, strict=False))
        other = dict(zip(others, made[len(unseen) :], strict=True)) | {"": b""}
        out = [b"".join([*map(other.__getitem__, a), *map(young.__getitem__, b)]) for a, b in zip(first, cut, strict=True)]
        for part in unseen:
            if len(part) > self.longest:
                del young[part]
        return out


def slices(batches: Iterator, most_bytes: int = 4 << 20) -> Iterator:
    """Cut Arrow batches by bytes, so a batch of long texts never sits in memory beside its results."""
    for batch in batches:
        rows = batch.num_rows
        pieces = max(1, min(rows, -(-batch.nbytes // most_bytes)))
        step = -(-rows // pieces) if rows else 1
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def whole_groups(batches: Iterator, keys: int, rows: int = 1 << 16) -> Iterator:
    """Arrow tables of about ``rows`` rows that never cut a group; the input is sorted by its first ``keys`` columns."""
    import numpy as np
    import pyarrow as pa

    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        together = pa.Table.from_batches(held)
        changed = np.zeros(n - 1, bool)
        for k in range(keys):
            values = together.column(k).to_numpy()
            changed |= values[1:] != values[:-1]
        last = np.flatnonzero(changed)
        if len(last):
            cut = int(last[-1]) + 1
            yield together.slice(0, cut)
            rest = together.slice(cut)
            held, n = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held)


def settle(labels, a, b):
    """Labels (smallest position) after joining positions ``a[i]`` and ``b[i]``."""
    import numpy as np

    while len(a):
        low = np.minimum(labels[a], labels[b])
        np.minimum.at(labels, labels[a], low)
        np.minimum.at(labels, labels[b], low)
        while (deeper := labels[labels]).tobytes() != labels.tobytes():
            labels = deeper
        open_ = labels[a] != labels[b]
        a, b = a[open_], b[open_]
    return labels
