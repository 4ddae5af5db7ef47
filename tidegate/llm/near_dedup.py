"""Near-duplicate documents by SimHash candidates and the likeness of their word runs (the pipeline's use of operator 9).

Documents link if their different runs of five words have a likeness (shared over all) of ``LIKE`` or more. The search
goes over 256 bits, four fingerprints of remixed hashes. Documents of one order of words (a digest of 128 bits) are one
class; classes meet in permuted tables, each keyed by some of the bits. Keys grow with the logarithm of the classes, so
a key's expected number of rows doesn't grow; the tables follow from the recall aimed at for a pair exactly at ``LIKE``.
Inside a key the Gray-order index drops whole nodes by their accumulated differences, and what differs in at most
``NEAR_BITS`` bits is a candidate. The word runs themselves decide over every candidate.

A task hands on a spanning forest of its candidates, those of the fewest bits first, and each group of candidates from which
it left pairs out. So a key of n rows gives n - 1 edges at most, however many of them are candidates. After those are tested,
a group whose members are all in one part needs no more. The members of the others meet once more with their texts, and all their candidates between different parts
are tested where they meet, each under the first key that both share, so no row is made for a pair (``tested_in_cells``). A
key with more than ``LIMIT`` rows is cut into blocks: the first search compares inside blocks only and counts the key as a
group with pairs left out. Later a key of more than ``CELL`` rows is cut into blocks of which each two meet, but for those
of its largest part.

Whole documents are never shuffled. A row is known by its file and its place there; what is needed of a file's rows (the
places whose text is to be tested and where, in the end the places that go) is written under that file's name and a
range of ``_RANGE`` places, and the tasks that scan the file read it there. An edge is tested at the least class that
either end has an edge with; where more than ``PIECE`` edges meet they are dealt to several tasks.

Defined results: of each group the row with the least doc_id stays (null ids last, then the least MD5 of the text; of
rows that repeat it exactly one); a null text is the empty text, alike to other texts without words; rows without a
doc_id, or of one doc_id and different texts, are documents like any others; an empty table gives no rows; all columns
are kept and names do not clash with them. Documents that are no plain scan of files are written to the shared folder.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import connected_components, forget_at_end, scratch_path, settle, ship, shuffle_partitions, slices, table, whole_groups
from tidegate.llm.simhash_gray import found_within, sketch, word_hashes
from tidegate.llm.token_files import open_store

WORDS, LIKE = 5, 0.8
RECALL = 0.97
PRINTS = 4
BITS = 64 * PRINTS
LIMIT, CELL, PIECE = 4096, 1024, 2048
SEED = 9
_RANGE = 1 << 18


def apart_at(like: float) -> float:
    """Share of the bits that differ on average between texts of a likeness: the angle between their counts over a half turn."""
    return math.acos(2 * like / (1 + like)) / math.pi


#: Three standard deviations above the bits that differ at ``LIKE``: 38.8 + 3 * 5.7.
NEAR_BITS = math.floor(BITS * apart_at(LIKE) + 3 * math.sqrt(BITS * apart_at(LIKE) * (1 - apart_at(LIKE))))


def recall_of(bits: int, tables: int, like: float = LIKE, near_bits: int = NEAR_BITS) -> float:
    """Expected share of pairs of that likeness that differ in ``near_bits`` at most and share a key."""
    p, total = apart_at(like), 0.0
    for d in range(near_bits + 1):
        chance = math.exp(math.lgamma(BITS + 1) - math.lgamma(d + 1) - math.lgamma(BITS - d + 1) + d * math.log(p) + (BITS - d) * math.log1p(-p))
        agree = math.prod((BITS - d - k) / (BITS - k) for k in range(bits))
        total += chance * (1 - (1 - agree) ** tables)
    return total


def plan(classes: int, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a key, tables) for so many classes."""
    bits = min(48, max(10, math.ceil(math.log2(max(classes, 2))) - 10))
    if recall_of(bits, 1 << 40) <= recall:
        raise ValueError(f"no number of tables gives a recall of {recall} within {NEAR_BITS} bits")
    tables = 1
    while recall_of(bits, tables) < recall:
        tables += 1
    return bits, tables


def masks(bits: int, tables: int) -> np.ndarray:
    """(tables, PRINTS) words of the bits of each key: runs of seeded permutations of all bits."""
    rng, chosen = np.random.default_rng([SEED, bits]), []
    while len(chosen) < tables:
        order = rng.permutation(BITS)
        chosen += [order[k : k + bits] for k in range(0, BITS - bits + 1, bits)]
    out = np.zeros((tables, BITS), np.uint8)
    for row, at in zip(out, chosen, strict=False):
        row[at] = 1
    return np.packbits(out, axis=1, bitorder="little").view("<i8")


def words_digest(text: str) -> bytes:
    """16 bytes that tell apart texts whose words, as the runs have them, differ."""
    return hashlib.blake2b(b" ".join(text.encode("utf-8").lower().split()), digest_size=16).digest()


def runs_of(text: str, words_in_run: int = WORDS) -> np.ndarray:
    """The different hashes of the word runs, in order."""
    n, hashes = word_hashes(text, words_in_run)
    return np.unique(np.fromiter(hashes, np.uint64, n))


def share(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Likeness of two texts' ``runs_of``; 0 if their numbers alone tell that it is under ``least``."""
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) / max(len(a), len(b)) < least:
        return 0.0
    both = np.sort(np.concatenate([a, b]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


def likeness(one: str, other: str, words_in_run: int = WORDS) -> float:
    """Share of the different word runs of either text that both have; 1 for two texts without words."""
    return share(runs_of(one, words_in_run), runs_of(other, words_in_run))


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Which of the links between ``n`` positions make a minimum spanning forest; of equal ones the first come first."""
    order = np.argsort(apart, kind="stable")
    labels, chosen = np.arange(n), []
    while len(order):
        la, lb = labels[a[order]], labels[b[order]]
        order, la, lb = order[la != lb], la[la != lb], lb[la != lb]
        least = np.full(n, len(order))
        rank = np.arange(len(order))
        np.minimum.at(least, la, rank)
        np.minimum.at(least, lb, rank)
        best = order[np.unique(least[least < len(order)])]
        chosen.append(best)
        labels = settle(labels, a[best], b[best])
    return np.concatenate([np.zeros(0, np.int64), *chosen])


def candidates(words: np.ndarray, starts: np.ndarray, part: np.ndarray, near_bits: int = NEAR_BITS):
    """Positions (a, b) of a minimum spanning forest, by differing bits, of the candidates between parts; and for each
    row the group of candidates it is in, -1 where none was left out.

    ``part``: numbered from 0.
    """
    a = b = apart = np.zeros(0, np.int64)
    left, parts, full = np.zeros(len(part), bool), int(part.max(initial=-1)) + 1, 1 << 20

    def chosen() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keep = np.sort(spanning_forest(parts, part[a], part[b], apart))
        out = np.ones(len(a), bool)
        out[keep] = False
        left[a[out]] = left[b[out]] = True
        return a[keep], b[keep], apart[keep]

    for x, y, bits in found_within(words, starts, near_bits):
        met = part[x] != part[y]
        a, b, apart = np.append(a, x[met]), np.append(b, y[met]), np.append(apart, bits[met])
        if len(a) > full:  # what is chosen of a part's choice and the rest is what is chosen of all
            a, b, apart = chosen()
            full = max(full, 2 * len(a))
    a, b, _ = chosen()
    labels = settle(np.arange(parts), part[a], part[b])[part]
    group = np.where(np.isin(labels, labels[left]), labels, -1)
    return a, b, group


def _search(near_bits: int):
    """Edges (a, b), and rows (a, null, group) of the groups with pairs left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 1, 1 << 18):
            home, rep, *words = (c.to_numpy() for c in rows.columns)
            opens = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
            sizes = np.diff(np.append(opens, len(home)))
            many = np.repeat(sizes > 1, sizes)
            if not many.any():
                continue
            home, rep = home[many], rep[many]
            words = np.array([w[many] for w in words]).view(np.uint64)
            order = np.lexsort((*gray_ranks(words)[::-1], home))
            home, rep, words = home[order], rep[order], words[:, order]
            part = np.unique(rep, return_inverse=True)[1]
            starts = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
            a, b, group = candidates(words, starts, part, near_bits)
            ends = {"a": pa.array(rep[a], pa.int64()), "b": pa.array(rep[b], pa.int64())}
            yield pa.RecordBatch.from_pydict(ends | {"group": pa.nulls(len(a), pa.int64())})
            some = group >= 0
            if some.any():
                # A name that other tasks hardly share; if they do, a group looks larger than it is.
                least = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
                np.minimum.at(least, group[some], rep[some])
                named, at = np.unique(np.stack([least[group[some]] * 1_000_003 ^ home[0], rep[some]]), axis=1)
                yield pa.RecordBatch.from_pydict({"a": pa.array(at, pa.int64()), "b": pa.nulls(len(at), pa.int64()), "group": pa.array(named, pa.int64())})

    return run


def gray_ranks(words: np.ndarray) -> np.ndarray:
    """Place in Gray order of the code words that the rows of ``words`` make together, the first row leading."""
    out, odd = words.copy(), np.zeros(words.shape[1], np.uint64)
    for row in out:
        for shift in (1, 2, 4, 8, 16, 32):
            row ^= row >> np.uint64(shift)
        row ^= odd
        odd = (np.uint64(0) - (row & np.uint64(1))).astype(np.uint64)
    return out


_NAMES = tuple(f"w{k}" for k in range(PRINTS))


def keyed(classes: DataFrame, keys: np.ndarray, *carried: str) -> DataFrame:
    """``home``, ``carried`` and the words of each class under each key, and the key's number."""
    homes = [F.xxhash64(*[F.col(c).bitwiseAND(F.lit(m)) for c, m in zip(_NAMES, mask, strict=True)], F.lit(t)) for t, mask in enumerate(keys.tolist())]
    return classes.select(F.posexplode(F.array(*homes)).alias("key", "home"), *carried, *_NAMES)


def search(classes: DataFrame, keys: np.ndarray, limit: int = LIMIT, near_bits: int = NEAR_BITS) -> DataFrame:
    """Edges and groups (see ``_search``) of ``classes`` (rep and the words)."""
    spark = classes.sparkSession
    ship(spark)
    every, carried = max(1, limit // 32), ("rep", *_NAMES)
    rows = keyed(classes, keys, "rep").drop("key")
    # Which keys are cut is told from a sample: that changes the work of a task but no pair.
    sampled = keyed(classes.where(F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(every)) == 0), keys, "rep").groupBy("home").count()
    hot = table(sampled.where(F.col("count") * every > limit).select("home", F.ceil(F.col("count") * every / limit).alias("blocks")), "near-hot")
    more = None
    if hot.isEmpty():
        dealt = rows.select("home", *carried)
    else:
        cut = table(rows.join(hot, "home"), "near-cut")
        block = F.pmod(F.xxhash64("rep", "home"), F.col("blocks"))
        blocks = cut.select(F.xxhash64("home", block).alias("home"), *carried)
        more = cut.select(F.col("rep").alias("a"), F.lit(None).cast("long").alias("b"), F.col("home").alias("group"))
        dealt = rows.join(hot, "home", "left_anti").select("home", *carried).union(blocks)
    dealt = dealt.repartition(shuffle_partitions(spark), "home").sortWithinPartitions("home")
    found = dealt.mapInArrow(_search(near_bits), "a long, b long, group long")
    return found if more is None else found.union(more)


def cells(left: DataFrame, keys: np.ndarray, cell: int = CELL) -> DataFrame:
    """cell, side, key, rep, part and words of the rows of ``left`` (rep, part and the words), dealt so that each two rows
    of a key that lie in different parts meet in one cell: if their sides differ or are 0. Some 2 ``cell`` rows meet at most.
    """
    rows = table(keyed(left, keys, "rep", "part"), "near-keyed")
    sizes = rows.groupBy("home", "part").count().groupBy("home")
    sizes = sizes.agg(F.max(F.struct("count", "part")).alias("main"), F.sum("count").alias("rows")).where("rows > main.count")
    others = F.col("rows") - F.col("main.count")
    sizes = sizes.select("home", F.col("main.part").alias("main"), (F.col("rows") <= 2 * cell).alias("one"), F.ceil(F.col("main.count") / cell).alias("mains"), F.ceil(others / cell).alias("others"))
    rows = rows.join(sizes, "home")
    own = F.pmod(F.xxhash64("rep", "home"), F.when(F.col("part") == F.col("main"), F.col("mains")).otherwise(F.col("others")))

    def place(kind: int, a: Column, b: Column, side: Column) -> Column:
        return F.struct(F.xxhash64("home", F.lit(kind), a, b).alias("cell"), side.cast("long").alias("side"))

    def each(upto: str, make: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col(upto) - 1), make)

    zero = F.lit(0)
    of_main = each("others", lambda k: place(1, own, k, F.lit(1)))
    of_others = F.concat(
        each("mains", lambda k: place(1, k, own, F.lit(2))),
        each("others", lambda k: place(2, F.least(own, k), F.greatest(own, k), F.when(own == k, 0).when(own < k, 1).otherwise(2))),
    )
    places = F.when(F.col("one"), F.array(place(0, zero, zero, zero))).when(F.col("part") == F.col("main"), of_main).otherwise(of_others)
    return rows.select(F.explode(places).alias("at"), "key", "rep", "part", *_NAMES).select("at.*", "key", "rep", "part", *_NAMES)


def _untested(side: np.ndarray, key: np.ndarray, part: np.ndarray, words: np.ndarray, starts: np.ndarray, masks: np.ndarray, near_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates (positions) of a cell between parts that share no key before the cell's."""
    for x, y, bits in found_within(words, starts, near_bits):
        met = (part[x] != part[y]) & ((side[x] != side[y]) | (side[x] == 0))
        x, y, bits = x[met], y[met], bits[met]
        if len(x):
            other = words[:, x] ^ words[:, y]
            for t in range(int(key[x].max())):
                before = (t < key[x]) & ~(other & masks[t][:, None]).any(0)
                x, y, bits, other = x[~before], y[~before], bits[~before], other[:, ~before]
            order = np.argsort(bits, kind="stable")
            yield x[order], y[order]


def tested_in_cells(left: DataFrame, keys: np.ndarray, texts: Callable[[DataFrame], DataFrame], least: float = LIKE, near_bits: int = NEAR_BITS, cell: int = CELL) -> DataFrame:
    """Links (a, b) that join the parts of ``left`` (rep, part and the words) as all candidates between them would.

    The rows that have a candidate in a cell are sent there with their texts; the pairs are found again and tested there,
    until a cell's parts are joined, so rows are made for members of cells only.
    """
    spark = left.sparkSession
    ship(spark)
    bits = keys.view(np.uint64)
    columns = ("side", "key", "rep", "part", *_NAMES)

    def concerned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 1, 1 << 18):
            home = rows.column(0).to_numpy()
            words = np.array([rows.column(c).to_numpy() for c in _NAMES]).view(np.uint64)
            order = np.lexsort((*gray_ranks(words)[::-1], home))
            home, words = home[order], words[:, order]
            side, key, part = (rows.column(c).to_numpy()[order] for c in ("side", "key", "part"))
            meets = np.zeros(len(home), bool)
            for x, y in _untested(side, key, part, words, np.flatnonzero(np.append(True, home[1:] != home[:-1])), bits, near_bits):
                meets[x] = meets[y] = True
            yield from rows.take(pa.array(order[meets])).combine_chunks().to_batches()

    kind = "cell long, side long, key int, rep long, part long, " + ", ".join(f"{c} long" for c in _NAMES)
    dealt = cells(left, keys, cell).repartition(shuffle_partitions(spark), "cell").sortWithinPartitions("cell")
    rows = table(dealt.mapInArrow(concerned, kind), "near-cells")
    sent = texts(rows.select(F.col("cell").alias("home"), F.col("rep").alias("node")))
    nothing = [F.lit(None).cast("int" if c == "key" else "long").alias(c) for c in columns]
    sent = sent.select(F.col("home").alias("cell"), *[F.col("node").alias(c) if c == "rep" else x for c, x in zip(columns, nothing, strict=True)], "text")
    both = sent.union(rows.select("cell", *columns, F.lit(None).cast("string").alias("text")))

    def links(known: list[tuple], held: dict[int, np.ndarray]) -> list[tuple[int, int]]:
        side, key, rep, part = (np.array(c) for c in list(zip(*known, strict=True))[:4])
        words = np.array([k[4:] for k in known], np.int64).T.copy().view(np.uint64)
        order = np.lexsort(gray_ranks(words)[::-1])
        side, key, rep, part, words = side[order], key[order], rep[order], part[order], words[:, order]
        number = np.unique(part, return_inverse=True)[1]
        names, part_of, joined, found = rep.tolist(), number.tolist(), list(range(len(part))), []

        def root(k: int) -> int:
            while joined[k] != k:
                joined[k] = k = joined[joined[k]]
            return k

        for x, y in _untested(side, key, number, words, np.zeros(1, np.int64), bits, near_bits):
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                a, b = root(part_of[i]), root(part_of[j])
                if a != b and share(held[names[i]], held[names[j]], least) >= least:
                    found.append((names[i], names[j]))
                    joined[a] = b
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, held = None, [], {}

        def done() -> pa.RecordBatch:
            found = links(known, held) if known else []
            return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

        for batch in slices(batches):
            for home, side, key, rep, part, *words, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if home != at:
                    yield done()
                    at, known, held = home, [], {}
                if side is None:
                    if rep not in held:
                        held[rep] = runs_of(text)
                else:
                    known.append((side, key, rep, part, *words))
        yield done()

    dealt = both.repartition(shuffle_partitions(spark), "cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(run, "a long, b long")


def alike(edges: DataFrame, texts: Callable[[DataFrame], DataFrame], least: float = LIKE, words_in_run: int = WORDS, piece: int = PIECE) -> DataFrame:
    """Of ``edges`` (a, b) whose texts have a likeness of ``least`` or more enough to join what all of them join.

    ``texts`` gives home, node and text for (home, node). Each text goes once to every home in which edges of it are tested.
    """
    spark = edges.sparkSession
    ship(spark)
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = table(edges, "near-edges")
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("low"))
    placed = edges.join(lowest.select(F.col("node").alias("a"), F.col("low").alias("la")), "a").join(lowest.select(F.col("node").alias("b"), F.col("low").alias("lb")), "b")
    placed = table(placed.select("a", "b", F.least("la", "lb").alias("low")), "near-placed")
    pieces = placed.groupBy("low").agg(F.ceil(F.count("*") / piece).alias("pieces"))
    home = F.xxhash64("low", F.pmod(F.xxhash64("b"), F.col("pieces")))
    placed = table(placed.join(pieces, "low").select(home.alias("home"), "a", "b"), "near-homes")
    ends = placed.select("home", F.explode(F.array("a", "b")).alias("node")).distinct()
    sent = texts(ends).select("home", F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "text")
    rows = sent.union(placed.select("home", "a", "b", F.lit(None).cast("string").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, joined = None, {}, {}

        def root(x: int) -> int:
            while (up := joined.get(x, x)) != x:
                joined[x] = x = joined.get(up, up)
            return x

        for batch in slices(batches):
            found = []
            for home, a, b, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if home != at:
                    at, held, joined = home, {}, {}
                if b is None:
                    if a not in held:
                        held[a] = runs_of(text, words_in_run)
                elif (x := root(a)) != (y := root(b)) and share(held[a], held[b], least) >= least:
                    found.append((a, b))
                    joined[x] = y
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    # Nulls come first, so a home's texts are there before its edges.
    dealt = rows.repartition(shuffle_partitions(spark), "home").sortWithinPartitions("home", "b")
    return dealt.mapInArrow(run, "a long, b long")


def linked_classes(classes: DataFrame, texts: Callable[[DataFrame], DataFrame], recall: float = RECALL, limit: int = LIMIT, least: float = LIKE) -> DataFrame:
    """(node, component) of the ``rep`` of ``classes`` (rep and the words) that are alike to another."""
    keys = masks(*plan(classes.count(), recall))
    found = table(search(classes, keys, limit), "near-found")
    good = table(alike(found.where("b is not null").select("a", "b"), texts, least), "near-alike")
    parts = table(connected_components(good), "near-parts").withColumnRenamed("node", "rep")
    members = found.where("b is null").select(F.col("a").alias("rep"), "group").distinct()
    members = members.join(parts, "rep", "left").select("rep", "group", F.coalesce("component", "rep").alias("part"))
    members = table(members, "near-members")
    apart = members.groupBy("group").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("group")
    left = table(members.join(apart, "group", "left_semi").select("rep", "part").distinct(), "near-left")
    if not left.isEmpty():
        left = table(classes.join(left, "rep"), "near-again")
        more = table(tested_in_cells(left, keys, texts, least, cell=min(limit, CELL)), "near-more")
        parts = table(connected_components(good.union(more)), "near-joined").withColumnRenamed("node", "rep")
    return parts.withColumnRenamed("rep", "node")


class Located:
    """Rows of ``docs`` by their file (a hash of its path) and place in it."""

    def __init__(self, docs: DataFrame):
        if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
            docs = table(docs, "near-documents")
        at = docs.metadataColumn("_metadata")
        self.docs, self.at = docs, [F.xxhash64(at["file_path"]).alias("file"), at["row_index"].alias("row")]

    def texts(self) -> DataFrame:
        """file, row, id, raw (MD5 of the text) and text of each row."""
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        return self.docs.select(*self.at, F.col("doc_id").cast("long").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("raw"), text.alias("text"))

    def fetch(self, wanted: DataFrame) -> DataFrame:
        """home, node and text of the rows ``wanted`` (file, row, home, node), which may name a row several times."""
        folder = _by_file(wanted)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            notes = _Notes(folder)
            for batch in batches:
                file, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for note, mine in notes.about(file, row):
                    order = mine[np.argsort(row[mine], kind="stable")]
                    places = note.column("row").to_numpy()
                    at = np.searchsorted(row[order], places)
                    at[at == len(order)] = 0
                    here = np.flatnonzero(row[order][at] == places)
                    for k in range(0, len(here), 1024):  # texts may be long and go to many homes
                        part = pa.array(here[k : k + 1024])
                        told = note.take(part)
                        text = batch.column(2).take(pa.array(order[at[here[k : k + 1024]]]))
                        yield pa.RecordBatch.from_arrays([told.column("home").combine_chunks(), told.column("node").combine_chunks(), text], ["home", "node", "text"])

        return self.docs.select(*self.at, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, "home long, node long, text string")

    def without(self, gone: DataFrame) -> DataFrame:
        """The documents but those ``gone`` (file, row)."""
        folder, schema = _by_file(gone), self.docs.schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            notes = _Notes(folder)
            for batch in batches:
                whole = batch.column(0)
                file, row = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                stays = np.ones(len(row), bool)
                for note, mine in notes.about(file, row):
                    stays[mine] = ~np.isin(row[mine], note.column("row").to_numpy())
                kept = whole.filter(pa.array(stays))
                yield pa.RecordBatch.from_arrays(kept.flatten(), schema.names)

        if len(set(schema.names)) < len(schema.names):
            raise ValueError("columns of one name")
        own = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in schema.names])
        return self.docs.select(own.alias("own"), *self.at).mapInArrow(run, schema)


def _by_file(notes: DataFrame) -> str:
    """Write rows that have columns ``file`` and ``row`` to a folder for each file and range; returns the folder above."""
    folder = scratch_path(notes.sparkSession, "near-notes")
    notes = notes.withColumn("part", F.floor(F.col("row") / _RANGE).cast("long"))
    notes.repartition(shuffle_partitions(notes.sparkSession), "file", "part").write.partitionBy("file", "part").parquet(folder)
    forget_at_end(notes.sparkSession, folder)
    return folder


class _Notes(dict):
    """What is written for a file and range, in order of rows, read when first asked for; None if nothing is."""

    def __init__(self, folder: str):
        super().__init__()
        self.folder = folder

    def __missing__(self, name: tuple[int, int]) -> pa.Table | None:
        from pyarrow import fs
        from pyarrow import parquet as pq

        store, root = open_store(self.folder)
        found = [x.path for x in store.get_file_info(fs.FileSelector(f"{root}/file={name[0]}/part={name[1]}", allow_not_found=True)) if x.path.endswith(".parquet")]
        if len(self) >= 4:
            self.clear()
        self[name] = out = pa.concat_tables([pq.ParquetFile(store.open_input_file(p)).read() for p in found]).sort_by("row") if found else None
        return out

    def about(self, file: np.ndarray, row: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray]]:
        """The notes that some of a batch's rows may be in, and which rows those are."""
        part = row // _RANGE
        for name in np.unique(file).tolist():
            own = file == name
            for k in np.unique(part[own]).tolist():
                if (note := self[name, k]) is not None:
                    yield note, np.flatnonzero(own & (part == k))


def sketches(texts: DataFrame) -> DataFrame:
    """file, row, id, raw, digest of the words and the 256 bits of each row of ``Located.texts``; a narrow map."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(4).to_pylist()
            found = np.array([sketch(t, WORDS, PRINTS) for t in texts], np.uint64).reshape(-1, PRINTS).T.copy().view(np.int64)
            words = {c: pa.array(x, pa.int64()) for c, x in zip(_NAMES, found, strict=True)}
            known = {c: batch.column(k) for k, c in enumerate(("file", "row", "id", "raw"))}
            yield pa.RecordBatch.from_pydict(known | {"digest": pa.array(map(words_digest, texts), pa.binary())} | words)

    return texts.mapInArrow(run, "file long, row long, id long, raw binary, digest binary, " + ", ".join(f"{c} long" for c in _NAMES))


def one_of_each(docs: DataFrame, least: float = LIKE, recall: float = RECALL, limit: int = LIMIT) -> DataFrame:
    """The rows of ``docs`` that stay (see the module), with all their columns."""
    ship(docs.sparkSession)
    located = Located(docs)
    each = table(sketches(located.texts()), "near-sketches")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "raw", "file", "row")
    classes = each.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("rows"), *[F.min(c).alias(c) for c in _NAMES])
    classes = table(classes.withColumn("rep", F.monotonically_increasing_id()), "near-classes")
    firsts = classes.select(F.col("rep").alias("node"), "first.file", "first.row")
    parts = linked_classes(classes.select("rep", *_NAMES), lambda ends: located.fetch(ends.join(firsts, "node")), recall, limit, least)
    named = classes.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("digest", "first", "rows", F.coalesce("component", "rep").alias("component"), F.col("component").isNotNull().alias("linked"))
    # Of a class that is one row and alike to no other nothing goes.
    several = table(named.where("linked or rows > 1"), "near-several")
    kept = several.groupBy("component").agg(F.min("first").alias("kept"))
    several = several.join(kept, "component").select("digest", F.col("kept.file").alias("k_file"), F.col("kept.row").alias("k_row"))
    gone = each.select("digest", "file", "row").join(several, "digest").where("file <> k_file OR row <> k_row").select("file", "row")
    return located.without(gone)
