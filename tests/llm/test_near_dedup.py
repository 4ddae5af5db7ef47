"""The near-duplicate stage against brute force over the likeness of word runs, and on odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import near_dedup, simhash_gray
from tidegate.llm.common import settle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def edited(words, edits, rnd):
    copy = list(words)
    for place in edits if isinstance(edits, list) else rnd.sample(range(len(words)), edits):
        copy[place] = f"e{rnd.random()}"
    return " ".join(copy)


def all_likenesses(texts):
    runs = [near_dedup.runs_of(t, 5) for t in texts]
    at = {r: k for k, r in enumerate(np.unique(np.concatenate(runs)).tolist())}
    has = np.zeros((len(runs), len(at)), np.float32)
    for k, r in enumerate(runs):
        has[k, [at[x] for x in r.tolist()]] = 1
    common = has @ has.T
    return common / (has.sum(1)[:, None] + has.sum(1)[None] - common)


def kept_ids(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r["doc_id"] for r in near_dedup.one_of_each(docs, **options).collect()}


def test_spanning_forest_joins_what_links_join_by_the_closest():
    rnd = np.random.default_rng(3)
    for n, m in ((1, 0), (6, 0), (30, 25), (40, 300)):
        a = rnd.integers(0, n, m)
        b = (a + rnd.integers(1, max(n, 2), m)) % n
        apart = rnd.integers(0, 6, m)
        keep = near_dedup.spanning_forest(n, a, b, apart)
        label, weight, links = list(range(n)), 0, 0
        for k in sorted(range(m), key=lambda k: (apart[k], k)):  # one link at a time
            x, y = label[a[k]], label[b[k]]
            if x != y:
                label = [x if z == y else z for z in label]
                weight, links = weight + apart[k], links + 1
        assert len(keep) == len(set(keep.tolist())) == links and apart[keep].sum() == weight


def test_index_over_many_words_finds_all_pairs():
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 1 << 63, (4, 12), dtype=np.uint64)
    words = np.repeat(base, 40, axis=1)
    for k in range(words.shape[1]):
        for bit in rnd.choice(256, rnd.integers(0, 40), replace=False):
            words[bit // 64, k] ^= np.uint64(1 << int(bit % 64))
    home = np.sort(rnd.integers(0, 5, words.shape[1]))
    order = np.lexsort((*near_dedup.gray_ranks(words)[::-1], home))
    words, home = words[:, order], home[order]
    starts = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
    apart = np.bitwise_count(words[:, :, None] ^ words[:, None, :]).sum(0, dtype=np.int64)
    expected = {(a, b): apart[a, b] for a, b in zip(*np.nonzero((apart <= 55) & (home[:, None] == home[None])), strict=True) if a < b}
    found = [(a, b, d) for x, y, z in simhash_gray.found_within(words, starts, 55) for a, b, d in zip(x.tolist(), y.tolist(), z.tolist(), strict=True)]
    assert len(found) == len(expected) > 1000 and all(expected[a, b] == d for a, b, d in found)
    ranks = near_dedup.gray_ranks(np.array([[0, 0, 1, 1], [0, 1, 0, 1]], np.uint64))
    assert ranks.tolist() == [[0, 0, 1, 1], [0, 1, (1 << 64) - 1, (1 << 64) - 2]]


def test_tables_follow_from_the_recall():
    for classes in (10, 40_000, 12_000_000, 10**10):
        bits, tables = near_dedup.plan(classes)
        keys = near_dedup.masks(bits, tables)
        assert near_dedup.recall_of(bits, tables) >= 0.97 and keys.shape == (tables, 4)
        assert (np.bitwise_count(keys.view(np.uint64)).sum(1) == bits).all()
    with pytest.raises(ValueError):
        near_dedup.plan(1000, 0.9999)


def test_likeness_decides(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(30):
        words = [f"w{rnd.randrange(900)}" for _ in range(150)]
        rows += [(len(rows) + k, edited(words, edits, rnd)) for k, edits in enumerate((0, 1, 3, 6, 12))]
    rows += [(len(rows) + k, t) for k, t in enumerate(["", " ", "one two", "One  two", "one three", "x " * 50_000, rows[0][1], rows[1][1]])]
    near = np.array([[near_dedup.likeness(x, y) >= 0.8 for _, y in rows] for _, x in rows])
    brute = set(settle(np.arange(len(rows)), *np.nonzero(near)).tolist())
    kept = kept_ids(spark, rows, recall=0.995)
    assert near.sum() - len(rows) > 80 and brute <= kept and len(kept - brute) <= 2
    every = spark.createDataFrame([(x, y) for x in range(40) for y in range(40)], "a long, b long")
    nodes = spark.createDataFrame(rows, "node long, text string")
    texts = lambda ends: ends.join(nodes, "node")
    found = {(r["a"], r["b"]) for r in near_dedup.alike(every, texts, piece=8).collect()}
    assert all(x < y and near[x, y] for x, y in found)
    joined = settle(np.arange(len(rows)), *(np.array(x) for x in zip(*found, strict=True)))
    inside = near.copy()
    inside[40:] = inside[:, 40:] = False
    assert (joined == settle(np.arange(len(rows)), *np.nonzero(inside))).all()
    assert near_dedup.likeness("a b c", "a b  C") == 1 and near_dedup.likeness("", " ") == 1 and near_dedup.likeness("a", "") == 0
    assert near_dedup.alike(every.limit(0), texts).count() == 0


@pytest.mark.parametrize("limit", [4096, 64])
def test_copies_find_their_base_among_closer_ones(spark, limit):
    """700 copies alike to one base only; each other pair is a candidate of about 0.71. Against brute force."""
    rnd = random.Random(21)
    words = [f"w{rnd.randrange(90_000)}" for _ in range(500)]
    rows = [(0, " ".join(words))] + [(k, edited(words, [55 * p + rnd.randrange(50) for p in range(9)], rnd)) for k in range(1, 701)]
    near = all_likenesses([t for _, t in rows]) >= 0.8
    assert near[0].all() and near.sum() < 3.1 * len(rows)
    prints = np.array([simhash_gray.sketch(t, 5, 4) for _, t in rows])
    met = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2, dtype=int) <= near_dedup.NEAR_BITS
    keyed = np.zeros(met.shape, bool)
    for mask in near_dedup.masks(*near_dedup.plan(len(rows))).view(np.uint64):
        key = prints & mask
        keyed |= (key[:, None] == key[None]).all(2)
    # The same whatever the limit: what candidates by brute force join.
    assert kept_ids(spark, rows, limit=limit) == set(settle(np.arange(len(rows)), *np.nonzero(near & met & keyed)).tolist())


def test_texts_equal_in_all_bits_are_compared(spark):
    rnd = random.Random(31)
    filler = [". . . . . " * 80, "one two three four five\n" * 400]
    texts = [filler[k % 2] + " ".join(f"w{rnd.random()}" for _ in range(300)) for k in range(20)]
    rows = [*enumerate(texts), (20, texts[4].upper()), (21, texts[7] + " tail")]
    assert len({simhash_gray.sketch(t, 5, 4).tobytes() for t in texts}) == 2
    assert kept_ids(spark, rows) == set(range(20))


def test_lone_pairs_near_the_threshold_are_found(spark):
    """Recall of 0.95 or more at likeness 0.80 to 0.82, over 600 pairs; clean documents stay."""
    rnd = random.Random(41)
    rows = []
    for k in range(600):  # 8 of 396 words edited: a likeness of 0.81
        words = [f"v{rnd.randrange(90_000)}" for _ in range(396)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, edited(words, [44 * p + 10 + rnd.randrange(20) for p in range(8)], rnd))]
    assert 0.8 <= near_dedup.likeness(rows[0][1], rows[1][1]) < 0.82
    kept = kept_ids(spark, rows)
    print("lone pairs missed:", len(kept) - 600, "of 600")
    assert set(range(0, 1200, 2)) <= kept and len(kept) - 600 <= 0.05 * 600


def test_odd_rows(spark):
    long = "abc" * 20_000 + " tail"
    rows = [(5, None, "en", None, 0), (1, "", "en", "b", 0), (3, "a b c d", "en", "a", 7), (3, "a b c d", "en", "a", 7), (None, "x y z", "fr", "c", 5), (None, "X  y z", "fr", "c", 5)]
    rows += [(9, long, "en", "b", 1), (200, "A B C D", "en", "a", 7), (200, "another text", "en", "a", 7), (None, "p q r", "en", "a", 1), (None, "p q r", "en", "a", 1), (7, "x y z", "en", "a", 1)]
    odd = spark.createDataFrame(rows, DOCS)
    for c in ("rep", "part", "home", "node", "digest", "w0", "_row", "_gone_id", "group"):
        odd = odd.withColumn(c, F.lit(1))
    kept = near_dedup.one_of_each(odd)
    assert kept.columns == odd.columns
    found = sorted(((r["doc_id"] or 0, r["text"]) for r in kept.collect()), key=str)
    assert found == sorted([(1, ""), (3, "a b c d"), (0, "p q r"), (7, "x y z"), (9, long), (200, "another text")], key=str)
    assert near_dedup.one_of_each(odd.limit(0)).count() == 0


def test_rows_of_files_are_found_by_place(spark, tmp_path):
    """A plain scan of several files and splits, with long rows, repeated ones and other columns."""
    rnd = random.Random(3)
    words = [f"w{rnd.randrange(9000)}" for _ in range(300)]
    rows = [(k, edited(words, 1 + k % 4, rnd) if k % 3 else " ".join(f"u{rnd.random()}" for _ in range(40)), {"a": k}, [k]) for k in range(600)] + [(3, "same", None, None)] * 3
    path = f"{tmp_path}/docs.parquet"
    spark.createDataFrame(rows, "doc_id int, text string, `_metadata` map<string,int>, `a b` array<int>").repartition(7).write.option("parquet.block.size", 4096).parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        docs = spark.read.parquet(path)
        found = near_dedup.one_of_each(docs)
        assert found.schema == docs.schema
        assert sorted(r["doc_id"] for r in found.collect()) == sorted([1, 3, *range(0, 600, 3)])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_no_row_is_made_for_a_pair_of_a_dense_group(spark, monkeypatch):
    """Of 600 copies, each pair a candidate and alike to the base only, all pairs are tested but few become rows."""
    rnd, made, table = random.Random(22), [], near_dedup.table
    words = [f"w{rnd.randrange(90_000)}" for _ in range(500)]
    rows = [(0, " ".join(words))] + [(k, edited(words, [55 * p + rnd.randrange(50) for p in range(9)], rnd)) for k in range(1, 601)]

    def counted(df, name):
        out = table(df, name)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(near_dedup, "table", counted)
    kept = kept_ids(spark, rows[1:])  # without the base, so no part is confirmed and each pair is left over
    tables = near_dedup.plan(len(rows))[1]
    assert len(kept) > 550
    assert max(n for _, n in made) <= 12 * len(rows) * tables and sum(n for name, n in made if name == "near-edges") < 600 * 599 / 8


@pytest.mark.parametrize("copies", [300, 900])
def test_edges_of_a_dense_group_are_in_proportion_to_its_rows(spark, copies):
    """Each pair of the copies is a candidate; a table of keys hands on fewer edges than it has rows, and no pair is lost."""
    rnd = random.Random(24)
    words = [f"w{rnd.randrange(90_000)}" for _ in range(500)]
    texts = [edited(words, [55 * p + rnd.randrange(50) for p in range(9)], rnd) for _ in range(copies)]
    prints = np.array([simhash_gray.sketch(t, 5, 4) for t in texts]).view(np.int64).tolist()
    classes = spark.createDataFrame([(k, *w) for k, w in enumerate(prints)], "rep long, w0 long, w1 long, w2 long, w3 long")
    bits, tables = near_dedup.plan(copies)
    found = near_dedup.table(near_dedup.search(classes, near_dedup.masks(bits, tables)), "near-found")
    edges = {(r["a"], r["b"]) for r in found.where("b is not null").collect()}
    members = found.where("b is null").count()
    assert copies - 1 <= len(edges) < copies * tables and members <= copies * tables
    assert (settle(np.arange(copies), *np.array(sorted(edges)).T) == 0).all()


def test_rows_of_different_parts_meet_in_one_cell(spark):
    rnd = random.Random(23)
    rows = [(k, rnd.choice([0, 0, 0, k % 9, k]), *[rnd.randrange(3) for _ in range(4)]) for k in range(300)]
    left = spark.createDataFrame(rows, "rep long, part long, " + ", ".join(f"w{k} long" for k in range(4)))
    keys = np.array([[1, 0, 0, 0], [0, 2, 1, 0]], np.int64)
    for cell in (8, 40, 1000):
        dealt, met, part = {}, {}, {r[0]: r[1] for r in rows}
        for r in near_dedup.cells(left, keys, cell).collect():
            dealt.setdefault(r["cell"], []).append((r["rep"], r["side"], r["key"]))
        assert max(map(len, dealt.values())) <= max(3 * cell, 30) or cell == 1000
        for here in dealt.values():
            for i, (x, sx, key) in enumerate(here):
                for y, sy, _ in here[:i]:
                    if part[x] != part[y] and (sx != sy or sx == 0):
                        name = key, min(x, y), max(x, y)
                        met[name] = met.get(name, 0) + 1
        expected = {(t, x[0], y[0]) for t, m in enumerate(keys.tolist()) for x in rows for y in rows if x[0] < y[0] and x[1] != y[1] and all(a & k == b & k for a, b, k in zip(x[2:], y[2:], m, strict=True))}
        assert set(met) == expected and set(met.values()) == {1}
