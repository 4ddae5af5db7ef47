"""Each text operator against a plain version, and on null, empty, repeated, tied and very long rows."""

import gzip
import hashlib
import io
import json
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidegate.llm import bpe, embeddings, html_extract, mixing, simhash_gray, simhash_native, token_counts, token_files, toxicity, warc
from tidegate.llm.common import connected_components, scratch_path, settle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "　", "\x1c", "\x85", "\r", ".", "<|endoftext|>", "<|", "|>", "漢", "́", "\xa0", "1", "_", "word", "%%%", "the", "🙂"]


def texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 16))) for _ in range(n)]


LONG = "abc" * 20_000 + " tail"


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, repeated rows, a null id, a null source, a very long text, clashing extra columns."""
    rows = [(5, None, "en", None, 0), (1, "", "en", "b", 0), (3, "a b c d", "en", "a", 7), (3, "a b c d", "en", "a", 7), (None, "x y z", "fr", "c", 5), (9, LONG, "en", "b", 1), (200, "A B C D", "en", "a", 7)]
    return spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("x")).withColumn("draw", F.lit(1)).withColumn("key", F.lit(2)).withColumn("size", F.lit(0)).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_bpe_equals_tiktoken_and_round_trips(spark, odd, none):
    import tiktoken

    ours = bpe.encoder("byte_bpe_50k.tiktoken")
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})
    cases = [*texts(3000), "e" * 5000, "=-" * 4000, "th" + "e" * 3000, LONG]
    for text, (n, ids_hash, decoded_hash, data) in zip(cases, ours.digests(cases), strict=True):
        ids = theirs.encode_ordinary(text)
        assert np.frombuffer(data, "<u4").tolist() == ids and n == len(ids)
        assert ids_hash == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert decoded_hash == hashlib.sha256(text.encode()).hexdigest()
    found = by_id(bpe.encode_documents(odd))
    assert len(found) == 7 and found[0][1:] == (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())
    assert bpe.encode_documents(none).count() == 0


def test_rank_queue_pops_the_lowest_rank():
    queue = bpe.RankQueue(300_000)
    for rank in (7, 299_999, 64, 4096, 7):
        queue.push(rank, np.array([rank]))
    got = []
    while (x := queue.pop()) is not None:
        got.append((x[0], len(x[1])))
    assert got == [(7, 2), (64, 1), (4096, 1), (299_999, 1)]


def test_counts_equal_the_library(odd, none, monkeypatch):
    counter = token_counts.counter("piece_bpe_32k.model")
    monkeypatch.setattr(token_counts, "SEGMENT_CHARS", 3)
    rnd = random.Random(4)
    cases = texts(3000, 2) + ["".join(rnd.choice(ALPHABET + ["\u2581", "\u2581"]) for _ in range(rnd.randint(0, 16))) for _ in range(6000)]
    assert counter.count(cases).tolist() == [len(x) for x in counter.model.encode(cases)]
    monkeypatch.undo()
    rnd = random.Random(3)
    long = ["".join(rnd.choice(ALPHABET + ["\u2581", " \u2581", "\u2581 "]) for _ in range(3000)) for _ in range(40)] + ["word " * 409 + "abc\u2581 \u2581 the end", "\u2581" * 5000, " " * 5000]
    assert counter.count(long).tolist() == [len(x) for x in counter.model.encode(long)]
    assert all(len(s.encode()) < 3 * token_counts.SEGMENT_CHARS for s in counter.segments("wörd " * 4000))
    found = by_id(token_counts.count_tokens(odd))
    assert found[0] == (1, 0, 0, False) and found[1][2] == len(counter.model.encode("a b c d"))
    assert [r for r in found if r[0] == 9][0][2] == len(counter.model.encode(LONG))
    limit = found[1][2]
    assert [token_counts.count_tokens(odd.where("doc_id = 3").limit(1), limit=limit - k).first()["over_limit"] for k in (0, 1)] == [False, True]
    assert token_counts.count_tokens(none).count() == 0


def test_token_files_round_trip(spark, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ours = token_files.library("byte_bpe_50k.json")
    cases = texts(3000, 3)
    for text, data in zip(cases, ours.memo(cases), strict=True):
        assert np.frombuffer(data, ours.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases[:300])], "doc_id long, text string").repartition(5)
    folder = scratch_path(spark, "test")
    found = by_id(token_files.read_token_files(token_files.write_token_files(docs, folder), folder))
    start = 0
    for (doc_id, at, n, crc), text in zip(found, cases[:300], strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (at, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), doc_id
        start += len(ids)
    folder = scratch_path(spark, "test")
    found = token_files.read_token_files(token_files.write_token_files(odd, folder), folder).collect()
    assert len(found) == 7 and sum(r["n_tokens"] == 1 for r in found) == 2 and min(found, key=lambda r: r["start"])["doc_id"] is None
    folder = scratch_path(spark, "test")
    assert token_files.read_token_files(token_files.write_token_files(none, folder), folder).count() == 0


@pytest.mark.parametrize("most", [1, 200, 300, 70_000, 1 << 25, (1 << 32) - 1])
def test_packed_numbers(most):
    numbers = np.random.default_rng(most).integers(0, most, 1001, dtype=np.uint64).astype(np.uint32)
    control, data = token_files.pack(numbers)
    assert (token_files.unpack(control, data, len(numbers)) == numbers).all()
    block = token_files.write_block([1, None], [1000, 1], numbers)
    ((names, counts, back),) = token_files.read_blocks(io.BytesIO(token_files.MAGIC + block))
    assert names == [1, None] and counts.tolist() == [1000, 1] and (back == numbers).all()
    with pytest.raises(ValueError):
        list(token_files.read_blocks(io.BytesIO(token_files.MAGIC + block[:-1] + bytes([block[-1] ^ 1]))))


def test_native_fingerprints(spark, odd, none):
    docs = spark.createDataFrame([(i * 100, f"one two three four w{i} five six seven eight nine ten") for i in range(40)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in simhash_native.edited_fingerprints(docs, radius=9).collect()}
    whole = {i: d["text"] for i, d in ((r["doc_id"], r) for r in docs.collect())}
    ids = sorted(found)
    fp = {i: int(r["fingerprint"], 16) for i, r in found.items()}
    for i, nxt in zip(ids, [*ids[1:], ids[0]], strict=True):
        half = len(whole[i]) // 2
        edited = whole[i][: len(whole[i]) - half] + whole[nxt][:half]
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i]["near_next"] == 1 - (fp[i] ^ fp[nxt]).bit_count() / 64
        assert found[i]["n_within"] == sum((fp[i] ^ x).bit_count() <= 9 for x in fp.values()) - 1
    strange = simhash_native.edited_fingerprints(odd).collect()
    assert sorted((r["doc_id"] or 0) for r in strange) == [0, 1, 3, 3, 5, 9, 200]
    of = {r["doc_id"]: r for r in strange}
    assert of[1]["fingerprint"] == of[5]["fingerprint"] == "0" * 16 and of[3]["fingerprint"] == of[200]["fingerprint"]
    assert of[9]["n_chars"] == len(LONG) and simhash_native.edited_fingerprints(none).count() == 0
    assert simhash_native.edited_fingerprints(odd.where("doc_id = 9")).first()["near_next"] == 1.0


def test_native_fingerprints_of_every_row(spark):
    """Repeated and null ids, also the least integer: a row each, in the stated order; fingerprints recomputed plainly."""
    import xxhash

    rnd = random.Random(12)
    rows = [(rnd.choice([None, -(1 << 63), *range(12)]), rnd.choice(["", None, "one two", *[" ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 30))) for _ in range(8)]])) for _ in range(90)]

    def chained(*values):  # the engine hashes several values one after another, each seeded by the last
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest(v.encode(), h)
        return h

    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        h = [chained(*words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [chained(" ".join(words))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    whole = sorted(((i is not None, i or 0, hashlib.md5((t or "").encode()).digest(), t or "") for i, t in rows), key=lambda r: r[:3])
    expected = []
    for at, (known, i, _, text) in enumerate(whole):
        following = whole[(at + 1) % len(whole)][3]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = plain(text), plain(edited), plain(following)
        near = lambda x, y: 1 - (x ^ y).bit_count() / 64
        expected.append((i if known else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{b:016x}", near(a, b), near(a, c)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = [tuple(r)[:7] for r in simhash_native.edited_fingerprints(docs).collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def slow_fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    runs = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_gray_index_finds_all_links(spark, odd, none):
    for text in [*texts(300, 4), "É A b C", LONG]:
        assert simhash_gray.fingerprint(text) == slow_fingerprint(text)
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    values = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for c in centres for _ in range(120)})
    u = np.array(values, np.uint64)
    a, b = np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 2)
    expected = [values[k] for k in settle(np.arange(len(u)), a, b)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(k, v) for k, v in enumerate(signed)], "doc_id long, fp long")
    for limit in (4096, 8):  # the second refines hot keys down to the last level
        found = {r["doc_id"]: r["component_id"] for r in simhash_gray.components(prints, limit=limit).collect()}
        assert [values[found[k]] for k in range(len(values))] == expected
    for radius in (6,):
        a, b = np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= radius)
        found = {r["doc_id"]: r["component_id"] for r in simhash_gray.components(prints, radius).collect()}
        assert [values[found[k]] for k in range(len(values))] == [values[k] for k in settle(np.arange(len(u)), a, b)]
    strange = by_id(simhash_gray.near_duplicates(odd))
    assert len(strange) == 7 and strange[0][1:] == ("0" * 16, 1) and strange[-1][2] is None
    assert [r[2] for r in strange if r[0] in (3, 200)] == [3, 3, 3]
    assert simhash_gray.near_duplicates(none).count() == 0


def test_mix(spark, odd, none):
    rnd = random.Random(6)
    rows = [(k, "w " * rnd.randint(0, 50), "en", rnd.choice(["a", "b", "c", "d", None]), 0) for k in range(400)] + [(1000, "w " * 3, "en", "tiny", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.mix(docs).collect()
    sizes, target, taken = {}, {}, {}
    for r, (_, text, _, source, _) in zip(sorted(found, key=lambda r: r["doc_id"]), rows, strict=True):
        assert r["size"] == len(text.split()) and r["taken"] in (0, r["size"], 2 * r["size"])
        sizes[source], target[source] = r["source_size"], r["target"]
        taken[source] = taken.get(source, 0) + r["taken"]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    held, goal = {}, 1.5 * sum(sizes.values())
    while True:  # share out again and again
        free = [s for s in names if s not in held]
        level = (goal - sum(held.values())) / sum(weight[s] for s in free)
        over = {s: 2.0 * sizes[s] for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        held |= over
    for s in names:
        assert target[s] == pytest.approx(held.get(s, level * weight[s])) and abs(taken[s] - target[s]) <= 50
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    again = mixing.repeated(docs)
    assert again.columns == docs.columns and again.select(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0] >= sum(taken.values())
    assert mixing.mix(odd).count() == 7 and mixing.mix(none).count() == 0 and mixing.repeated(none).count() == 0
    assert mixing.repeated(odd).columns == odd.columns


def test_toxicity(spark, odd, none, monkeypatch):
    rnd = random.Random(7)
    plain, bad = [f"word{k}" for k in range(60)], ["vekan", "vekor", "vekul", "slur"]
    rows, labels = [], []
    for k in range(700):
        words = [rnd.choice(plain) for _ in range(rnd.randint(20, 60))]
        toxic = int(k % 5 == 0)
        if toxic:
            for _ in range(3):
                words[rnd.randrange(len(words))] = rnd.choice(bad)
        rows.append((k, " ".join(words).capitalize(), "en", "a", 0))
        labels.append((k, 1, toxic))
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    scored = {r["doc_id"]: r for r in toxicity.score_documents(docs, model, with_spans=True).collect()}
    held = [k for k in range(700) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert sorted(k for k, r in scored.items() if r["held_out"]) == held
    assert np.mean([scored[k]["predicted"] == labels[k][2] for k in held]) > 0.97
    caught = [rows[k][1][s["start"] : s["stop"]].lower() for k in held for s in scored[k]["spans"]]
    assert np.mean([any(b in c for b in bad) for c in caught]) > 0.95
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in scored.values())
    again = toxicity.train(docs.repartition(5), marks.repartition(3))
    assert again.crf.weights == model.crf.weights and (again.logistic == model.logistic).all()
    long = [(5000 + k, " ".join([rnd.choice(plain) for _ in range(9000)] + (bad * 60 if k % 2 else [])), "en", "a", 0) for k in range(12)]
    more = docs.union(spark.createDataFrame(long, DOCS))
    marked = marks.union(spark.createDataFrame([(r[0], 1, k % 2) for k, r in enumerate(long)], marks.schema))
    wide = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(more, toxicity.train(more, marked)).where("doc_id >= 5000").collect()}
    assert sum(wide[5000 + k] == k % 2 for k in range(12)) >= 11
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 60)
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 40)
    small = [toxicity.train(d, marks) for d in (docs, docs.repartition(7))]
    assert small[0].crf.weights == small[1].crf.weights
    monkeypatch.setattr(toxicity, "MAX_CHARS", 9000)
    assert len(toxicity.train(docs, marks).crf.weights) <= len(small[0].crf.weights)
    monkeypatch.undo()
    strange = toxicity.score_documents(odd, model).collect()
    assert len(strange) == 7 and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in strange)
    untrained = toxicity.train(none, marks.limit(0))
    assert toxicity.score_documents(odd, untrained).first()["score"] == 0.0 and toxicity.score_documents(none, untrained).count() == 0


def test_field_marginals_equal_enumeration():
    from itertools import product

    crf = toxicity.Field({}, -1.0, 0.3, -0.2, 0.8)
    values = [0.0, 2.0, 0.0, 0.0, -1.0, 1.5]
    weigh = {}
    for y in product((0, 1), repeat=6):
        s = sum(v - 1.0 for v, k in zip(values, y, strict=True) if k) + sum({(0, 1): 0.3, (1, 0): -0.2, (1, 1): 0.8}.get(p, 0.0) for p in zip(y, y[1:], strict=False))
        weigh[y] = np.exp(s)
    total = sum(weigh.values())
    places = [k for k, v in enumerate(values) if v]
    expected = [sum(w for y, w in weigh.items() if y[k]) / total for k in places]
    assert crf.marginals(places, [values[k] for k in places], 6) == pytest.approx(expected)
    slow = toxicity.Field({}, -3.0, -9.0, -9.0, 2.9)  # its states hardly mix, so far words still count
    for n in (100, 300, 5000):
        values = np.zeros(n)
        values[[10, n - 5]] = 4.0, 2.0
        step = np.array([[0.0, -9.0 - 3.0], [-9.0, 2.9 - 3.0]])  # from label to label, with the bias of the label entered
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = 0.0, -3.0 + values[0]
        for t in range(1, n):
            ahead[t] = np.logaddexp(ahead[t - 1, 0] + step[0], ahead[t - 1, 1] + step[1]) + [0.0, values[t]]
        for t in range(n - 2, -1, -1):
            behind[t] = np.logaddexp(step[:, 0] + behind[t + 1, 0], step[:, 1] + values[t + 1] + behind[t + 1, 1])
        whole = ahead + behind
        exact = np.exp(whole[:, 1] - np.logaddexp(whole[:, 0], whole[:, 1]))
        assert slow.marginals([10, n - 5], [4.0, 2.0], n) == pytest.approx(exact[[10, n - 5]])


def test_embeddings(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((60, 32))
    points = [b + rng.standard_normal(32) * s for b in base for s in (0.0, 0.02, 0.1, 0.25, 0.4)] + [base[0], base[0] * 3]
    rows = [(k, [float(x) for x in p]) for k, p in enumerate(points)]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 32), (n + 2, [float("nan")] * 32), (n + 3, [None] + [1.0] * 31), (n + 4, []), (n + 5, [1.0, 0.0]), (None, [1.0] * 32)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1)).withColumn("h1", F.lit("x"))
    unit = np.array(points) / np.linalg.norm(points, axis=1)[:, None]
    cosine = unit @ unit.T
    exact = cosine >= 0.9
    for limit in (4096, 8):
        found = {r["vec_id"]: r for r in embeddings.link_vectors(frame, limit=limit).collect()}
        links = sum(found[k]["n_links"] for k in range(n))
        assert links >= 0.9 * (exact.sum() - n) and all(found[k]["n_links"] <= exact[k].sum() - 1 for k in range(n))
        assert found[0]["n_links"] >= 2 and found[n - 1]["component_id"] == 0 and found[0]["kept"] and not found[n - 1]["kept"]
        assert all(found[k]["n_links"] == 0 and found[k]["component_id"] == k and found[k]["kept"] for k in range(n, n + 6))
        assert found[None]["component_id"] is None
    assert embeddings.link_vectors(frame.limit(0)).count() == 0


def test_embeddings_at_the_threshold(spark):
    """Recall by default of pairs just above 0.9, and repeated ids with vectors of their own."""
    rng = np.random.default_rng(18)
    points = []
    for k in range(1500):
        a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        cosine = 0.9 + 0.01 * rng.random() if k % 3 else 0.899
        points += [a, cosine * a + math.sqrt(1 - cosine**2) * b]
    unit = np.array(points) / np.linalg.norm(points, axis=1)[:, None]
    exact = (unit @ unit.T >= 0.9).sum(1) - 1
    frame = spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in embeddings.link_vectors(frame).collect()}
    links = np.array([found[k]["n_links"] for k in range(len(points))])
    print("links found", links.sum(), "of", exact.sum())
    assert (links <= exact).all() and links.sum() >= 0.92 * exact.sum()
    assert all(found[2 * k + 1]["component_id"] == 2 * k + (links[2 * k] == 0) for k in range(1500))
    two = [(5, points[0]), (5, points[3]), (5, points[3]), (6, points[3] * 2), (7, points[0]), (8, points[0] + 1e-9), (9, points[9])]
    rows = [tuple(r) for r in embeddings.link_vectors(spark.createDataFrame([(k, p.tolist()) for k, p in two], "vec_id long, embedding array<double>"), recall=0.9999).collect()]
    assert sorted(rows) == sorted([(5, 2, 5, True), (5, 2, 5, True), (5, 2, 5, True), (6, 2, 5, False), (7, 2, 5, False), (8, 2, 5, False), (9, 0, 9, True)])


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(9)
    units = rng.standard_normal((400, 64))
    units /= np.linalg.norm(units, axis=1)[:, None]
    codes = embeddings.Codes(embeddings.encode(units, np.zeros((400, 1), np.int64)), 64)
    a, b = np.arange(0, 200), np.arange(200, 400)
    exact = np.einsum("ij,ij->i", units[a], units[b])
    upper = codes.upper(a, b)
    estimate = upper - codes.error[a] - codes.rounding[b] / codes.factor[a]
    assert abs((estimate - exact).mean()) < 0.03 and (upper >= exact).all()
    near = units + rng.standard_normal(units.shape) * 0.055
    near /= np.linalg.norm(near, axis=1)[:, None]
    both = embeddings.Codes(embeddings.encode(np.concatenate([units, near]), np.zeros((800, 1), np.int64)), 64)
    exact, upper = np.einsum("ij,ij->i", units, near), both.upper(np.arange(400), np.arange(400, 800), 0.9)
    assert (exact >= 0.9).sum() > 200 and (upper[exact >= 0.9] >= exact[exact >= 0.9]).all()
    assert (both.upper(a, b, 0.9) < 0.9).mean() > 0.99  # pairs far apart are dropped


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies.</div><div class="ad">Buy now.</div><article><h1>Title &amp; more</h1><p><b>One   two.<br><p>Short.</p><p>Three
four &copy; five.</p></article><aside>Related things.</aside><div id="comments"><p>A reader says a long thing here, with many words.</p></div><form>Sign up</form><footer>&copy; me</footer></body></html>"""


def test_html(spark):
    assert html_extract.extract(PAGE) == "Title & more\nOne two.\nShort.\nThree\xa0four © five.".replace("\xa0", " ")
    assert html_extract.extract(PAGE[: PAGE.index("four")]) == "Title & more\nOne two.\nShort.\nThree"
    assert html_extract.extract("") == html_extract.extract("<nav><a href=x>y</a></nav>") == ""
    assert html_extract.extract("<" * 5000) != "x" and html_extract.extract("<div>" * 20_000) == ""
    rnd = random.Random(10)
    for _ in range(200):  # against all labellings
        n = rnd.randint(1, 8)
        z = [rnd.uniform(-3, 3) for _ in range(n)]
        edges = [(k, k + 1, rnd.uniform(0, 2)) for k in range(n - 1)] + [(0, n - 1, 0.7)] * (n > 2)
        cost = lambda y: sum(-v if v < 0 else 0 for v, k in zip(z, y, strict=True) if k) + sum(v for v, k in zip(z, y, strict=True) if v > 0 and not k) + sum(c for a, b, c in edges if y[a] != y[b])  # noqa: E731, B023
        best = min(cost([m >> k & 1 for k in range(n)]) for m in range(1 << n))
        assert cost(html_extract.minimum_cut(z, edges)) == pytest.approx(best)
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "")]
    found = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("z"))).collect()
    assert [r["n_chars"] for r in found] == [len(r["text"]) for r in found] and [r["text"] for r in found][2:] == ["", ""]
    assert html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc(spark):
    rows = [(1, "http://a/?q=1", PAGE), (2, None, None), (3, "http://b\r\nX: y", "é" * 50_000), (1, "http://a/?q=1", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("title", F.lit("z"))
    folder = scratch_path(spark, "test")
    files = warc.write_responses(pages.repartition(2), folder)
    found = warc.derivatives(files, folder, f"{folder}/derived").collect()
    assert len(found) == 4 and all(r["sound"] and r["http_status"] == 200 for r in found)
    page = next(r for r in found if r["target_uri"] == "http://a/?q=1")
    assert page["title"] == "T & x" and page["n_links"] == 1 and "Three four © five." in page["text"] and "var a" not in page["text"]
    store, root = token_files.open_store(f"{folder}/derived")
    from pyarrow import fs

    written = []
    for info in store.get_file_info(fs.FileSelector(root)):
        with store.open_input_stream(info.path, compression=None) as source:
            written += list(warc.read_records(source))
    assert sorted(h.get("WARC-Type") for h, _ in written) == ["conversion"] * 4 + ["metadata"] * 4
    sources = {r["refers_to"] for r in found}
    for headers, block in written:
        assert headers.get("WARC-Refers-To") in sources and headers.get("WARC-Block-Digest") == warc.digest(block)
    assert len(sources) == 4 and len({h.get("warc-record-id") for h, _ in written}) == 8
    broken = warc.response("1", "u", "x")
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(broken[:-8])))
    headers, block = next(warc.read_records(io.BytesIO(broken)))
    assert warc.derive(headers, block)["sound"] and not warc.derive(headers, block + b"!")["sound"]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "test")
    assert warc.derivatives(warc.write_responses(empty, folder), folder).count() == 0


@pytest.mark.parametrize("chunked", [False, True])
@pytest.mark.parametrize("coding", ["", "gzip", "deflate", "raw deflate", "br"])
def test_warc_headers_and_bodies(coding, chunked):
    text = PAGE.encode()
    packed = {"": text, "gzip": gzip.compress(text), "deflate": zlib.compress(text), "raw deflate": zlib.compress(text)[2:-4], "br": b"\x0b\x02"}[coding]
    body = b"".join(f"{len(packed[k : k + 100]):X};x=1\r\n".encode() + packed[k : k + 100] + b"\r\n" for k in range(0, len(packed), 100)) + b"0\r\n\r\n" if chunked else packed
    lines = ["HTTP/1.1 203 Fine", "set-cookie: a=1", "Set-Cookie: b=2", "X-Long: one", "\ttwo", "CONTENT-TYPE: text/html; charset=utf-8"]
    lines += ["transfer-encoding: Chunked"] * chunked + [f"content-encoding: {coding.rpartition(' ')[2]}"] * bool(coding)
    block = "\r\n".join(lines).encode() + b"\r\n\r\n" + body
    head = f"warc-type: response\r\nWARC-Record-ID: <urn:x>\r\nWARC-Concurrent-To: <urn:a>\r\nwarc-concurrent-to: <urn:b>\r\nwarc-payload-digest: {warc.digest(packed)}\r\ncontent-length: {len(block)}"
    source = io.BytesIO(warc.member(b"WARC/1.0\r\n" + head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n") * 2)
    found = list(warc.read_records(source))
    assert len(found) == 2 and found[0][1] == block
    made = warc.derive(*found[0])
    about = json.loads(made["records"].split(b"\r\n\r\n")[1])["Envelope"]
    assert about["WARC-Header-Metadata"]["WARC-Concurrent-To"] == ["<urn:a>", "<urn:b>"]
    assert about["HTTP-Response-Metadata"]["Headers"]["set-cookie"] == ["a=1", "b=2"] and about["HTTP-Response-Metadata"]["Headers"]["X-Long"] == "one two"
    assert made["sound"] and made["refers_to"] == "<urn:x>" and made["http_status"] == 203
    assert made["text"] == ("" if coding == "br" else warc.plain_text(PAGE)) and made["title"] == ("" if coding == "br" else "T & x")


def test_components(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 440)] + [(None, 1), (7, 7)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    labels = settle(np.arange(500), np.array([a for a, _ in real]), np.array([b for _, b in real]))
    assert found == {k: labels[k] for p in real for k in p}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
