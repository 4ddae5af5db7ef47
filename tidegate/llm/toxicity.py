"""Toxic spans by a linear-chain conditional random field over words, aggregated to document scores (operator 6).

Labels exist for documents only, so tokens are labelled first: a word of a toxic training document is toxic if one of
its features (the word, its beginnings, the word with the one before it) is far more frequent in toxic than in clean
training documents; no word of a clean one is. A pair is a feature if it says more than either of its words, so words
that are clean alone or in another order are told apart. The field has two labels, weights for features, a bias and transitions, fitted by gradients of the
conditional likelihood (forward-backward). The marginals of a document (their sum, rate, maximum and second) go through a
logistic regression that was fitted on marginals from the other half of the training rows, so that scores are honest.

The fit sees a bounded sample: at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled rows in the order of a seeded hash, and of
them, in that order, as many as have ``MAX_CHARS`` characters together. Texts of any length are drawn; for the field's
gradients long ones are cut into sequences of ``SEQUENCE`` words. Scoring sees whole texts: a stretch of words without
any known feature is a power of one matrix, so only the other words cost a step each.

Defined results: a null text is the empty text and is scored like any text without words; a null doc_id counts as held
out; without labelled rows of both kinds every score is the share of toxic rows (0 if there are none); repeated rows
each give their row; rows of ``labels`` that repeat count once (toxic if any is); extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.common import documents, ship, slices

MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 1000, 1500, 6_000_000
THRESHOLD = 0.7
ROUNDS = 25
#: What a feature must show: log-odds, and evidence (chi-square of one degree) to be used and to label words of toxic texts.
ODDS, EVIDENCE, STRONG = 1.0, 8.0, 20.0
_WORDS = re.compile(r"\w+").findall
_PREFIXES = (3, 4, 5, 6, 7)
_STRETCH = 64
SEQUENCE = 400
_COLUMNS = 256


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def features(word: str) -> list[str]:
    return [f"={word}", *[word[:n] for n in _PREFIXES if len(word) >= n]]


@dataclass
class Field:
    """Weights of features, bias of the toxic label, transitions clean-toxic, toxic-clean and toxic-toxic."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    into: float = 0.0
    out_of: float = 0.0
    stay: float = 0.0

    def __post_init__(self) -> None:
        e = math.exp
        step = np.array([[e(self.bias + self.stay), e(self.bias + self.into)], [e(self.out_of), 1.0]])
        back = np.array([[e(self.stay + self.bias), e(self.out_of)], [e(self.into + self.bias), 1.0]])
        self.ahead, self.behind = [np.eye(2)], [np.eye(2)]
        for _ in range(_STRETCH):
            for powers, m in ((self.ahead, step), (self.behind, back)):
                nxt = powers[-1] @ m
                powers.append(nxt / nxt.max())
        self.ahead = _Powers(self.ahead)
        self.behind = _Powers(self.behind)
        self.lexicon: dict[str, float] = _Lexicon(self.weights)
        self.pairs = {tuple(f.split(" ")): x for f, x in self.weights.items() if " " in f}

    def marginals(self, places: list[int], values: list[float], n: int) -> list[float]:
        """Probability of the toxic label at ``places``, whose feature sums are ``values``, among ``n`` words."""
        e, eb = math.exp, math.exp(self.bias)
        ei, eo, es = e(self.into), e(self.out_of), e(self.stay)
        ahead, behind = self.ahead, self.behind
        forward, r, last = [], None, -1
        for at, v in zip(places, values, strict=True):
            gap = at - last - 1
            if r is None:
                if gap:
                    a, b, c, d = ahead[gap - 1]
                    r = (a * eb + b) / (c * eb + d)
            elif gap:
                a, b, c, d = ahead[gap]
                r = (a * r + b) / (c * r + d)
            u = e(min(30.0, self.bias + v))
            r = u if r is None else u * (ei + es * r) / (1 + eo * r)
            forward.append(r)
            last = at
        out, q, nxt = [], 1.0, n
        for k in range(len(places) - 1, -1, -1):
            gap = nxt - places[k] - 1
            if nxt < n:
                u = e(min(30.0, self.bias + values[k + 1]))
                q = (eo + es * u * q) / (1 + ei * u * q)
            if gap:
                a, b, c, d = behind[gap]
                q = (a * q + b) / (c * q + d)
            odds = forward[k] * q
            out.append(odds / (1 + odds))
            nxt = places[k]
        return out[::-1]

    def read(self, text: str) -> tuple[int, list[int], list[float]]:
        """Number of words, and places and marginals of the words with known features."""
        words = _WORDS(lowered(text))
        values = np.fromiter(map(self.lexicon.__getitem__, words), np.float64, len(words))
        if self.pairs and len(words) > 1:
            values[1:] += np.fromiter(map(self.pairs.get, zip(words, words[1:], strict=False), repeat(0.0)), np.float64, len(words) - 1)
        places = np.flatnonzero(values)
        if not len(places):
            return len(words), [], []
        at = places.tolist()
        return len(words), at, self.marginals(at, values[places].tolist(), len(words))


class _Powers(dict):
    """Powers of a matrix up to a factor, as tuples: the first ones given, others by squaring when first asked for; bounded."""

    def __init__(self, first: list[np.ndarray]):
        super().__init__((n, tuple(m.ravel().tolist())) for n, m in enumerate(first))
        self.first = first

    def __missing__(self, n: int) -> tuple[float, ...]:
        out, square, left = self.first[n % _STRETCH], self.first[_STRETCH], n // _STRETCH
        while left:
            if left & 1:
                out = out @ square
                out = out / out.max()
            square = square @ square
            square = square / square.max()
            left >>= 1
        if len(self) > 50_000:
            self.clear()
        self[n] = found = tuple(out.ravel().tolist())
        return found

    def __reduce__(self):
        return _Powers, (self.first,)


class _Lexicon(dict):
    """Feature sums by word, made when first asked for; bounded."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = sum(self.weights.get(f, 0.0) for f in features(word))
        if len(self) > 300_000:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value

    def __reduce__(self):
        return _Lexicon, (self.weights,)


def describe(n: int, marginals: list[float]) -> list[float]:
    total, (second, most) = sum(marginals), sorted([0.0, 0.0, *marginals])[-2:]
    return [1.0, math.log1p(total), most, second, math.log1p(100 * total / max(n, 1)), math.log1p(n) / 5]


def log_odds(a: np.ndarray, b: np.ndarray, a_all: int, b_all: int) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log-odds of features in ``a`` toxic and ``b`` clean documents, and twice the log-likelihood ratio of it."""
    odds = np.log((a + 0.3) / (a_all + 0.6)) - np.log((b + 0.3) / (b_all + 0.6))
    share = (a + b) / (a_all + b_all)
    evidence = 2 * (a * np.log(np.maximum(a, 1) / (share * a_all)) + b * np.log(np.maximum(b, 1) / (share * b_all)))
    return odds, evidence


def known_features(words: list[set[str]], toxic: np.ndarray) -> tuple[dict[str, float], set[str]]:
    """Smoothed log-odds of the features that speak for toxicity with enough support, and which of them do strongly."""
    kinds = Counter(), Counter()
    for w, t in zip(words, toxic, strict=True):
        kinds[int(t)].update({f for x in w for f in features(x)})
    names = list(kinds[1])
    counts = np.array([[kinds[1][f], kinds[0][f]] for f in names], np.float64).reshape(-1, 2)
    odds, evidence = log_odds(counts[:, 0], counts[:, 1], int(toxic.sum()), int((~toxic).sum()))
    keep = np.flatnonzero((counts[:, 0] >= 3) & (odds > ODDS) & (evidence > EVIDENCE))
    return {names[k]: float(odds[k]) for k in keep}, {names[k] for k in keep if evidence[k] > STRONG}


def known_pairs(whole: list[np.ndarray], toxic: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring words (number of the first times ``n`` plus the second) that speak for toxicity by more than either word
    alone, their log-odds, and which do strongly."""
    def counts(kind: bool, of: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.unique(of(w.astype(np.int64))) for w, t in zip(whole, toxic, strict=True) if t == kind]
        return np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)

    def both(of: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
        (names, a), (others, clean) = counts(True, of), counts(False, of)
        b = np.zeros(len(names))
        b[np.isin(names, others)] = clean[np.isin(others, names)]
        return names, a, *log_odds(a.astype(float), b, int(toxic.sum()), int((~toxic).sum()))

    words, _, word_odds, _ = both(lambda w: w)
    alone = np.full(n, -np.inf)
    alone[words] = word_odds
    names, a, odds, evidence = both(lambda w: w[:-1] * n + w[1:])
    keep = (a >= 3) & (odds > np.maximum(ODDS, 0.7 + np.maximum(alone[names // n], alone[names % n]))) & (evidence > EVIDENCE)
    return names[keep], odds[keep], evidence[keep] > STRONG


class _Block:
    """Some sequences as columns of a matrix, one row a word; the longest come first."""

    def __init__(self, sequences: list[tuple[list[list[int]], bool]], strong: set[int]):
        self.lengths = np.array([len(s) for s, _ in sequences], np.int64)
        self.shape = int(self.lengths.max(initial=0)), len(sequences)
        self.labels = np.zeros(self.shape, bool)
        where, what = [], []
        for column, (words, toxic) in enumerate(sequences):
            for t, known in enumerate(words):
                if known:
                    where += [t * self.shape[1] + column] * len(known)
                    what += known
                    self.labels[t, column] = toxic and not strong.isdisjoint(known)
        self.where, self.what = np.array(where, np.int64), np.array(what, np.int64)
        self.mask = np.arange(self.shape[0])[:, None] < self.lengths[None, :]
        self.active = [int(np.searchsorted(-self.lengths, -t, "left")) for t in range(self.shape[0])]  # sequences longer than t words

    def observed(self, n: int) -> np.ndarray:
        """How often each feature has the toxic label, the labels, and the transitions."""
        labels, inside = self.labels, self.mask[1:]
        after, before = labels[1:] & inside, labels[:-1]
        seen = [labels.sum(), (after & ~before).sum(), (before & ~labels[1:] & inside).sum(), (after & before).sum()]
        return np.concatenate((np.bincount(self.what, labels.ravel()[self.where], n), seen))

    def expected(self, moves: np.ndarray) -> np.ndarray:
        """The same under the field, by forward and backward odds."""
        steps, width = self.shape
        bias, into, out_of, stay = moves[-4:]
        unary = np.bincount(self.where, moves[:-4][self.what], steps * width).reshape(steps, width) + bias
        u = np.exp(np.clip(unary, -30, 30))
        ei, eo, es = np.exp(np.clip([into, out_of, stay], -30, 30))
        r, q = np.empty_like(u), np.ones_like(u)
        r[0] = u[0]
        for t in range(1, steps):
            m = self.active[t]
            r[t, :m] = u[t, :m] * (ei + es * r[t - 1, :m]) / (1 + eo * r[t - 1, :m])
            r[t, m:] = 0.0
        for t in range(steps - 2, -1, -1):
            m = self.active[t + 1]
            uq = u[t + 1, :m] * q[t + 1, :m]
            q[t, :m] = (eo + es * uq) / (1 + ei * uq)
        p = np.where(self.mask, r * q / (1 + r * q), 0.0)
        # Of neighbours, in odds against both being clean.
        uq, r0, both = u[1:] * q[1:], r[:-1], self.mask[1:]
        a, b, c = ei * uq, eo * r0, es * r0 * uq
        whole = 1 + a + b + c
        shape = [p.sum(), (a / whole)[both].sum(), (b / whole)[both].sum(), (c / whole)[both].sum()]
        return np.concatenate((np.bincount(self.what, p.ravel()[self.where], len(moves) - 4), shape))


def fit_field(texts: list[str], toxic: np.ndarray) -> Field:
    """The conditional random field of training documents by full-batch gradients with per-weight steps."""
    numbers: dict[str, int] = {}
    whole = [np.array([numbers.setdefault(w, len(numbers)) for w in _WORDS(lowered(t))], np.int32) for t in texts]
    names_of = list(numbers)
    odds, certain = known_features([{names_of[k] for k in np.unique(w).tolist()} for w in whole], toxic)
    pairs, pair_odds, pair_certain = known_pairs(whole, toxic, len(names_of))
    names = sorted(odds)
    number = {f: i for i, f in enumerate(names)}
    strong = {number[f] for f in certain} | {len(names) + i for i in np.flatnonzero(pair_certain).tolist()}
    known = [[number[f] for f in features(w) if f in number] for w in names_of]
    first_pair, names = len(names), names + [f"{names_of[x // len(names_of)]} {names_of[x % len(names_of)]}" for x in pairs.tolist()]
    odds |= dict(zip(names[first_pair:], pair_odds.tolist(), strict=True))

    def described(w: np.ndarray) -> list[list[int]]:
        out = [known[i] for i in w.tolist()]
        together = w[:-1].astype(np.int64) * len(names_of) + w[1:]
        for k in np.flatnonzero(np.isin(together, pairs)).tolist():
            out[k + 1] = [*out[k + 1], first_pair + int(np.searchsorted(pairs, together[k]))]
        return out

    cut = [(x[at : at + SEQUENCE], bool(t)) for x, t in zip(map(described, whole), toxic, strict=True) for at in range(0, len(x), SEQUENCE)]
    if not names or not cut:
        return Field()
    cut.sort(key=lambda x: -len(x[0]))
    blocks = [_Block(cut[at : at + _COLUMNS], strong) for at in range(0, len(cut), _COLUMNS)]
    weight = np.array([0.5 * min(4.0, odds[f]) for f in names])
    shape = np.array([-4.0, 0.0, 0.0, 0.0])  # bias, into, out of, stay
    moves, speed, before = np.concatenate((weight, shape)), np.full(len(names) + 4, 0.1), np.zeros(len(names) + 4)
    target = sum(b.observed(len(names)) for b in blocks)
    for _ in range(ROUNDS):
        slope = target - sum(b.expected(moves) for b in blocks) - 0.2 * moves
        turn = np.sign(slope) * np.sign(before)
        speed = np.clip(speed * np.where(turn > 0, 1.3, np.where(turn < 0, 0.5, 1.0)), 1e-4, 1.0)
        moves = moves + np.sign(slope) * speed
        before = slope
    moves = np.clip(moves, -15, 15)
    kept = {f: float(x) for f, x in zip(names, moves, strict=False) if abs(x) > 0.01}
    return Field(kept, *[float(x) for x in moves[-4:]])


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.02] * (x.shape[1] - 1)) * 10
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    prior: float
    crf: Field | None = None
    logistic: np.ndarray | None = None

    def score(self, text: str) -> tuple[float, list[int], list[float]]:
        if self.crf is None:
            return self.prior, [], []
        n, places, p = self.crf.read(text)
        z = float(np.dot(self.logistic, describe(n, p)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), places, p


def fit(rows: list[tuple[str, int]], prior: float) -> Model:
    """``rows``: texts and labels of the sample, in a fixed order; copies of a text count once."""
    rows = list(dict.fromkeys((t or "", int(y)) for t, y in rows))
    texts, toxic = [t for t, _ in rows], np.array([y == 1 for _, y in rows], bool)
    if toxic.sum() < 2 or (~toxic).sum() < 2:
        return Model(prior)
    half = np.zeros(len(rows), bool)
    for kind in (toxic, ~toxic):
        half[np.flatnonzero(kind)[::2]] = True
    x = np.zeros((len(rows), len(describe(0, []))))
    for side in (half, ~half):
        crf = fit_field([texts[k] for k in np.flatnonzero(side)], toxic[side])
        for k in np.flatnonzero(~side):
            n, _, p = crf.read(texts[k])
            x[k] = describe(n, p)
    return Model(prior, fit_field(texts, toxic), fit_logistic(x, toxic.astype(float)))


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, seed: int = 6) -> Model:
    """Fit on the bounded sample of labelled rows that are not held out (see the module)."""
    known = labels.where("doc_id is not null and toxic is not null").where(remainder(F.col("doc_id")) != 1)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    prior = toxic / (clean + toxic) if clean + toxic else 0.0
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    known = known.withColumn("place", place)
    chosen = None
    for label, n, most in ((1, toxic, MAX_TOXIC), (0, clean, MAX_CLEAN)):
        # The hash alone leaves about as many as wanted, so the sort sees few rows.
        part = known.where(F.col("toxic") == label).withColumn("turn", F.col("place") * (n / most)).where("turn < 1.2").orderBy("turn", "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most MAX_TOXIC + MAX_CLEAN ids are broadcast, and as many texts, or twice as many if ids repeat, are put in order.
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.orderBy("turn", "doc_id", "text").limit(2 * (MAX_TOXIC + MAX_CLEAN))
    so_far = F.sum(F.length("text")).over(Window.orderBy("turn", "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0))
    found = sorted((r["doc_id"], r["text"], r["toxic"]) for r in texts.withColumn("so_far", so_far).where(F.col("so_far") <= MAX_CHARS).collect())
    return fit([(t, y) for _, t, y in found], prior)


def spans(text: str, places: list[int], p: list[float]) -> list[dict]:
    """Character offsets of runs of words whose marginal is at least one half."""
    if not any(x >= 0.5 for x in p):
        return []
    at, out, last = dict(zip(places, p, strict=True)), [], -2
    for k, m in enumerate(re.finditer(r"\w+", lowered(text))):
        if at.get(k, 0.0) >= 0.5:
            if last == k - 1:
                out[-1]["stop"] = m.end()
            else:
                out.append({"start": m.start(), "stop": m.end()})
            last = k
    return out


def score_documents(docs: DataFrame, model: Model, with_spans: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted and, if asked for, the toxic spans' character offsets of each row."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [model.score(t) for t in texts]
            score = np.array([x[0] for x in found], np.float64)
            columns = {"doc_id": batch.column(0), "score": pa.array(score, pa.float64()), "predicted": pa.array(score >= THRESHOLD).cast(pa.int32())}
            if with_spans:
                kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
                columns["spans"] = pa.array([spans(t, x[1], x[2]) for t, x in zip(texts, found, strict=True)], kind)
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, score double, predicted int" + ", spans array<struct<start: int, stop: int>>" * with_spans
    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
    held = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(True))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", *["spans"] * with_spans)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` that the model does not reject, with all their columns, in one narrow map."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            keep = [model.score(t or "")[0] < THRESHOLD for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), with_spans=True)
