"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (operator 10).

Pre-tokens are doubly linked lists of token ids in shared arrays. Buckets, one per merge rank, hold the left positions
of pairs; a three-level bitmap of non-empty buckets gives the lowest rank by find-first-set. A position whose node is
gone or whose pair has changed is stale and skipped, so nothing is ever searched for or removed from the middle, and
the work is proportional to the bytes, also for pre-tokens of many thousand bytes. One queue serves all pre-tokens of
a batch: they never interact, so the lowest rank of all may be merged everywhere at once with array operations.

Merging a whole bucket is right only if no merge of its rank gives rise to a lower rank. Where a vocabulary allows that
(``ripples``) and a pre-token has met it, only its leftmost position is merged and the others go back into the bucket.

Defined results: a null text is the empty text; an empty text has no ids (the hash of the empty string); repeated rows
each give their row; extra columns are ignored. Texts are cut only where the split pattern cannot see across.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import ChunkMemo, documents, ship, slices


class RankQueue:
    """Position arrays by rank: bucket lists, and bitmaps over bitmaps of the ranks whose bucket is not empty."""

    def __init__(self, ranks: int):
        words = (ranks >> 6) + 1
        self.leaf, self.middle, self.top = [0] * words, [0] * ((words >> 6) + 1), 0
        self.bucket: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        held = self.bucket.get(rank)
        if held is not None:
            held.append(positions)
            return
        self.bucket[rank] = [positions]
        word = rank >> 6
        self.leaf[word] |= 1 << (rank & 63)
        self.middle[word >> 6] |= 1 << (word & 63)
        self.top |= 1 << (word >> 6)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its positions, ascending; its bucket is then empty."""
        if not (top := self.top):
            return None
        high = (top & -top).bit_length() - 1
        bits = self.middle[high]
        word = (high << 6) + (bits & -bits).bit_length() - 1
        leaf = self.leaf[word]
        rank = (word << 6) + (leaf & -leaf).bit_length() - 1
        self.leaf[word] = leaf = leaf & (leaf - 1)
        if not leaf:
            self.middle[high] = bits = bits & (bits - 1)
            if not bits:
                self.top = top & (top - 1)
        held = self.bucket.pop(rank)
        return rank, held[0] if len(held) == 1 else np.sort(np.concatenate(held))


class ByteBpe:
    """Ranks of byte strings (ids are ranks) and the pattern that makes pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.size = max(ranks.values(), default=0) + 1
        self.bytes_of = [b""] * self.size
        self.single = np.zeros(256, np.int64)
        pairs: dict[int, int] = {}
        self.ripples = np.zeros(self.size, bool)
        for whole, rank in ranks.items():
            self.bytes_of[rank] = whole
            if len(whole) == 1:
                self.single[whole[0]] = rank
            for cut in range(1, len(whole)):
                a, b = ranks.get(whole[:cut]), ranks.get(whole[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
                    for part, length in ((a, cut), (b, len(whole) - cut)):
                        if length > 1 and rank < part:
                            self.ripples[part] = True
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()] + [-1], np.int64)
        self.listed = [b" %d" % i for i in range(self.size)]
        self.memo = ChunkMemo(self.encode_chunks)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1) if len(self.pair_keys) else np.full(len(key), -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and the number of ids of each piece (no piece is empty)."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(lengths.sum())
        token = np.append(self.single[np.frombuffer(b"".join(pieces), np.uint8)], -1)
        owner = np.repeat(np.arange(len(pieces)), lengths)
        ends = np.cumsum(lengths)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n
        before[ends - lengths] = n
        alive, pair = np.ones(n, bool), np.full(n + 1, -1, np.int64)
        known = np.array([self.ranks.get(p, -1) if len(p) > 1 else -1 for p in pieces], np.int64)  # a pre-token that is a token is left whole
        if (whole := known >= 0).any():
            firsts = (ends - lengths)[whole]
            alive[whole[owner]] = False
            alive[firsts] = True
            token[firsts] = known[whole]
        queue = RankQueue(self.size)

        def enter(at: np.ndarray) -> None:
            ranks = pair[at] = self.rank_of(token[at], token[after[at]])
            some = ranks >= 0
            at, ranks = at[some], ranks[some]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            starts = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1]))
            for start, stop, rank in zip(starts.tolist(), [*starts[1:].tolist(), len(at)], ranks[starts].tolist(), strict=True):
                queue.push(rank, at[start:stop])

        flags = np.zeros(n + 1, bool)

        def apart(at: np.ndarray) -> np.ndarray:
            """Without pairs that overlap the pair to their left: of a chain of them every second one is stale by its turn."""
            chained = np.append(False, after[at[:-1]] == at[1:])
            if not chained.any():
                return at
            k = np.arange(len(at))
            return at[(k - np.maximum.accumulate(np.where(chained, 0, k))) % 2 == 0]

        enter(np.flatnonzero((after[:n] < n) & ~whole[owner]))
        while (found := queue.pop()) is not None:
            rank, at = found
            at = at[pair[at] == rank]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                if self.ripples[rank]:
                    first = np.append(True, owner[at[1:]] != owner[at[:-1]])
                    if not first.all():
                        chosen = apart(at)
                        beyond, left = after[after[chosen]], before[chosen]
                        flags[after[chosen]] = True
                        met = self.rank_of(np.full(len(chosen), rank), token[beyond]), self.rank_of(np.where(flags[left], rank, token[left]), np.full(len(chosen), rank))
                        flags[after[chosen]] = False
                        low = ((met[0] >= 0) & (met[0] < rank)) | ((met[1] >= 0) & (met[1] < rank))
                        alone = ~first & np.isin(owner[at], owner[chosen[low]])
                        if alone.any():
                            queue.push(rank, at[alone])
                            at = at[~alone]
                at = apart(at)
            right = after[at]
            beyond = after[right]
            token[at] = rank
            alive[right] = False
            pair[right] = pair[at] = -1
            after[at] = beyond
            before[beyond] = at
            left = before[at]
            changed = np.concatenate((at[beyond < n], left[left < n]))
            if len(changed):
                enter(np.unique(changed))
        return token[:n][alive], np.bincount(owner[alive], minlength=len(pieces))

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as little-endian unsigned 32-bit integers."""
        cut = [self.split(c) for c in chunks]
        pieces = [p.encode("utf-8") for c in cut for p in c]
        if not pieces:
            return [b""] * len(chunks)
        ids, counts = self.merge(pieces)
        data = ids.astype("<u4").tobytes()
        upto = np.append(0, np.cumsum(counts))[np.append(0, np.cumsum([len(c) for c in cut]))] * 4
        upto = upto.tolist()
        return [data[a:b] for a, b in zip(upto, upto[1:], strict=False)]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.memo([text])[0], "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digests(self, texts: list[str]) -> list[tuple[int, str, str, bytes]]:
        """Of each text: number of ids, hash of the decimal ids, hash of the bytes they decode to, the ids' bytes."""
        out = []
        for data in self.memo(texts):
            ids = np.frombuffer(data, "<u4").tolist()
            decimal = b"".join(map(self.listed.__getitem__, ids))[1:]
            out.append((len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest(), data))
        return out


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


_loaded: dict[str, ByteBpe] = {}


def encoder(vocabulary: str) -> ByteBpe:
    """One encoder per worker process. ``vocabulary`` is a file's path, or the name of a public tokenizer's file."""
    import public_tokenizers

    if vocabulary not in _loaded:
        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        _loaded[vocabulary] = ByteBpe(load_ranks(path), public_tokenizers.PATTERN)
    return _loaded[vocabulary]


def encode_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (little-endian unsigned 32-bit) of each row.

    A narrow map over Arrow batches without any shuffle; the rank file is read once per worker from its own path.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in slices(batches):
            done = bpe.digests([t or "" for t in batch.column(1).to_pylist()])
            columns = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array([x[0] for x in done], pa.int64()),
                "ids_sha256": pa.array([x[1] for x in done], pa.string()),
                "decoded_sha256": pa.array([x[2] for x in done], pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.array([x[3] for x in done], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))
