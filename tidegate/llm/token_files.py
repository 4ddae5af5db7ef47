"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes (operator 4).

A shard file holds blocks of whole documents in ascending doc_id order. Ids are replaced by their frequency rank over
the corpus, so frequent ids take one byte. Each rank takes one to four bytes; its length less one is a two-bit code,
four codes to a control byte, and control bytes are stored apart from data bytes. Reading looks up the four lengths of
a control byte in a table, adds them up, and gathers the data bytes with array operations.

Shard: magic ``TGSV1\\n``, then blocks: header (documents, ids, control bytes, data bytes, CRC-32 of the payload), then
the documents' doc_ids (int64), null flags (uint8) and id counts (uint32), the control bytes and the data bytes; all
numbers are little-endian. ``ranks.bin`` beside the shards lists the id of each rank (uint32).

Files are written under a name of the attempt and then renamed, so a repeated task replaces its file by equal bytes.
Defined results: a null text is the empty text; every document ends with the end id; equal or null doc_ids keep all
their rows (nulls first, rows of one doc_id in the order of a hash of their ids); an empty table gives no shards and no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import ChunkMemo, documents, remove, scratch_path, ship, shuffle_partitions, slices, table

MAGIC = b"TGSV1\n"
_HEAD = struct.Struct("<IIIII")
BLOCK_IDS = 1 << 20
#: Lengths of the four numbers of each control byte.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    numbers = numbers.astype("<u4")
    code = (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    codes = np.zeros(-(-len(code) // 4) * 4, np.uint8)
    codes[: len(code)] = code
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    most = int(code.max(initial=0)) + 1
    data = numbers.view(np.uint8).reshape(-1, 4)[:, :most][np.arange(most, dtype=np.uint8) <= code[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = padded[at].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        out |= np.where(lengths > k, padded[at + k].astype(np.uint32) << np.uint32(8 * k), np.uint32(0))
    return out


def write_block(doc_ids: list, counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    none = np.array([x is None for x in doc_ids], np.uint8)
    payload = np.array([x or 0 for x in doc_ids], "<i8").tobytes() + none.tobytes() + np.array(counts, "<u4").tobytes() + control + data
    return _HEAD.pack(len(doc_ids), len(ranks), len(control), len(data), zlib.crc32(payload)) + payload


def read_blocks(source) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, counts, ranks) of each block of an open shard; damage raises ValueError."""
    if source.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token shard")
    while head := source.read(_HEAD.size):
        docs, ids, control, data, crc = _HEAD.unpack(head)
        payload = source.read(docs * 13 + control + data)
        if len(payload) != docs * 13 + control + data or zlib.crc32(payload) != crc:
            raise ValueError("a block is damaged")
        names = [None if z else i for i, z in zip(np.frombuffer(payload, "<i8", docs).tolist(), payload[docs * 8 : docs * 9], strict=True)]
        counts = np.frombuffer(payload, "<u4", docs, docs * 9).astype(np.int64)
        at = docs * 13
        yield names, counts, unpack(payload[at : at + control], payload[at + control :], ids)


def open_store(uri: str):
    """(file system, path) of a folder's URI, on any store that Arrow reaches: local or shared disk, HDFS, S3, GCS."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


_loaded: dict[str, Library] = {}


class Library:
    """Ids of texts by the tokenizers library, as bytes of ``kind``; chunks between safe cuts are encoded once.

    Chunks that begin with a blank and end with no white space go to the library many at a time as one text, and the
    bytes that each token stands for tell where a chunk's ids end. If they ever disagree, chunks are encoded singly.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))
        vocabulary = self.library.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4")
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)  # a byte-level token has a character for each byte
        for i, token in self.library.get_added_tokens_decoder().items():
            self.width[i] = len(token.content.encode("utf-8"))
        self.memo = ChunkMemo(self.encode, 600_000)

    def encode(self, chunks: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(chunks)
        joint = [k for k, c in enumerate(chunks) if c[0] == " " and not c[-1].isspace()]
        single = [k for k, c in enumerate(chunks) if c[0] != " " or c[-1].isspace()]
        for at in range(0, len(joint), 50_000):
            part = joint[at : at + 50_000]
            texts = [chunks[k] for k in part]
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, texts)), np.int64, len(texts)))
            found = self.library.encode_batch_fast(["".join(texts[i : i + 500]) for i in range(0, len(texts), 500)], add_special_tokens=False)
            ids = np.concatenate([np.array(x.ids, self.kind) for x in found])
            reached = np.cumsum(self.width[ids])
            stops = np.searchsorted(reached, ends) + 1
            if stops[-1] != len(ids) or (reached[stops - 1] != ends).any():
                single += part
                continue
            data, stops = ids.tobytes(), (stops * self.kind.itemsize).tolist()
            for k, a, b in zip(part, [0, *stops], stops, strict=False):
                out[k] = data[a:b]
        for at in range(0, len(single), 20_000):
            part = single[at : at + 20_000]
            for k, x in zip(part, self.library.encode_batch_fast([chunks[k] for k in part], add_special_tokens=False), strict=True):
                out[k] = np.array(x.ids, self.kind).tobytes()
        return out


def library(tokenizer: str) -> Library:
    if tokenizer not in _loaded:
        _loaded[tokenizer] = Library(tokenizer)
    return _loaded[tokenizer]


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, kind: np.dtype) -> DataFrame:
    """doc_id and ids (little-endian integers of ``kind``), the end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, end = library(tokenizer).memo, np.array([end_id], kind).tobytes()
        for batch in slices(batches):
            ids = [x + end for x in memo([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "ids": pa.array(ids, pa.binary())})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def _frequencies(encoded: DataFrame, kind: np.dtype) -> np.ndarray:
    """Ids by falling frequency, ties by id: at most one row per vocabulary entry ever reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in slices(batches):
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
            seen = np.bincount(ids, minlength=len(total)).astype(np.int64)
            seen[: len(total)] += total
            total = seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    rows = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return rows.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.uint32)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """Write shards to ``folder`` (a URI all executors reach) and return the manifest: path, first_id, n_docs, n_ids.

    Texts are encoded once into a scratch table; only ids, a fraction of the text, are range-partitioned by doc_id.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = library(tokenizer).kind
    encoded = table(_encoded(docs, tokenizer, end_id, kind), "token-ids")
    by_rank = _frequencies(encoded, kind)
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/ranks.bin") as out:
        out.write(by_rank.astype("<u4").tobytes())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
        rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
        store, root = open_store(folder)
        name, out = f"{root}/part-{TaskContext.get().partitionId():06d}.tgs", None
        attempt = f"{name}.{uuid.uuid4().hex}"
        names, counts, parts, held, first, docs_n, ids_n = [], [], [], 0, None, 0, 0

        def flush() -> None:
            nonlocal names, counts, parts, held
            out.write(write_block(names, counts, rank_of[np.frombuffer(b"".join(parts), kind)]))
            names, counts, parts, held = [], [], [], 0

        for batch in slices(batches):
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None:
                    out, first = store.open_output_stream(attempt), doc_id
                    out.write(MAGIC)
                n = len(data) // kind.itemsize
                names.append(doc_id)
                counts.append(n)
                parts.append(data)
                held, docs_n, ids_n = held + n, docs_n + 1, ids_n + n
                if held >= BLOCK_IDS:
                    flush()
        if out is not None:
            if names:
                flush()
            out.close()
            store.move(attempt, name)
            yield pa.RecordBatch.from_pydict({"path": [name], "first_id": pa.array([first], pa.int64()), "n_docs": [docs_n], "n_ids": [ids_n]})

    tie = F.xxhash64("ids")  # also deals rows of one doc_id to several tasks
    ordered = encoded.repartitionByRange(shuffle_partitions(spark), F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie, "ids")
    manifest = table(ordered.mapInArrow(write, "path string, first_id long, n_docs long, n_ids long"), "token-manifest")
    for path in encoded.inputFiles()[:1]:
        remove(spark, path.rpartition("/")[0])
    return manifest


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone.

    The manifest has a row per shard file, as a file listing has; its running total is all that the driver holds.
    """
    spark = manifest.sparkSession
    shards = manifest.orderBy(F.col("first_id").asc_nulls_first(), "path").toPandas()
    shards["start"] = shards["n_ids"].cumsum() - shards["n_ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        with store.open_input_stream(f"{root}/ranks.bin") as held:
            by_rank = np.frombuffer(held.read(), "<u4")
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_stream(path) as source:
                    for names, counts, ranks in read_blocks(source):
                        data, ends = by_rank[ranks].tobytes(), np.cumsum(counts)
                        crc = [zlib.crc32(data[a * 4 : b * 4]) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                        yield pa.RecordBatch.from_pydict(
                            {"doc_id": pa.array(names, pa.int64()), "start": pa.array(start + ends - counts, pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
                        )
                        start += int(ends[-1]) if len(ends) else 0

    rows = [(r.path, int(r.start)) for r in shards.itertuples()]
    listed = spark.createDataFrame(rows, "path string, start long")
    return listed.repartition(max(1, len(rows)), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    return read_token_files(write_token_files(documents(spark, sf_dir), folder), folder)
