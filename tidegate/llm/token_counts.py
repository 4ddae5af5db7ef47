"""Token counts with a public sentencepiece model (operator 5).

Texts become segments cut at safe places: a blank after a character that is neither white space nor U+2581, which the
model reads as a blank. No piece of the model has a blank behind another character, and the model's own leading blank
stands for the one cut away. Segments, not rows, fill the batches handed to the library, so every batch has about the
same number of bytes whatever the texts' lengths. Only lengths come back.

Defined results: a null text is the empty text with 0 bytes and 0 tokens; repeated rows each give their row; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import documents, ship, slices

SEGMENT_CHARS, BATCH_BYTES = 2048, 256 << 10
_CUT = re.compile(r"(?<=[^\s\u2581]) ")
_loaded: dict = {}


class PieceCounter:
    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def segments(self, text: str) -> list[str]:
        """Parts whose counts add up to the text's. A part that follows a cut has lost the blank before it."""
        if not self.cuts or len(text) <= SEGMENT_CHARS:
            return [text]
        out, at = [], 0
        while len(text) - at > SEGMENT_CHARS and (m := _CUT.search(text, at + SEGMENT_CHARS)):
            out.append(text[at : m.start()])
            at = m.end()
        return [*out, text[at:]]

    def count(self, texts: list[str]) -> np.ndarray:
        totals = np.zeros(len(texts), np.int64)
        parts, owners, held = [], [], 0

        def flush() -> None:
            lengths = [len(x) for x in self.model.encode(parts, out_type=int, num_threads=1)]
            np.add.at(totals, owners, lengths)

        for k, text in enumerate(texts):
            for n, part in enumerate(self.segments(text)):
                if n and not part:
                    totals[k] += 1  # a blank that ends the text is one piece
                    continue
                parts.append(part)
                owners.append(k)
                held += len(part) if part.isascii() else len(part.encode("utf-8"))
                if held >= BATCH_BYTES:
                    flush()
                    parts, owners, held = [], [], 0
        if parts:
            flush()
        return totals


def counter(model: str) -> PieceCounter:
    import public_tokenizers

    if model not in _loaded:
        _loaded[model] = PieceCounter(model if "/" in model else public_tokenizers.path(model))
    return _loaded[model]


def count_tokens(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row; a narrow map, no shuffle."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(model)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = pieces.count(texts)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_bytes": pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()),
                    "over_limit": pa.array(n > limit, pa.bool_()),
                }
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))
