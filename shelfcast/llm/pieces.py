"""SentencePiece encoding and decoding by a table of distinct chunks.

When no piece of the model holds anything before a whitespace marker, pieces
cannot cross from one marked word to the next, so a text's ids are those of
its marked words in turn. Each task keeps a table from marked word to ids,
segments each distinct word once, and joins the ids back by position. A line
feed that no piece holds ends a chunk as well. The table is emptied when it
reaches ``table_size`` words, so memory is bounded and results don't depend
on it. Nothing is shuffled.

The model must replace spaces by markers, add a marker in front and change
nothing else; ``check_model`` raises an error otherwise.

Nulls and ties: a null text is the empty text (begin and end ids only); rows
are independent, so repeated rows and null ids simply give a row each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

MARK = "▁"
RESULT = "doc_id long, n_tokens long, ids binary, decoded string, ids_sha256 string, decoded_sha256 string"


class ChunkEncoder:
    def __init__(self, model: bytes, table_size: int = 200_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.table_size = table_size
        self.table: dict[str, bytes] = {}
        check_model(self.model)
        self.line_feed = np.array(self._ids("\n")[1:], "<u4").tobytes()
        self.around = len(self._ids("\n"))
        self.split = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+").findall
        self.begin = np.array([self.model.bos_id()], "<u4").tobytes()
        self.end = np.array([self.model.eos_id()], "<u4").tobytes()

    def _ids(self, text: str) -> list[int]:
        return self.model.encode(text)

    def _segment(self, chunk: str) -> bytes:
        if chunk == "\n":
            return self.line_feed
        if chunk[0] == MARK:  # the model itself adds the first marker
            ids = self._ids(chunk[1:]) if len(chunk) > 1 else [self.model.piece_to_id(MARK)]
        else:
            ids = self._ids("\n" + chunk)[self.around:]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, with begin and end."""
        if not text:
            return self.begin + self.end
        chunks = self.split(MARK + text.replace(" ", MARK))
        table = self.table
        if len(table) > self.table_size:
            table.clear()
        out = []
        for chunk in chunks:
            ids = table.get(chunk)
            if ids is None:
                ids = table[chunk] = self._segment(chunk)
            out.append(ids)
        return self.begin + b"".join(out) + self.end

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


def check_model(model) -> None:
    """Raise ValueError unless pieces stay within marked words and lines."""
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if MARK in piece.lstrip(MARK) or "\n" in piece:
            raise ValueError(f"piece {piece!r} crosses the end of a chunk")
    probe = f"  a  b{MARK}c ﬁ\n\n d "
    if model.decode(model.encode(probe)) != probe.replace(MARK, " "):
        raise ValueError("the model normalizes texts")


def round_trip(docs: DataFrame, model: bytes, texts: bool = True) -> DataFrame:
    """Ids, their number and hash, and the decoded text and its hash of every
    document. ``model``: the model file's bytes. ids and decoded are null
    unless ``texts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(model)
        for batch in batches:
            ids = [encoder.encode(t) for t in C.text_column(batch).to_pylist()]
            back = [encoder.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids if texts else [None] * len(ids), pa.binary()), pa.array(back if texts else [None] * len(ids), pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string()),
            ], names=["doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
