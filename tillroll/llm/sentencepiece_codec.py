"""SentencePiece encoding and decoding through a table of distinct chunks.

A chunk is a run of whitespace markers with the characters that follow it.  If
no piece of the model has a marker after another character, no merge crosses
the start of a chunk, so a text's ids are its chunks' ids one after another.
Each worker keeps a table of the distinct chunks it has met, lets the library
segment each of them once, and joins ids back by position.  The table holds at
most ``TABLE_ROWS`` chunks and starts anew when full; chunks of more than
``LONG_CHUNK`` characters are segmented without being stored.  Both only bound
memory; every text is encoded whole.

A table for the whole corpus, joined back through shuffles, was weighed and left
out: a row for each word and position is about three times the input.

A model whose pieces can cross markers (or without the leading marker) is
encoded text by text with the library: the same ids, only slower.

Defined cases: a null or empty text has no ids and decodes to an empty text;
repeated rows and null ids each give a row; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import ChunkTable, per_worker, pick

MARK = "▁"
BATCH_ROWS = 256
TABLE_ROWS = 300_000


class ChunkEncoder:
    """Exactly the library's ids, with each distinct chunk segmented once."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.sp = SentencePieceProcessor(model_file=model)
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()))
        self.by_chunk = (self.sp.normalize("a") == MARK + "a" and self.sp.normalize(f"a{MARK} b") == f"{MARK}a{MARK * 2}b"
                         and not any(MARK in p.lstrip(MARK) for p in pieces))
        chunks = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.table = ChunkTable(lambda t: chunks(self.sp.normalize(t)) if t else [], self._segment, TABLE_ROWS)

    def _segment(self, chunks: list[str]) -> list[bytes]:
        """The library puts the first marker back, except before nothing."""
        mark = [self.sp.piece_to_id(MARK)]
        return [array("I", ids or mark).tobytes() for ids in self.sp.encode([c[1:] for c in chunks], num_threads=1)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.by_chunk:
            return self.table.ids(texts)
        return [np.array(ids, "<u4") for ids in self.sp.encode(texts, num_threads=1)]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and the ids of each whole text, without begin or end ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("chunks", model), lambda: ChunkEncoder(model))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(offsets, np.concatenate(ids).view(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), lists], ["doc_id", "ids"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and the library's decoding of them as ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = [sp.decode(i or []) for i in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 ["doc_id", "ids", "text"])

    return pick(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
