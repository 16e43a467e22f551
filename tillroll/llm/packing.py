"""Hierarchical packing of token ids into windows of several lengths.

Windows are 2048, 1024, 512 or 256 tokens long.  A document's whole windows of
the longest length are cut off first; what is left goes to the shortest window
length that holds it.  Windows are filled from the longest pieces down: the gap
beside a piece takes the longest shorter pieces that fit, and what then remains
is filled by cutting one more piece, so a window is only left open when a task
runs out of pieces.  Full windows are dealt to step groups, largest first, each
to the group with the fewest tokens, so groups hold equal numbers of tokens.

Every input partition packs its own rows in one pass with bounded memory (at
most ``ROUND_TOKENS`` waiting ids in ``ROUND_PIECES`` pieces, and ``BATCH_BYTES`` of texts beside one document); nothing is shuffled.  The
pieces left open at the end of a partition, fewer than one longest window each,
are written and packed again, ``MERGE`` partitions to a task, and only there the
last window of a task is padded.

Tokenising: ids of a text are the ids of its parts between blanks, since the
tokenizer drops white space and never merges across it.  Each worker keeps a
bounded table of the parts it has met; parts over ``LONG_PART`` characters are not kept.

Defined cases: a null or empty text is just the end id; repeated rows and null
ids are documents of their own; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import codecs
import heapq
import json
import os
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import per_worker, pick
from tillroll.session import materialize

SIZES = (2048, 1024, 512, 256)
ROUND_TOKENS = 2_000_000
ROUND_PIECES = 100_000
GROUP_TOKENS = 64 * 2048
MERGE = 64
BATCH_BYTES = 8 << 20
TABLE_ROWS = 400_000
LONG_PART = 200

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "window int, step_group long, ids binary")
ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                   ("window", pa.int32()), ("step_group", pa.int64()), ("ids", pa.binary())])


#: The normalizer and splitter for which ``PartTokenizer`` may encode plain words by themselves.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTER = {"type": "Split", "behavior": "Removed", "invert": True,
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}}


#: Letters whose lower case is one letter and that no normalizer changes; punctuation that never joins them.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"


class PartTokenizer:
    """Ids of texts by a whitespace-dropping tokenizer.

    Texts are cut at ASCII white space, and distinct parts found, in Arrow.  Each is looked up
    once a batch, in a table that keeps those met lately in two generations: once ``TABLE_ROWS``
    are held they become the old one, from which those still in use are taken over.  Ids
    are put back to their places in numpy.

    Most parts are Latin letters, then perhaps ASCII punctuation other than
    apostrophes.  Between the two the tokenizer's splitter always cuts, and all its
    normalizer does to such letters is to lower-case them; so these words go straight
    to the library's merges, past the costly steps before them, and the punctuation
    after them is looked up by itself.  All other parts take the whole tokenizer.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        self.tok, self.end_id = Tokenizer.from_file(path), end_id
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        norm, pre, suffix = conf["normalizer"] or {}, (conf["pre_tokenizer"] or {}).get("pretokenizers", [{}]), conf["model"].get("end_of_word_suffix")
        self.word = None
        if norm.get("normalizers") == NORMALIZERS and pre[0] == SPLITTER and [p["type"] for p in pre[1:]] == ["ByteLevel"] and suffix:
            self.word = re.compile(f"[{LETTERS}]+").fullmatch
            self.merges = Tokenizer.from_str(json.dumps(
                conf | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))
            shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
            hidden = [b for b in range(256) if b not in shown]
            chars = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
            self.byte_chars = "".join((chars | {32: " "})[b] for b in range(256))
            vocab = self.tok.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _lookup(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts."""
        found = list(map(self.young.get, parts))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        for i in gaps:
            found[i] = self.old.get(parts[i])
        new = [parts[i] for i in gaps if found[i] is None]
        words = [p for p in new if self.word(p)] if self.word else []
        ids = dict(zip(words, self._words(words), strict=True))
        rest = [p for p in new if p not in ids]
        for part, e in zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            ids[part] = np.array(e.ids, "<u4").tobytes()
        for i in gaps:
            if found[i] is None:
                found[i] = ids[parts[i]]
            if len(parts[i]) <= LONG_PART:
                self.young[parts[i]] = found[i]
        if len(self.young) > TABLE_ROWS:
            self.old, self.young = self.young, {}
        return found

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of plain words, many to a call: each word's last id ends a word, and no other does."""
        for at in range(0, len(words), 1000):
            some = words[at:at + 1000]
            line = codecs.charmap_decode(" ".join(some).lower().encode(), "strict", self.byte_chars)[0]
            ids = np.array(self.merges.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            stops, raw = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist(), ids.tobytes()
            yield from map(raw.__getitem__, map(slice, [0, *stops[:-1]], stops))

    def ids(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """Ids of each text as 32-bit integers, the end id after them."""
        rows = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = rows.flatten().dictionary_encode()
        parts, marks = coded.dictionary, pa.array([], pa.large_string())
        if self.word:
            cut = pc.extract_regex(parts, rf"^(?P<word>[{LETTERS}]+)(?P<marks>[{MARKS}]*)$")
            marks = pc.fill_null(pc.struct_field(cut, "marks"), "")
            parts = pc.coalesce(pc.struct_field(cut, "word"), parts)
        both = pa.concat_arrays([parts, marks]).dictionary_encode()
        found = self._lookup(both.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, end = np.frombuffer(b"".join(found), "<u4"), _ends(np.fromiter(map(len, found), np.int64, len(found)) // 4)
        if self.word:  # a part is a word and its marks
            ids, end = _take(ids, end, both.indices.to_numpy().reshape(2, -1).T.ravel())
            end = end[::2]
        ids, end = _take(ids, end, coded.indices.to_numpy())
        cuts = end[rows.offsets.to_numpy() - rows.offsets[0].as_py()].tolist()
        return [np.append(ids[a:b], np.uint32(self.end_id)) for a, b in pairwise(cuts)]


def _ends(size: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(size)])


def _take(ids: np.ndarray, end: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids, one behind the other and list i from ``end[i]`` on, taken by number; their ends."""
    size = np.diff(end)[which]
    out = _ends(size)
    return ids[np.repeat(end[which] - out[:-1], size) + np.arange(out[-1])], out


class Packer:
    """Packs pieces (length, doc_id, start, ids, doc_tokens) into windows; see the module text."""

    def __init__(self, sizes: tuple[int, ...] = SIZES):
        self.sizes = sorted(sizes, reverse=True)
        self.pool: list[tuple] = []  # by length; the second field makes the order total
        self.count, self.waiting, self.windows = 0, 0, []

    def add(self, doc_id: int | None, ids: np.ndarray, start: int = 0, doc_tokens: int | None = None) -> None:
        top, at, total = self.sizes[0], 0, len(ids) if doc_tokens is None else doc_tokens
        while len(ids) - at >= top:
            self.windows.append((top, [(top, 0, doc_id, start + at, ids[at:at + top], total)]))
            at += top
        if at < len(ids):
            self._put(doc_id, start + at, ids[at:], total)
        self.waiting += len(ids)

    def _put(self, doc_id, start, ids, total) -> None:
        self.count += 1
        insort(self.pool, (len(ids), self.count, doc_id, start, ids, total))

    def _head(self, piece: tuple, length: int) -> tuple:
        """The first ``length`` ids of a piece; the rest goes back to the pool."""
        _, n, doc_id, start, ids, total = piece
        self._put(doc_id, start + length, ids[length:], total)
        return (length, n, doc_id, start, ids[:length], total)

    def fill(self) -> list[tuple[int, list[tuple]]]:
        """All windows that can be filled; pieces of an open window stay in the pool."""
        while self.pool:
            first = self.pool.pop()
            size = next(s for s in reversed(self.sizes) if s >= first[0])
            window, gap = [first], size - first[0]
            while gap and self.pool:
                at = bisect_right(self.pool, (gap + 1,)) - 1
                piece = self.pool.pop(max(at, 0))
                if piece[0] > gap:
                    piece = self._head(piece, gap)
                window.append(piece)
                gap -= piece[0]
            if gap:
                for piece in window:
                    insort(self.pool, piece)
                break
            self.windows.append((size, window))
        full, self.windows, self.waiting = self.windows, [], sum(p[0] for p in self.pool)
        return full

    def finish(self) -> list[tuple[int, list[tuple]]]:
        """The open pieces as windows of falling size; only the last may be short."""
        out, left = [], sum(p[0] for p in self.pool)
        while left:
            size = next((s for s in self.sizes if s <= left), left)
            window, gap = [], size
            while gap:
                piece = self.pool.pop()
                if piece[0] > gap:
                    piece = self._head(piece, gap)
                window.append(piece)
                gap -= piece[0]
            out.append((size if size in self.sizes else self.sizes[0], window))
            left -= size
        return out


class Writer:
    """Numbers windows and step groups of one task and turns them into rows."""

    def __init__(self, stage: int, group_tokens: int, with_ids: bool):
        self.next = self.group = (TaskContext.get().partitionId() * 2 + stage) << 31
        self.group_tokens, self.with_ids = group_tokens, with_ids

    def batch(self, windows: list[tuple[int, list[tuple]]]) -> pa.RecordBatch:
        loads = [(0, self.group + g) for g in range(max(1, round(sum(s for s, _ in windows) / self.group_tokens)))]
        self.group += len(loads)
        rows = []
        for size, window in sorted(windows, key=lambda w: -w[0]):
            tokens, group = heapq.heappop(loads)
            heapq.heappush(loads, (tokens + size, group))
            offset = 0
            for length, _, doc_id, start, ids, total in window:
                raw = ids.tobytes()
                rows.append((doc_id, start, length, zlib.crc32(raw), total, self.next, offset, size, group,
                             raw if self.with_ids else None))
                offset += length
            self.next += 1
        return _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, sizes: tuple[int, ...] = SIZES,
         group_tokens: int = GROUP_TOKENS, round_tokens: int = ROUND_TOKENS, with_ids: bool = False,
         round_pieces: int = ROUND_PIECES) -> DataFrame:
    """One row per piece: where it lies in its document and in its window.

    Windows are filled when ``round_tokens`` ids or ``round_pieces`` pieces wait; fewer pieces than
    the longest window has ids are then left, so very short texts take no more memory than others.

    ``ids`` holds the piece's ids (little-endian unsigned 32-bit) if ``with_ids``.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = per_worker(("parts", tokenizer, end_id), lambda: PartTokenizer(tokenizer, end_id))
        packer, writer = Packer(sizes), Writer(0, group_tokens, with_ids)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).fill_null("")
            part = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // BATCH_BYTES
            for at, to in pairwise([0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]):
                for doc_id, ids in zip(doc_ids[at:to], tok.ids(texts[at:to]), strict=True):
                    packer.add(doc_id, ids)
                    if packer.waiting >= round_tokens or len(packer.pool) >= round_pieces:
                        yield writer.batch(packer.fill())
        yield writer.batch(packer.fill())
        yield _batch([(d, start, n, 0, total, None, None, None, None, ids.tobytes())
                      for n, _, d, start, ids, total in packer.pool])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, writer = Packer(sizes), Writer(1, group_tokens, with_ids)
        for batch in batches:
            for d, start, total, ids in zip(*(batch.column(c).to_pylist() for c in (0, 1, 4, 9)), strict=True):
                packer.add(d, np.frombuffer(ids, "<u4"), start, total)
        yield writer.batch(packer.fill() + packer.finish())

    packed = materialize(pick(docs, "doc_id", "text").mapInArrow(first, PIECES).withColumn(
        "part", F.spark_partition_id()), "packed")
    open_pieces = packed.filter("sequence_id IS NULL")
    parts = (packed.agg(F.max("part")).first()[0] or 0) + 1
    tasks = -(-parts // MERGE)
    merged = (open_pieces.repartition(tasks, F.floor(F.col("part") / MERGE))
              .sortWithinPartitions("part", "doc_id", "start").drop("part").mapInArrow(second, PIECES))
    return packed.filter("sequence_id IS NOT NULL").drop("part").unionByName(merged)
