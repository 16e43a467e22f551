"""Runs of repeated words, found by internal pattern matching.

A run is a stretch of words with smallest period q that holds ``repeats`` (four)
periods or more and ends where the period does.  For each block length b (powers of
two) the blocks that start at multiples of b/2 stand for the periods from b/2 to
b - 1: a run with such a period holds a block together with its copy one period
on.  So each block asks for its occurrences in the window of the next b/2 to b - 1
positions.  The block's equals are one range of the suffix array, and a wavelet tree
over that array counts those before the window and hands out the ones inside by
number (range successor).  Three or more occurrences in a window are a progression
whose step is the block's own period; then only the last can be a run's smallest period
(two copies that overlap by a step or more would force a smaller one), so the first
two and the last are all the candidates.  Candidates of one period that touch are
joined and stretched to where the period ends; of equal stretches the one with the
smallest period is the run.

Words are numbered per document, so documents are searched together, some
``CHUNK_WORDS`` words at a time, without ever matching each other, and positions whose
block occurs nowhere else in its document drop out of the sort and the tree.

Defined cases: a null or empty text has no words and no runs; a text of any length is
one search of its own, whole; repeated rows and null ids each give a row; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import pick

CHUNK_WORDS = 200_000
REPEATS, SHORTEST = 4, 6
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class WaveletTree:
    """Counts and selections over ranges of an array of integers below 2**bits, many at a time.

    One bit vector a level, highest bit first, zeros before ones; bits are packed, with the
    number of ones before each 64.
    """

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (values >> bit & 1).astype(bool)
            padded = np.zeros((len(ones) // 64 + 1) * 64, bool)
            padded[:len(ones)] = ones
            packed = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.levels.append((bit, packed, before, len(ones) - int(ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[i >> 6] + np.bitwise_count(packed[i >> 6] & mask)

    def count_below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values at lo to hi - 1 are below x."""
        count = np.zeros(len(lo), np.int64)
        for bit, packed, before, zeros in self.levels:
            lo1, hi1 = self._ones(packed, before, lo), self._ones(packed, before, hi)
            up = (x >> bit & 1).astype(bool)
            count += np.where(up, hi - hi1 - lo + lo1, 0)
            lo, hi = np.where(up, zeros + lo1, lo - lo1), np.where(up, zeros + hi1, hi - hi1)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with k smaller ones among those at lo to hi - 1."""
        out = np.zeros(len(lo), np.int64)
        for bit, packed, before, zeros in self.levels:
            lo1, hi1 = self._ones(packed, before, lo), self._ones(packed, before, hi)
            low = hi - hi1 - lo + lo1
            up = k >= low
            out |= up.astype(np.int64) << bit
            k = np.where(up, k - low, k)
            lo, hi = np.where(up, zeros + lo1, lo - lo1), np.where(up, zeros + hi1, hi - hi1)
        return out


def _occurrences(codes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Sort suffixes by their first 1, 2, 4 ... words while blocks recur, up to blocks of ``longest``.

    Yields (block length, suffix array, rank of each position, size of its group); the
    rank is where the group of equal blocks begins in the array, 0-sized groups are done.
    """
    n = len(codes)
    array = np.argsort(codes, kind="stable")
    key, slots = codes[array], np.arange(n)
    rank, size, block = np.zeros(n, np.int64), np.zeros(n, np.int64), 1
    while True:
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(heads, len(key)))
        positions = array[slots]
        rank[positions] = np.repeat(slots[heads], sizes)
        size[positions] = np.repeat(sizes, sizes)
        yield block, array, rank, size
        slots = slots[np.repeat(sizes, sizes) > 1]
        if block * 2 > longest or not len(slots):
            return
        positions = array[slots]
        after = positions + block
        then = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        key = rank[positions] * (n + 1) + then + 1
        order = np.argsort(key, kind="stable")
        array[slots], key = positions[order], key[order]
        size[:] = 0
        block *= 2


def candidates(codes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block length b, starts, periods): blocks that occur again b/2 to b - 1 positions on.

    ``longest``: the longest block to look at.
    """
    asked, member, array = [], None, None
    for block, array, rank, size in _occurrences(codes, longest):
        if block == 1:
            continue
        again = np.flatnonzero(size > 1)
        if member is None:  # of the suffix array only what recurs as a pair of words is needed
            member = np.zeros(len(codes), bool)
            member[again] = True
        starts = again[again % (block // 2) == 0]
        asked.append((block, starts, rank[starts], size[starts]))
    if not asked or not member.any():
        return
    in_tree = member[array]
    place = np.cumsum(in_tree) - in_tree
    tree = WaveletTree(array[in_tree].astype(np.int64), len(codes).bit_length())
    for block, starts, lo, sizes in asked:
        lo = place[lo]
        hi = lo + sizes
        first = tree.count_below(lo, hi, starts + block // 2)
        beyond = tree.count_below(lo, hi, np.minimum(starts + block, len(codes)))
        hit = np.flatnonzero(beyond > first)
        starts, lo, hi, first, beyond = (x[hit] for x in (starts, lo, hi, first, beyond))
        more = np.flatnonzero(beyond - first > 1)
        most = np.flatnonzero(beyond - first > 2)
        s = np.concatenate([starts, starts[more], starts[most]])
        found = np.concatenate([tree.smallest(lo, hi, first), tree.smallest(lo[more], hi[more], first[more] + 1),
                                tree.smallest(lo[most], hi[most], beyond[most] - 1)])
        if len(s):
            yield block, s, found - s


def _stretch(codes: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How far from ``at`` words equal those a period on, to the right (step > 0) or left, in strides of ``step``."""
    n, todo = len(codes), np.arange(len(at))
    at = at.copy()
    offsets = np.arange(step) if step > 0 else -1 - np.arange(-step)
    while len(todo):
        i = at[todo][:, None] + offsets
        j = i + period[todo][:, None]
        same = (i >= 0) & (j < n)
        same &= codes[np.clip(i, 0, n - 1)] == codes[np.clip(j, 0, n - 1)]
        whole = same.all(1)
        at[todo] += np.where(whole, abs(step), same.argmin(1)) * (1 if step > 0 else -1)
        todo = todo[whole]
    return at


def find_runs(codes: np.ndarray, longest: int, repeats: int = REPEATS, shortest: int = SHORTEST) -> np.ndarray:
    """Runs (start, end, period) in an array of integers, by start, then period.

    ``longest``: the longest stretch that a run can have (that of a document).
    ``repeats``: at least four, which the windows rely on.
    """
    if repeats < 4:
        raise ValueError("a run needs at least four periods")
    found = [np.zeros((0, 3), np.int64)]
    for block, starts, periods in candidates(codes, max(2, longest // repeats * 2)):
        order = np.lexsort((starts, periods))
        starts, periods = starts[order], periods[order]
        heads = np.append(True, (periods[1:] != periods[:-1]) | (starts[1:] - starts[:-1] > block))
        tails = np.append(heads[1:], True)
        period = periods[heads]
        begin = _stretch(codes, starts[heads], period, -(block // 2))
        end = _stretch(codes, starts[tails] + block, period, block // 2) + period
        long = end - begin >= np.maximum(shortest, repeats * period)
        found.append(np.stack([begin, end, period], axis=1)[long])
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    same = np.append(False, (runs[1:, :2] == runs[:-1, :2]).all(1))[:len(runs)]
    runs = runs[~same]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def words(docs: DataFrame) -> DataFrame:
    """doc_id and the words of each whole text."""
    return pick(docs, "doc_id", "text").select(
        "doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"))


def _search(lists: pa.ListArray) -> list[pa.Array]:
    """Runs and collapsed text of each of some lists of words."""
    flat = lists.flatten()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    number = flat.dictionary_encode()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    codes = doc * (len(number.dictionary) + 1) + number.indices.to_numpy(zero_copy_only=False)
    runs = find_runs(codes, int(sizes.max(initial=0))) if len(codes) else np.zeros((0, 3), np.int64)
    owner = np.searchsorted(offsets, runs[:, 0], side="right") - 1
    fields = [runs[:, 0] - offsets[owner], runs[:, 1] - runs[:, 0], runs[:, 2]]
    run_offsets = np.searchsorted(owner, np.arange(len(sizes) + 1)).astype(np.int32)
    run_lists = pa.ListArray.from_arrays(run_offsets, pa.StructArray.from_arrays([pa.array(f) for f in fields], fields=list(RUN)))
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    kept_before = np.concatenate([[0], np.cumsum(kept)])
    left = pa.ListArray.from_arrays(kept_before[offsets].astype(np.int32), flat.filter(pa.array(kept)))
    return [run_lists, pc.binary_join(left, " ")]


def collapse(tokenised: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period of each, by start, then period) and the text with
    every run cut down to its first period, words joined by one blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < batch.num_rows:
                done = int(ends[at - 1]) if at else 0
                upto = max(at + 1, int(np.searchsorted(ends, done + CHUNK_WORDS, side="right")))
                part = batch.slice(at, upto - at)
                yield pa.RecordBatch.from_arrays([part.column(0), *_search(part.column(1))], ["doc_id", "runs", "collapsed"])
                at = upto

    kind = tokenised.schema["doc_id"].dataType.simpleString()
    return pick(tokenised, "doc_id", "words").mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")
