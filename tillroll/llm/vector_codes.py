"""Vector code compression: product codebooks by Lloyd rounds over resident members.

Components become floor(scale * x); vectors are cut into equal parts, and each part
position has a codebook of its own.  A part is a member of the owner
(position, entry, salt): the salt splits entries that many parts share.  Members lie
in blocks (the parts of one owner that a task found together) in written
generations.  The first generation holds all parts, shuffled once to their owners.
A round reads the generations where they lie, leaves the members whose entry is
unchanged in place, and shuffles only the parts that change entry: these are the
next generation.  A member has left its block if some codebook since then gave it
another entry, which its reader sees from the codebooks (positions x entries rows
each), so a generation is never rewritten.  Owners update their entries from what
they hold: sums of the members that stay come out of the round's scan, those of
the arrivals out of the new generation, and sums of sums are exact decimals.

Distances are exact integers: as doubles while they stay below 2**53, then as 64-bit
integers, then as integers without bound.

Defined cases: vectors that are null or hold a null or non-finite component are
dropped.  The length in use is the commonest that the number of positions divides
(ties: the longer); rows of another length, empty vectors too, come out with null codes
and error.  Rows with equal ids are rows of their own, null ids come last among the
rows that give the first entries, equal ids in order of their vectors.  Fewer kept
rows than entries give as many entries as rows.  An empty table gives an empty
result.  Components of 2**62 / scale or more are an error (``ValueError``), as is an
error sum that does not fit a long.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tillroll.llm.common import pick
from tillroll.session import delete_path, scratch_path

BLOCK = 4096
STRIP = 4096
BLOCKS = "position int, entry int, salt int, members binary, count long, sums array<decimal(38,0)>"
ARROW = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("members", pa.binary()),
                   ("count", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0)))])
Book = list[np.ndarray]  # of each position: entries x components


def usable(vector: Column) -> Column:
    """A vector without null or non-finite components."""
    def finite(x: Column) -> Column:
        return F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))
    return vector.isNotNull() & F.forall(vector, finite)


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and vector (integers) of the rows that take part."""
    kept = pick(vectors, "vec_id", "embedding", "label").filter(usable(F.col("embedding")))
    return kept.select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("vector"))


def _length_in_use(vectors: DataFrame, positions: int, scale: int) -> tuple[int, int] | None:
    """The common length and the largest magnitude of a component; None without rows."""
    sizes = (pick(vectors, "embedding").filter(usable(F.col("embedding")))
             .groupBy(F.size("embedding").alias("length"))
             .agg(F.count(F.lit(1)).alias("n"),
                  F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))).alias("largest"))
             .filter((F.col("length") > 0) & (F.col("length") % positions == 0)))
    row = sizes.orderBy(F.desc("n"), F.desc("length")).first()
    if row is None:
        return None
    if row.largest * scale >= 2 ** 62:
        raise ValueError(f"a component of {row.largest} times {scale} is not a 64-bit integer")
    return row.length, int(row.largest * scale) + 1


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry (ties: the lowest) and the squared distance, exactly."""
    reach = int(np.abs(parts).max(initial=0)) + int(np.abs(entries).max(initial=0))
    bound = parts.shape[1] * reach * reach
    kind = np.float64 if bound < 2 ** 51 else np.int64 if bound < 2 ** 61 else object
    p, e = parts.astype(kind), entries.astype(kind)
    distances = (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)
    at = distances.argmin(1)
    least = distances[np.arange(len(at)), at]
    return at.astype(np.int32), least if kind is object else least.astype(np.int64)


def _sum(parts: np.ndarray) -> list[int]:
    wide = parts.astype(np.int64) if len(parts) * (int(np.abs(parts).max(initial=0)) + 1) < 2 ** 62 else parts.astype(object)
    return [int(x) for x in wide.sum(0)]


class Found:
    """What a task has found: blocks of parts for their new owners, and sums of members that stay."""

    def __init__(self, salts: int):
        self.salts, self.next_salt = salts, TaskContext.get().partitionId()
        self.waiting: dict[tuple[int, int], list[np.ndarray]] = defaultdict(list)
        self.held = 0
        self.totals: dict[tuple[int, int], list[int]] = {}

    def moved(self, position: int, parts: np.ndarray, to: np.ndarray) -> None:
        for entry in np.unique(to).tolist():
            self.waiting[position, entry].append(parts[to == entry])
        self.held += len(parts)

    def stayed(self, position: int, entry: int, parts: np.ndarray) -> None:
        if len(parts):
            new = [len(parts), *_sum(parts)]
            old = self.totals.get((position, entry))
            self.totals[position, entry] = [a + b for a, b in zip(old, new, strict=True)] if old else new

    def blocks(self) -> pa.RecordBatch:
        """The waiting parts as blocks; the owner's salt changes with every batch of blocks."""
        rows = [{"position": p, "entry": e, "salt": self.next_salt % self.salts, "members": np.concatenate(parts).tobytes()}
                for (p, e), parts in self.waiting.items()]
        self.waiting.clear()
        self.held, self.next_salt = 0, self.next_salt + 1
        return pa.RecordBatch.from_pylist(rows, ARROW)

    def sums(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"position": p, "entry": e, "salt": self.next_salt % self.salts, "count": n, "sums": list(map(Decimal, total))}
             for (p, e), (n, *total) in self.totals.items()], ARROW)


def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


class Lloyd:
    """The rounds over one table of integer vectors; generations lie below ``folder``."""

    def __init__(self, spark: SparkSession, rows: DataFrame, length: int, largest: int, positions: int, folder: str):
        self.spark, self.rows, self.folder = spark, rows, folder
        self.positions, self.length, self.width = positions, length, length // positions
        self.kind = next(k for k, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if largest < 2 ** bits)
        self.salts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def first_book(self, entries: int) -> Book:
        """The parts of the rows with the smallest ids; ``entries`` rows reach the driver."""
        first = self.rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
        whole = np.array([r.vector for r in first], dtype=np.int64)
        return np.split(whole, self.positions, axis=1)

    def settle(self, book: Book) -> None:
        """Generation 1: every part goes to the owner of its nearest entry."""
        positions, width, length, kind, salts = self.positions, self.width, self.length, self.kind, self.salts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = Found(salts)
            for batch in batches:
                for at in range(0, batch.num_rows, STRIP):
                    whole = matrix(batch.column(0).slice(at, STRIP), length).astype(kind)
                    for p in range(positions):
                        parts = whole[:, p * width:(p + 1) * width]
                        found.moved(p, parts, nearest(parts, book[p])[0])
                    if found.held >= BLOCK * positions:
                        yield found.blocks()
            yield found.blocks()

        self._store(self.rows.select("vector").mapInArrow(run, BLOCKS), 1)

    def move(self, books: list[Book], generation: int) -> None:
        """Parts whose entry changes with the newest book go to its owner, as a new generation."""
        width, kind, salts = self.width, self.kind, self.salts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = Found(salts)
            for batch in batches:
                for row in batch.to_pylist():
                    position, entry = row["position"], row["entry"]
                    parts = np.frombuffer(row["members"], kind).reshape(-1, width)
                    for book in books[row["generation"]:-1]:  # residents: those that no book since has moved
                        parts = parts[nearest(parts, book[position])[0] == entry]
                    now = nearest(parts, books[-1][position])[0]
                    found.stayed(position, entry, parts[now == entry])
                    found.moved(position, parts[now != entry], now[now != entry])
                    if found.held >= BLOCK * 8:
                        yield found.blocks()
            yield found.blocks()
            yield found.sums()

        held = self.spark.read.schema(f"{BLOCKS}, generation int").parquet(self.folder).filter("members IS NOT NULL")
        self._store(held.select("generation", "position", "entry", "members").mapInArrow(run, BLOCKS), generation)

    def _store(self, found: DataFrame, generation: int) -> None:
        (found.repartition("position", "entry", "salt").write.option("compression", "zstd")
         .parquet(f"{self.folder}/generation={generation}"))

    def update(self, book: Book, generation: int) -> Book:
        """Entries as the floored means of their members, from the newest generation: the sums
        of members that stayed and the arrivals.  Positions x entries x components rows reach the driver."""
        width, kind = self.width, self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[tuple[int, int], list[int]] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    if row["members"] is None:
                        new = [row["count"], *map(int, row["sums"])]
                    else:
                        parts = np.frombuffer(row["members"], kind).reshape(-1, width)
                        new = [len(parts), *_sum(parts)]
                    key = row["position"], row["entry"]
                    totals[key] = [a + b for a, b in zip(totals[key], new, strict=True)] if key in totals else new
            yield pa.RecordBatch.from_pylist([{"position": p, "entry": e, "salt": 0, "count": n, "sums": list(map(Decimal, s))}
                                              for (p, e), (n, *s) in totals.items()], ARROW)

        newest = self.spark.read.schema(BLOCKS).parquet(f"{self.folder}/generation={generation}").mapInArrow(run, BLOCKS)
        sums = (newest.select("position", "entry", "count", F.posexplode("sums").alias("component", "sum"))
                .groupBy("position", "entry", "component").agg(F.sum("count").alias("count"), F.sum("sum").alias("sum")))
        out = [entries.copy() for entries in book]
        for r in sums.collect():
            out[r.position][r.entry, r.component] = int(r["sum"]) // r["count"]
        return out


def codebooks(vectors: DataFrame, positions: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[int, Book] | None:
    """The length in use and the codebook of each position; None if no row takes part."""
    found = _length_in_use(vectors, positions, scale)
    if found is None:
        return None
    length, largest = found
    spark = vectors.sparkSession
    rows = integers(vectors, scale).filter(F.size("vector") == length)
    folder = scratch_path(spark, "lloyd")
    lloyd = Lloyd(spark, rows, length, largest, positions, folder)
    try:
        books = [lloyd.first_book(entries)]
        for generation in range(1, rounds + 1):
            if generation == 1:
                lloyd.settle(books[0])
            else:
                lloyd.move(books, generation)
            books.append(lloyd.update(books[-1], generation))
    finally:
        delete_path(spark, folder)
    return length, books[-1]


def encode(vectors: DataFrame, length: int, book: Book, scale: int = 4096) -> DataFrame:
    """vec_id, label, codes (index of the nearest entry, by position) and error of every kept row.

    ``length`` and ``book`` as from ``codebooks``; no books give null codes.
    """
    rows = integers(vectors, scale)
    width = length // max(len(book), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STRIP):
                part = batch.slice(at, STRIP)
                fits = (part.column(2).value_lengths().to_numpy(zero_copy_only=False) == length) & (length > 0)
                whole = matrix(part.column(2).filter(pa.array(fits)), length)
                found = [nearest(whole[:, p * width:(p + 1) * width], entries) for p, entries in enumerate(book)]
                error = [sum(e) for e in zip(*(f[1].tolist() for f in found), strict=True)]
                codes = list(zip(*(f[0].tolist() for f in found), strict=True))
                rows_of = np.where(fits, np.cumsum(fits) - 1, -1).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([codes[i] if i >= 0 else None for i in rows_of], pa.list_(pa.int32())),
                     pa.array([error[i] if i >= 0 else None for i in rows_of], pa.int64())],
                    ["vec_id", "label", "codes", "error"])

    kept = [f for f in rows.schema.fields if f.name != "vector"]
    return rows.mapInArrow(run, StructType([*kept, StructField("codes", ArrayType(IntegerType())), StructField("error", LongType())]))
