"""Exact top-k search by tiled matrix products.

Vectors are packed into tiles, queries into tiles of their own.  Both sides are
dealt to a grid of tasks (a candidate tile to every column, a query tile to every
row of the grid), so each pair of tiles meets in exactly one task; the grid's
shape keeps what is copied to a minimum.  A task multiplies the tiles, keeps the
best k of each query per tile, and merges them; the lists of the tasks are then
merged in a tree of fixed fan-in.  No task holds more than a few tiles or lists.

Components become floor(64 * x) and all sums are exact: as doubles where they
stay below 2**53, else as 64-bit integers, else as integers without bound.

Defined cases: vectors that are null or hold a null or non-finite component take
no part; a component of 2**57 or more, whose integer is no long, and a score that is no
long are errors; only vectors of equal length are compared (an empty one scores 0 with
other empty ones); a query's own rows are all rows with its id; repeated query rows
(same id and vector) are one query; rows with a null id are candidates that come
last among ties; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import pick
from tillroll.session import materialize

TILE = 8192
QUERY_TILE = 2048
STRIP = 1024
FAN_IN = 16
HELD_LISTS = 64
LIMIT = float(2 ** 57)
NO_ID = 2 ** 63 - 1
NO_SCORE = -2 ** 63

TILES = "tile long, dim int, ids binary, matrix binary"
LISTS = "query_tile long, part long, query_ids binary, ids binary, scores binary"


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array of floor(64 * x)) of the rows that take part."""
    def scaled(x: Column) -> Column:
        x = x.cast("double")
        return F.when(F.abs(x) < LIMIT, F.floor(x * 64)).otherwise(F.raise_error(F.lit("a component of 2**57 or more")).cast("long"))

    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return (pick(vectors, "vec_id", "embedding").filter(F.col("embedding").isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", scaled).alias("vector")))


def tiles(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed into matrices of at most ``size`` rows of equal length, by ascending id.

    A matrix has 32-bit integers if all of its fit, else 64-bit ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, tuple[list, list]] = {}

        def tile(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, parts = (np.concatenate(x) for x in waiting.pop(dim))
            order = np.argsort(ids, kind="stable")
            number += 1
            if np.abs(parts).max(initial=0) < 2 ** 31:
                parts = parts.astype("<i4")
            return pa.RecordBatch.from_pylist([{"tile": number - 1, "dim": dim, "ids": ids[order].tobytes(),
                                                "matrix": parts[order].tobytes()}], schema)

        schema = pa.schema([("tile", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary())])
        for batch in batches:
            for at in range(0, batch.num_rows, STRIP):
                part = batch.slice(at, STRIP)
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                dims = part.column(1).value_lengths().to_numpy()
                flat = part.column(1).flatten().to_numpy()
                starts = np.cumsum(dims) - dims
                for dim in np.unique(dims).tolist():
                    own = np.flatnonzero(dims == dim)
                    matrix = flat[starts[own][:, None] + np.arange(dim)].astype("<i8").reshape(len(own), dim)
                    kept = waiting.setdefault(dim, ([], []))
                    kept[0].append(ids[own].astype("<i8"))
                    kept[1].append(matrix)
                    if sum(map(len, kept[0])) + STRIP > size:
                        yield tile(dim)
        for dim in list(waiting):
            yield tile(dim)

    return rows.mapInArrow(run, TILES)


def merge(ids: list[np.ndarray], scores: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k of lists side by side: higher scores first, then smaller ids."""
    all_ids, all_scores = np.concatenate(ids, 1), np.concatenate(scores, 1)
    # a missing place is the lowest score, so it comes last; ~x instead of -x cannot overflow
    order = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]
    return np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_scores, order, 1)


def best_of_tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, matrix: np.ndarray,
                 k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the best k rows of a tile (ids ascending) for each query."""
    dim = queries.shape[1]
    bound = dim * float(np.abs(queries).max(initial=0)) * float(np.abs(matrix).max(initial=0))
    kind = np.float64 if (bound + 1) * STRIP < 2 ** 53 else np.int64 if bound < 2 ** 62 else object
    left, best = queries.astype(kind), None
    for at in range(0, len(ids), STRIP):
        some, some_ids = matrix[at:at + STRIP].astype(kind), ids[at:at + STRIP]
        scores = left @ some.T
        own = np.searchsorted(some_ids, query_ids), np.searchsorted(some_ids, query_ids, "right")
        hits = [(q, slice(a, b)) for q, a, b in zip(np.flatnonzero(own[0] < own[1]), *(x[own[0] < own[1]] for x in own), strict=True)]
        if len(some_ids) > k and (bound + 1) * STRIP < 2 ** 62:
            # one number orders by score, then by position, which is by id
            key = scores * STRIP + np.arange(STRIP - 1, STRIP - 1 - len(some_ids), -1, dtype=kind)
            for q, where in hits:
                key[q, where] = -(bound + 1) * STRIP
            top = np.argpartition(key, len(some_ids) - k, axis=1)[:, -k:]
        else:
            top = np.broadcast_to(np.arange(len(some_ids)), scores.shape)
        out = np.take_along_axis(scores, top, 1).astype(np.int64)
        found = some_ids[top]
        mine = found == query_ids[:, None]
        out[mine] = NO_SCORE
        found = np.where(mine, NO_ID, found)
        best = (found, out) if best is None else merge([best[0], found], [best[1], out], k)
    return merge([best[0]], [best[1]], k)


def _matrix(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    wide = len(row["matrix"]) > 4 * len(ids) * row["dim"]
    return ids, np.frombuffer(row["matrix"], "<i8" if wide else "<i4").reshape(len(ids), row["dim"])


def search(queries: DataFrame, vectors: DataFrame, k: int = 20, tile: int = TILE, query_tile: int = QUERY_TILE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's best ``k`` of all vectors but its own rows.

    Both inputs have columns vec_id and embedding.
    """
    spark = vectors.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = quantised(queries).filter("vec_id IS NOT NULL").distinct()
    asked = materialize(tiles(wanted, query_tile), "query_tiles")
    given = materialize(tiles(quantised(vectors), tile), "tiles")
    rows, cols = max(1, given.count()), max(1, asked.count())
    # a grid with at least one task per core's worth; queries are the smaller side and are copied more
    tasks = max(width, rows * cols // 16)
    down = min(rows, max(1, round((tasks * rows / cols) ** 0.5)))
    across = min(cols, -(-tasks // down))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            for row in batch.to_pylist():
                ids, matrix = _matrix({"ids": row["ids"], "matrix": row["matrix"], "dim": row["dim"]})
                query_ids, query = _matrix({"ids": row["query_ids"], "matrix": row["query_matrix"], "dim": row["dim"]})
                new = best_of_tile(query_ids, query, ids, matrix, k)
                if old := held.get(row["query_tile"]):
                    new = merge([old[1], new[0]], [old[2], new[1]], k)
                held[row["query_tile"]] = (row["query_ids"], *new)
                if len(held) > HELD_LISTS:
                    yield pa.RecordBatch.from_pandas(_lists(held, part), preserve_index=False)
                    held = {}
        if held:
            yield pa.RecordBatch.from_pandas(_lists(held, part), preserve_index=False)

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        n = len(np.frombuffer(pdf.query_ids[0], "<i8"))
        ids, scores = ([np.frombuffer(x, "<i8").reshape(n, -1) for x in pdf[c]] for c in ("ids", "scores"))
        return _lists({pdf.query_tile[0]: (pdf.query_ids[0], *merge(ids, scores, k))}, int(pdf.part[0]) // FAN_IN)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids = np.frombuffer(row["query_ids"], "<i8")
                ids, scores = (np.frombuffer(row[c], "<i8").reshape(len(query_ids), -1) for c in ("ids", "scores"))
                q, r = np.nonzero(scores > NO_SCORE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[q]), pa.array((r + 1).astype(np.int32)),
                     pa.array(ids[q, r], mask=ids[q, r] == NO_ID), pa.array(scores[q, r])],
                    ["query_id", "rank", "vec_id", "score"])

    left = given.select("dim", "ids", "matrix", F.pmod(F.xxhash64("tile"), F.lit(down)).cast("int").alias("down"),
                        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"))
    right = asked.select("dim", F.col("tile").alias("query_tile"), F.col("ids").alias("query_ids"),
                         F.col("matrix").alias("query_matrix"), F.pmod(F.xxhash64("tile"), F.lit(across)).cast("int").alias("across"),
                         F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("down"))
    at = ["dim", "down", "across"]
    lists = left.repartition(tasks, *at).join(right.repartition(tasks, *at), at).mapInArrow(multiply, LISTS)
    while tasks > 1:
        lists = lists.groupBy("query_tile", F.floor(F.col("part") / FAN_IN)).applyInPandas(gather, LISTS)
        tasks = -(-tasks // FAN_IN)
    return lists.mapInArrow(rows_of, "query_id long, rank int, vec_id long, score long")


def _lists(held: dict, part: int) -> pd.DataFrame:
    return pd.DataFrame([(t, part, q, ids.astype("<i8").tobytes(), scores.astype("<i8").tobytes())
                         for t, (q, ids, scores) in held.items()],
                        columns=["query_tile", "part", "query_ids", "ids", "scores"])
