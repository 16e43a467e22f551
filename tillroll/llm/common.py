"""Helpers shared by the llm operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name and taken by position.

    Extra columns cannot clash with what an operator adds, not even columns
    that differ from these in case only; of equal names the first counts.
    """
    at = [df.columns.index(n) for n in names]
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{i}").alias(n) for i, n in zip(at, names, strict=True)])


def row_key(doc_id: Column, text: Column) -> Column:
    """Identity of a document row by content: its id and the digest of its text."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")),
                       F.sha2(F.coalesce(text, F.lit("")), 256))


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose ``row_key`` is in ``keys`` (column ``key``).

    Of repeated rows (same id and same text) the one whose columns are smallest, nulls
    first, stays; maps and variants compare as JSON.  The join leaves rows with equal keys
    side by side, so dropping repeats shuffles nothing more.
    """
    names = docs.columns
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    doc_id, text = (F.col(f"_{names.index(n)}") for n in ("doc_id", "text"))
    order = [text.isNotNull()]  # within a key, texts differ only as null and empty
    for field in plain.drop("_" + str(names.index("text"))).schema:
        unordered = any(t in field.dataType.simpleString() for t in ("map<", "variant"))
        order.append(F.to_json(F.struct(field.name)) if unordered else F.col(field.name))
    kept = (plain.withColumn("_key", row_key(doc_id, text))
            .join(keys.select(F.col("key").alias("_key")).distinct(), "_key")
            .groupBy("_key").agg(F.min_by(F.struct(*plain.columns), F.struct(*order)).alias("_row")))
    return kept.select("_row.*").toDF(*names)


class ChunkTable:
    """Ids of texts whose chunks encode independently; each distinct chunk is encoded once.

    ``split`` cuts a text into chunks, ``encode_many`` gives the ids of a list of
    chunks, as bytes of 32-bit integers.  Chunks met recently are kept: once ``rows``
    are held they become the old generation, from which those still in use are
    taken over, so memory stays bounded and frequent chunks stay.  Chunks over
    ``LONG`` characters are not kept.
    """

    LONG = 200

    def __init__(self, split: Callable[[str], list[str]], encode_many: Callable[[list[str]], list[bytes]],
                 rows: int = 200_000):
        self.split, self.encode_many, self.rows = split, encode_many, rows
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, texts: list[str], end: bytes = b"") -> list[np.ndarray]:
        """Ids of each text as 32-bit integers, with those of ``end`` after them."""
        split = [self.split(t) for t in texts]
        known = self.young
        new = {c for parts in split for c in parts if c not in known}
        for chunk in new & self.old.keys():
            known[chunk] = self.old[chunk]
        todo = [c for c in new if c not in known]
        known.update(zip(todo, self.encode_many(todo), strict=True))
        out = [np.frombuffer(b"".join([known[c] for c in parts]) + end, "<u4") for parts in split]
        for chunk in todo:
            if len(chunk) > self.LONG:
                del known[chunk]
        if len(known) > self.rows:
            self.old, self.young = known, {}
        return out


def per_worker(key: tuple, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps between its tasks (models, chunk tables).

    Functions travel by value, so module globals are new in every task; a module
    entry of the process is not.  Losing a worker only loses the cache.
    """
    kept = sys.modules.setdefault("tillroll_worker_state", types.ModuleType("tillroll_worker_state")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
