"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are made in one pass over whole texts.  The search works on
distinct fingerprints, so copies meet as one row and are never paired.

The 64 bits are split into partitions, bits that agree or disagree together in
the corpus in the same one.  Each partition gets its own threshold t_i (-1: not
looked at); if the thresholds plus one add up to more than the wanted distance,
every linked pair is within t_i in some partition.  Number of partitions and
thresholds come from dynamic programming on estimated candidates and probes,
from bit counts over all distinct fingerprints.  Every fingerprint is put into
the index by the exact value of each partition and probes all values within t_i;
pairs that meet are verified by their bit distance inside the join.

A bucket of more than ``BUCKET`` fingerprints is not paired.  All its members and
all that probe it go to an exact second way without pairs: each gives out its 64
neighbours at one bit and itself.  Two fingerprints share such a value exactly if
they differ in at most two bits, so all that share one (at most 65) are linked to
the smallest.  Work stays linear in the fingerprints, however many near copies
there are.  This way exists for a distance of 2, the production value; for others
every bucket is paired in full.

Defined cases: a null or empty text has fingerprint zero and is linked like any
other; a null id is left out of component ids, a component without ids has a null
one; repeated rows each give a row; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import pick, row_key
from tillroll.llm.components import components
from tillroll.session import materialize

BITS = 64
BUCKET = 128
#: One verified pair costs about as much as this many shuffled probe rows.
PAIR_COST = 0.05


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The text's SimHash: bit b is set if it is set in over half the shingles' hashes."""
    import xxhash

    found = text.encode().lower().split()  # bytes: only A-Z, only ASCII white space
    if not found:
        return 0
    grams = map(b" ".join, zip(*(islice(found, i, None) for i in range(shingle)))) if len(found) >= shingle else [b" ".join(found)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, with_key: bool = False) -> DataFrame:
    """doc_id, key (see ``row_key``; else null) and fp, the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py() or "", shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "key", "fp"])

    rows = pick(docs, "doc_id", "text")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), 
                       (row_key(F.col("doc_id"), F.col("text")) if with_key else F.lit(None).cast("string")).alias("key"),
                       "text").mapInArrow(run, "doc_id long, key string, fp long")


def bit_counts(fps: DataFrame) -> np.ndarray:
    """64x64 table over all fingerprints: how many have both bits set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(raw), 1 << 14):
                x = np.unpackbits(np.ascontiguousarray(raw[at:at + (1 << 14)]).view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").astype(np.float32)
                total += (x.T @ x).astype(np.int64)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         ["i", "j", "n"])

    rows = fps.select("fp").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((BITS, BITS))
    for i, j, n in rows:
        out[i, j] = n
    return out


def partition_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Split the bits into partitions of equal size, correlated bits together (greedily)."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [free.pop(int(np.argmax(corr[np.ix_(free, free)].sum(1))))] if free else []
        while len(group) < size:
            group.append(free.pop(int(np.argmax(corr[np.ix_(free, group)].sum(1)))))
        out.append(sorted(group))
    return out


def _ball(width: int, radius: int) -> int:
    return sum(len(list(combinations(range(width), r))) for r in range(radius + 1))


def allocate(both: np.ndarray, n: int, distance: int) -> list[tuple[list[int], int]]:
    """Partitions and thresholds of least estimated cost: [(bits, threshold)].

    The chance that two fingerprints are within t in a partition is taken from the
    bits' chances to agree; the sum of thresholds for m partitions is distance - m + 1.
    """
    p = np.diag(both) / max(n, 1)
    agree = p * p + (1 - p) ** 2
    best: tuple[float, list] = (np.inf, [])
    for m in range(1, distance + 2):
        groups = partition_bits(both, n, m)
        costs = []  # per partition: cost of thresholds -1 .. distance
        for bits in groups:
            apart = np.zeros(distance + 2)
            apart[0] = 1.0
            for b in bits:  # distribution of the bit distance within the partition
                apart[1:], apart[0] = apart[1:] * agree[b] + apart[:-1] * (1 - agree[b]), apart[0] * agree[b]
            costs.append([0.0] + [n * (1 + _ball(len(bits), t)) + PAIR_COST * n * n / 2 * apart[:t + 1].sum()
                                  for t in range(distance + 1)])
        # by partition: cheapest cost for each sum of (threshold + 1)
        want = distance + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (c, ts) in table.items():
                for t in range(-1, distance + 1):
                    if used + t + 1 <= want and c + cost[t + 1] < step.get(used + t + 1, (np.inf,))[0]:
                        step[used + t + 1] = (c + cost[t + 1], [*ts, t])
            table = step
        if table[want][0] < best[0]:
            best = (table[want][0], [(g, t) for g, t in zip(groups, table[want][1], strict=True) if t >= 0])
    return best[1]


def _signed(bits: tuple[int, ...] | list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(fps: DataFrame, distance: int, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within ``distance`` bits.

    ``fps``: a written table of distinct fingerprints, column fp.
    """
    plan = allocate(bit_counts(fps), fps.count(), distance)
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))

    def keys(i: int, bits: list[int], radius: int):
        own = F.col("fp").bitwiseAND(F.lit(_signed(bits)))
        masks = [_signed(c) for r in range(radius + 1) for c in combinations(bits, r)]
        flips = F.array(*[F.lit(m) for m in masks])
        return F.transform(flips, lambda m: F.struct(F.lit(i).alias("part"), own.bitwiseXOR(m).alias("value")))

    def table(which: str) -> DataFrame:
        arrays = [keys(i, bits, t if which == "probe" else 0) for i, (bits, t) in enumerate(plan)]
        return fps.select(F.explode(F.concat(*arrays)).alias("k"), "fp").select("k.part", "k.value", "fp")

    index = table("index")
    counts = index.groupBy("part", "value").count()
    split = distance == 2
    probe = index if all(t == 0 for _, t in plan) else table("probe")
    if split:
        large = materialize(counts.filter(F.col("count") > bucket).select("part", "value"), "large")
        paired = counts.filter(F.col("count") <= bucket)
    else:
        paired = counts
    if probe is index:  # then a fingerprint alone in its bucket has no partner there
        paired = paired.filter("count > 1")
    small = index.join(materialize(paired.select("part", "value"), "paired"), ["part", "value"], "left_semi")
    edges = (probe.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), ["part", "value"])
             .filter((F.col("a") < F.col("b")) & (far <= distance)).select("a", "b"))
    if split and not large.isEmpty():
        dense = materialize(probe.join(large, ["part", "value"], "left_semi").select("fp").distinct(), "dense")
        around = F.array(F.lit(0), *[F.lit(_signed([b])) for b in range(BITS)])
        near = dense.select("fp", F.explode(F.transform(around, lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))
        edges = edges.unionByName(
            near.groupBy("at").agg(F.collect_set("fp").alias("near")).filter(F.size("near") > 1)
            .select(F.array_min("near").alias("a"), F.explode("near").alias("b")).filter("a <> b").distinct())
    return edges


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 2, bucket: int = BUCKET,
                       with_key: bool = False) -> DataFrame:
    """One row per document: doc_id, key, fp, root (a fingerprint of the component), component_id.

    ``component_id`` is the smallest id that links reach, the document's own included.
    """
    rows = materialize(fingerprints(docs, shingle, with_key), "fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fps")
    roots = materialize(components(links(fps, distance, bucket)), "roots")
    known = materialize(fps.join(roots, fps.fp == roots.node, "left")
                        .select("fp", F.coalesce("root", "fp").alias("root"), "least"), "rooted")
    ids = materialize(known.groupBy("root").agg(F.min("least").alias("component_id")), "component_ids")
    named = materialize(known.select("fp", "root").join(ids, "root"), "named")
    return rows.join(named, "fp").select("doc_id", "key", "fp", "root", "component_id")


def representatives(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """Keys (see ``row_key``) of the rows that stay: of each component the one with the smallest id."""
    found = simhash_components(docs, shingle, distance, with_key=True)
    return found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")).select("first.key")
