"""Shards of near-equal bytes by Karmarkar-Karp differencing.

Documents with equal texts are one indivisible group.  The differencing starts
with a partial partition per group (its bytes in one shard, nothing in the
others) and repeatedly combines the two partial partitions of largest spread,
the fullest shard of one with the emptiest of the other.

To spread the work, groups are dealt to buckets of about ``BUCKET_GROUPS``.  Each
bucket is differenced to one partial partition in a task of its own; these are
partial partitions like any other, so the same step combines up to ``BUCKET_GROUPS``
of them in the next round, until one is left.  A round's rows are one small tuple
per bucket, and each round says how the shards of every bucket are renamed.

Rows are numbered within a shard without gathering it: counted by shard and
chunk, the chunks' counts summed, and numbered inside each chunk.  All rounds
read written tables.

Defined cases: a null text has size 1 and is grouped with the empty one; repeated
rows and null ids each get a slot; a group larger than the mean shard fills one by
itself; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import pick
from tillroll.session import materialize

SHARDS = 16
BUCKET_GROUPS = 20_000
CHUNK_ROWS = 50_000


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows: bytes by shard) to one.

    Returns its bytes by shard, ascending, and for every row where each of its
    shards went.
    """
    n, k = parts.shape
    if not n:
        return np.zeros(k, np.int64), np.empty((0, k), np.int64)
    # node: sums ascending; where: (child, child's slot for each own slot) twice; leaves: own columns by size
    order = np.argsort(parts, axis=1, kind="stable")
    sums: list = np.take_along_axis(parts, order, 1).tolist()
    places: list = [None] * n
    heap = [(s[0] - s[-1], i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        merged = sorted((x + y, i) for i, (x, y) in enumerate(zip(sums[a], reversed(sums[b]), strict=True)))
        own = [s for s, _ in merged]
        places.append((a, b, [i for _, i in merged]))
        sums[a] = sums[b] = None
        sums.append(own)
        heapq.heappush(heap, (own[0] - own[-1], len(sums) - 1))
    went = np.empty((n, k), np.int64)
    target: list = [None] * len(places)
    target[-1] = list(range(k))
    for node in range(len(places) - 1, -1, -1):
        to = target[node]
        if node < n:
            went[node, order[node]] = to
        else:
            a, b, slots = places[node]
            ta, tb = [0] * k, [0] * k
            for mine, i in zip(to, slots, strict=True):
                ta[i] = mine
                tb[k - 1 - i] = mine
            target[a], target[b], target[node] = ta, tb, None
    return np.array(sums[-1], np.int64), went


def balance(groups: DataFrame, shards: int = SHARDS, bucket_groups: int = BUCKET_GROUPS) -> DataFrame:
    """key, shard for groups with columns key and bytes (one row per key; a written table)."""
    buckets = max(1, -(-groups.count() // bucket_groups))
    sums = ", ".join(f"s{i} long" for i in range(shards))
    went = ", ".join(f"w{i} int" for i in range(shards))
    names = [f"s{i}" for i in range(shards)]

    def start(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "key"], ascending=False, ignore_index=True)
        parts = np.zeros((len(pdf), shards), np.int64)
        parts[:, 0] = pdf.bytes
        total, to = difference(parts)
        out = pd.DataFrame({"key": pdf.key, "slot": to[:, 0], "node": pdf.node})
        for i in range(shards):
            out[f"s{i}"] = [total[i], *[0] * (len(pdf) - 1)]
        return out

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        total, to = difference(pdf[names].to_numpy(np.int64))
        out = pd.DataFrame({"node": pdf.node, "parent": pdf.parent})
        for i in range(shards):
            out[f"w{i}"] = to[:, i]
            out[f"s{i}"] = [total[i], *[0] * (len(pdf) - 1)]
        return out

    placed = materialize(
        groups.select("key", "bytes", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("node"))
        .groupBy("node").applyInPandas(start, f"key string, slot int, node long, {sums}"), "placed")
    nodes = placed.groupBy("node").agg(*[F.sum(c).alias(c) for c in names])
    shard = placed.select("key", "slot", "node")
    while buckets > 1:
        buckets = -(-buckets // bucket_groups)
        step = materialize(nodes.withColumn("parent", F.pmod(F.xxhash64(F.col("node") + 1), F.lit(buckets)))
                           .groupBy("parent").applyInPandas(combine, f"node long, parent long, {went}, {sums}"), "combined")
        slots = step.select("node", "parent", F.array(*[f"w{i}" for i in range(shards)]).alias("went"))
        shard = shard.join(slots, "node").select("key", F.col("went")[F.col("slot")].alias("slot"), F.col("parent").alias("node"))
        nodes = step.groupBy(F.col("parent").alias("node")).agg(*[F.sum(c).alias(c) for c in names])
    return shard.select("key", F.col("slot").alias("shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, bucket_groups: int = BUCKET_GROUPS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 within the shard) of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = materialize(pick(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("key")), "slim")
    groups = materialize(slim.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    shard_of = materialize(balance(groups, shards, bucket_groups), "shards")
    chunks = max(1, -(-slim.count() // CHUNK_ROWS))
    rows = materialize(slim.join(shard_of, "key").withColumn("chunk", F.pmod(F.xxhash64("rid"), F.lit(chunks)))
                       .drop("key"), "dealt")
    counts = rows.groupBy("shard", "chunk").count()
    before = counts.select("shard", "chunk", (F.sum("count").over(
        Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("rid")) - 1
    return (rows.withColumn("inside", inside).join(before, ["shard", "chunk"])
            .select("doc_id", "size", "text_crc32", "shard", (F.coalesce("before", F.lit(0)) + F.col("inside")).alias("slot")))
