import zlib

import numpy as np
import pytest
from llm_helpers import ODD, documents
from pyspark.sql import functions as F

from tillroll.llm.sharding import difference, shard_documents


def test_differencing_accounts_for_every_byte():
    rng = np.random.default_rng(0)
    for n, k in ((1, 4), (2, 4), (50, 4), (300, 16)):
        parts = rng.integers(0, 100, (n, k))
        sums, went = difference(parts)
        total = np.zeros(k, int)
        for row, to in zip(parts, went, strict=True):
            assert sorted(to) == list(range(k))  # a renaming of the shards
            total[to] += row
        assert (total == sums).all() and (np.diff(sums) >= 0).all()
    assert difference(np.zeros((0, 4), int))[0].tolist() == [0] * 4


def test_differencing_balances_better_than_dealing():
    rng = np.random.default_rng(1)
    sizes = rng.lognormal(6, 2, 2000).astype(int) + 1
    parts = np.zeros((2000, 16), int)
    parts[:, 0] = sizes
    sums, _ = difference(parts)
    dealt = np.zeros(16)  # largest first, to the smallest shard
    for s in sorted(sizes, reverse=True):
        dealt[dealt.argmin()] += s
    assert sums.max() - sums.min() <= dealt.max() - dealt.min() <= sizes.max()


@pytest.mark.parametrize("bucket_groups", [20_000, 5])
def test_odd_documents(spark, bucket_groups):
    got = shard_documents(documents(spark, ODD), shards=4, bucket_groups=bucket_groups).collect()
    want = sorted((repr(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in ODD)
    assert sorted((repr(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    shards, slots = {}, {}
    for r in got:
        shards.setdefault((r["size"], r.text_crc32), set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in shards.values())  # equal texts stay together
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("bucket_groups", [20_000, 50, 7])
def test_shards_are_balanced_also_over_several_rounds(spark, bucket_groups):
    docs = spark.range(600).select(F.col("id").alias("doc_id"),
                                   F.concat(F.col("id").cast("string"), F.expr("repeat('x', int(id * id % 997))")).alias("text"))
    got = shard_documents(docs, 16, bucket_groups).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    sizes = [r.b for r in got]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 0.02 * sum(sizes) / 16


def test_hot_group_fills_a_shard_by_itself(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot" * 50))
                                   .otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    got = shard_documents(docs, 16).collect()
    hot = {r.shard for r in got if r["size"] == 151}
    assert len(hot) == 1 and {r["size"] for r in got if r.shard in hot} == {151}


def test_empty_table(spark):
    assert shard_documents(documents(spark, [])).count() == 0
