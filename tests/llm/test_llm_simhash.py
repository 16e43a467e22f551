import random
import re

import numpy as np
import pytest
import xxhash
from llm_helpers import ODD, documents
from pyspark.sql import functions as F

from tillroll.llm import simhash
from tillroll.llm.common import keep_rows
from tillroll.llm.components import components
from tillroll.session import materialize


def brute_fingerprint(text, n=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, distance):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(i)
    return sorted(sorted(g) for g in groups.values())


def test_fingerprints_and_components_of_odd_documents(spark):
    got = simhash.simhash_components(documents(spark, ODD)).collect()
    assert sorted((r.fp % 2 ** 64 for r in got)) == sorted(brute_fingerprint(t) for _, t in ODD)
    ids = {}
    for d, t in ODD:
        if d is not None:
            ids.setdefault(brute_fingerprint(t), []).append(d)
    for r in got:
        near = [d for f, ds in ids.items() if (f ^ r.fp % 2 ** 64).bit_count() <= 2 for d in ds]
        assert r.component_id is None or r.component_id <= min(near)
    assert {r.component_id for r in got if r.fp == 0} == {3}  # texts without words are linked like any other


def planted(seed, n=300):
    """Random fingerprints, clouds of near ones and chains."""
    rng = random.Random(seed)
    fps = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(6):
        centre = rng.getrandbits(64)
        fps += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(40)]
        step = centre
        for _ in range(30):  # a chain: neighbours are linked, its ends are far apart
            step ^= sum(1 << b for b in rng.sample(range(64), 2))
            fps.append(step)
    return sorted(set(fps))


@pytest.mark.parametrize("distance,bucket", [(2, 128), (2, 1), (2, 8), (1, 128), (3, 128), (0, 4)])
def test_links_connect_all_that_are_near(spark, distance, bucket):
    fps = planted(distance)
    table = materialize(spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long"), "t_fps")
    found = simhash.links(table, distance, bucket)
    for r in found.collect():  # no false link either
        assert ((r.a ^ r.b) % 2 ** 64).bit_count() <= distance
    comps = components(found).collect()
    root = {int(np.uint64(f).view(np.int64)): int(np.uint64(f).view(np.int64)) for f in fps} | {r.node: r.root for r in comps}
    groups = {}
    for i, f in enumerate(fps):
        groups.setdefault(root[int(np.uint64(f).view(np.int64))], []).append(i)
    assert sorted(sorted(g) for g in groups.values()) == brute_components(fps, distance)


def test_dense_buckets_give_linear_links(spark):
    """A cloud in which all are near one another: far fewer links than pairs."""
    fps = sorted({(1 << a) | (1 << b) for a in range(64) for b in range(64)})
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    table = materialize(spark.createDataFrame(signed, "fp long"), "t_cloud")
    assert simhash.links(table, 2, 16).count() < 70 * len(fps)


def test_allocation_keeps_the_pigeonhole_sum():
    rng = np.random.default_rng(1)
    for n in (10, 10 ** 5, 10 ** 10):
        x = rng.integers(0, 2, (500, 64))
        x[:, 5] = x[:, 40]  # two bits that always agree lie in one partition
        both = (x.T @ x) * (n / 500)
        plan = simhash.allocate(both, n, 2)
        assert sum(t + 1 for _, t in plan) == 3
        bits = [b for g, _ in plan for b in g]
        assert len(bits) == len(set(bits))
        assert any({5, 40} <= set(g) or not {5, 40} & set(g) for g, _ in plan)
    assert len(simhash.allocate(both, 10 ** 10, 2)) < len(simhash.allocate(both / 10 ** 5, 10 ** 5, 2))


def test_components_of_hubs_chains_and_nothing(spark):
    edges = [(1, i) for i in range(2, 60)] + [(100 + i, 101 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 60)} == {1} and {got[100 + i] for i in range(51)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_the_smallest_id_of_each_group(spark):
    docs = documents(spark, ODD, extra=False)
    out = keep_rows(docs, simhash.representatives(docs)).collect()
    comps = {r.component_id for r in simhash.simhash_components(docs).collect()}
    assert sorted([r.doc_id for r in out], key=repr) == sorted(comps, key=repr)


def test_empty_table(spark):
    assert simhash.simhash_components(documents(spark, [])).count() == 0


def test_all_rows_of_one_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same words in every text").alias("text"))
    assert simhash.simhash_components(docs).select("component_id").distinct().collect() == [(0,)]
