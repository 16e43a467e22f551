import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_helpers import ODD, documents

from tillroll.llm import queries
from tillroll.llm.periodic_runs import WaveletTree, collapse, find_runs, words


def brute_runs(w):
    """(start, end, period) of all runs: for each period the stretches where words equal those a period on."""
    best = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b, q) for (a, b), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, plant=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if plant and doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return w, runs, " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic(rng):
    w = []
    while len(w) < rng.randint(20, 300):
        root = [rng.randint(0, 1) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 13, 16, 17, 31, 33]))]
        if rng.random() < 0.3:
            root = (root * 3)[:len(root) * 2 + rng.randint(0, 2)]
        many = rng.randint(1, 7)
        w += (root * many)[:len(root) * many - rng.randint(0, 2)]
    return w


def test_equals_brute_force():
    rng = random.Random(13)
    for i in range(400):
        w = periodic(rng) if i % 2 else [rng.randint(0, i % 3) for _ in range(rng.randint(1, 100))]
        assert [tuple(r) for r in find_runs(np.array(w), len(w)).tolist()] == brute_runs(w), w


def test_documents_searched_together_do_not_touch():
    rng = random.Random(14)
    docs = [periodic(rng) for _ in range(20)] + [[0] * 50, [0] * 50]
    codes = np.concatenate([np.array(d) + 10 * i for i, d in enumerate(docs)])
    starts = np.cumsum([0, *map(len, docs)])
    want = [(s + a, s + b, q) for s, d in zip(starts.tolist(), docs, strict=False) for a, b, q in brute_runs(d)]
    assert [tuple(r) for r in find_runs(codes, max(map(len, docs))).tolist()] == want


def test_wavelet_tree_counts_and_selects():
    rng = np.random.default_rng(2)
    for n in (1, 63, 64, 65, 500):
        values = rng.permutation(n)
        tree = WaveletTree(values, int(n).bit_length())
        lo = rng.integers(0, n, 200)
        hi = np.minimum(n, lo + rng.integers(1, n + 1, 200))
        x = rng.integers(0, n + 1, 200)
        assert tree.count_below(lo, hi, x).tolist() == [int((values[a:b] < y).sum()) for a, b, y in zip(lo, hi, x, strict=True)]
        k = rng.integers(0, 10 ** 6, 200) % (hi - lo)
        assert tree.smallest(lo, hi, k).tolist() == [int(np.sort(values[a:b])[i]) for a, b, i in zip(lo, hi, k, strict=True)]


def test_long_periods_and_long_runs():
    rng = random.Random(15)
    root = [rng.randint(0, 10 ** 6) for _ in range(20_000)]
    w = np.array([-1] * 7 + root * 4 + [-2] * 3)
    assert find_runs(w, len(w)).tolist() == [[0, 7, 1], [7, 7 + 80_000, 20_000]]
    assert find_runs(np.zeros(100_000, np.int64), 100_000).tolist() == [[0, 100_000, 1]]
    with pytest.raises(ValueError):
        find_runs(w, len(w), repeats=3)


def test_odd_documents(spark):
    rows = [*ODD, (20, "x " * 9), (21, " ".join(["p q r"] * 5) + " p q s"), (22, "a " * 5)]
    got = collapse(words(documents(spark, rows))).collect()
    want = []
    for d, t in rows:
        _, runs, left = brute_row(d, t, plant=False)
        want.append((d, [(a, b - a, q) for a, b, q in runs], left))
    assert sorted([(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got], key=repr) == sorted(want, key=repr)
    assert collapse(words(documents(spark, []))).count() == 0


def test_query_equals_brute_force(spark):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = []
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        _, runs, left = brute_row(r.doc_id, r.text)
        best = None
        for s, e, q in runs:
            if best is None or (e - s) * best[2] > best[1] * q:
                best = (s, e - s, q)
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
        want.append((r.doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, sha(lines), sha(left)))
    got = queries.op13_periodic_runs(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert any(r[1] for r in want)
