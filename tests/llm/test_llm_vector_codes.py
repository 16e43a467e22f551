import hashlib
import math
import random

import numpy as np
import pytest
from conftest import SF_SMALL

from tillroll.llm import queries, vector_codes
from tillroll.llm.vector_codes import codebooks, encode, nearest


def brute(rows, positions=8, entries=16, rounds=6, scale=4096):
    """Codes, errors and codebooks in plain Python; rows are (vec_id, vector, label)."""
    kept = [(i, [math.floor(scale * float(x)) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    w = len(kept[0][1]) // positions
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    book = [[v[p * w:(p + 1) * w] for _, v, _ in first] for p in range(positions)]

    def assign(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(v[p * w:(p + 1) * w], e, strict=True)) for e in book[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        found = [[assign(v, p)[0] for p in range(positions)] for _, v, _ in kept]
        for p in range(positions):
            for e in range(len(book[p])):
                mine = [v[p * w:(p + 1) * w] for (_, v, _), f in zip(kept, found, strict=True) if f[p] == e]
                if mine:
                    book[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = []
    for i, v, label in kept:
        got = [assign(v, p) for p in range(positions)]
        out.append((i, label, [c for c, _ in got], sum(d for _, d in got)))
    return out, book


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows],
                                 f"vec_id long, embedding array<{kind}>, label int, salt string, VECTOR string")


def check(spark, rows, kind="double", **kw):
    vectors = frame(spark, rows, kind)
    length, book = codebooks(vectors, **kw) or (0, [])
    got = sorted(((r.vec_id, r.label, r.codes, r.error) for r in encode(vectors, length, book).collect()), key=repr)
    want, want_book = brute(rows, **kw)
    assert got == sorted(want, key=repr)
    assert [b.tolist() for b in book] == want_book


def test_equals_brute_force(spark):
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += [rows[3]] * 40 + [(None, rows[5][1], None), (7, rows[8][1], 3), (200, None, 1), (201, [None] * 16, 1),
                              (202, [float("nan")] * 16, 2), (203, [float("inf")] + [0.0] * 15, 2), (204, [0.0] * 16, None)]
    check(spark, rows)


def test_fewer_rows_than_entries_ties_and_empty_tables(spark):
    check(spark, [(1, [0.5] * 8, 1), (2, [0.5] * 8, 1), (3, [-0.5] * 8, None)])
    assert codebooks(frame(spark, [])) is None
    assert codebooks(frame(spark, [(1, None, 1), (2, [], 1)])) is None
    assert [r.codes for r in encode(frame(spark, [(2, [], 1)]), 0, []).collect()] == [None]


def test_wide_components_stay_exact(spark):
    rng = random.Random(3)
    for reach in (2.0 ** 6, 2.0 ** 14, 2.0 ** 17):
        check(spark, [(i, [rng.uniform(-reach, reach) for _ in range(8)], i % 3) for i in range(60)], rounds=3)
    with pytest.raises(ValueError):
        codebooks(frame(spark, [(1, [1e300] * 8, 1)]))
    wide = np.array([[2 ** 40, -2 ** 40]])
    assert nearest(wide, np.array([[0, 0], [2 ** 40, 2 ** 40]]))[1].tolist() == [2 ** 81]


def test_other_lengths_come_out_without_codes(spark):
    rows = [(i, [0.1 * i] * 8, 1) for i in range(5)] + [(9, [0.1] * 7, 1), (10, [], 1), (11, [0.1] * 16, 1)]
    vectors = frame(spark, rows)
    length, book = codebooks(vectors)
    got = {r.vec_id: r.codes for r in encode(vectors, length, book).collect()}
    assert length == 8 and {i for i, c in got.items() if c is None} == {9, 10, 11}


def test_only_parts_that_change_entry_move(spark, tmp_path):
    """Generations after the first hold exactly the parts whose entry changed in that round."""
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], 1) for i in range(300)]
    folder = str(tmp_path / "lloyd")
    ints = vector_codes.integers(frame(spark, rows), 4096)
    lloyd = vector_codes.Lloyd(spark, ints, 8, 2 ** 15 + 1, 8, folder)
    books = [lloyd.first_book(16)]
    lloyd.settle(books[0])
    books.append(lloyd.update(books[0], 1))
    lloyd.move(books, 2)
    v = np.array([r.vector for r in ints.collect()])
    changed = sum(int((nearest(v[:, [p]], books[0][p])[0] != nearest(v[:, [p]], books[1][p])[0]).sum()) for p in range(8))
    size = np.dtype(lloyd.kind).itemsize

    def parts(g):
        blocks = spark.read.parquet(f"{folder}/generation={g}").filter("members IS NOT NULL").collect()
        return sum(len(r.members) for r in blocks) // size

    assert parts(1) == 300 * 8 and parts(2) == changed > 0


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    want, book = brute([(r.vec_id, r.embedding, r.label) for r in table.collect()])
    sha = hashlib.sha256(",".join(str(x) for b in book for e in b for x in e).encode()).hexdigest()
    totals = {}
    for _, label, _, error in want:
        totals[label] = totals.get(label, 0) + error
    want = sorted((i, "".join(f"{c:02x}" for c in codes), error, totals[label], sha) for i, label, codes, error in want)
    got = queries.op11_vector_codes(spark, SF_SMALL)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == want
