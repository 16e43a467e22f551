import hashlib

import pytest
from llm_helpers import ODD, documents
from pyspark.sql import functions as F

from tillroll.llm.common import keep_rows
from tillroll.llm.exact_dedup import exact_dedup, identities, kept_keys


def expected(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row, by comparing whole texts."""
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for d, t in rows:
        ids = groups[t or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((d, keep, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 4, 2048])
def test_equals_comparing_whole_texts(spark, block):
    rows = [(d, t[:60] if t and block == 1 else t) for d, t in ODD]
    got = exact_dedup(documents(spark, rows), block_bytes=block).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == expected(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})  # one row of each text, of repeated rows too
    assert all(r.doc_id == r.keep_id for r in kept)


def test_blocks_that_share_a_hash_are_told_apart(spark):
    rows = [(i, f"{i % 7} " * (i % 5 + 1) + "z" * (i % 3)) for i in range(80)]
    weak = exact_dedup(documents(spark, rows), block_bytes=4, block_hash=lambda b: F.xxhash64(b) % 3).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in weak], key=repr) == expected(rows)


def test_lengths_do_not_collide(spark):
    """Texts that are repetitions of one block, of every number of blocks."""
    rows = [(i, "abcd" * i) for i in range(1, 40)]
    ids = identities(documents(spark, rows), block_bytes=4).collect()
    assert len({(r.level, r.name) for r in ids}) == len(rows)


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).count() == 0


def test_main_path_is_native(spark):
    plan = exact_dedup(documents(spark, ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stage_keeps_one_row_of_each_text_with_all_columns(spark):
    docs = documents(spark, ODD, extra=False).withColumn("source", F.lit("s"))
    out = keep_rows(docs, kept_keys(docs)).collect()
    assert out[0].__fields__ == ["doc_id", "text", "source"]
    assert len(out) == len({t or "" for _, t in ODD})
    assert {r.doc_id for r in out if r.text == "a b c d"} == {2}


def test_of_repeated_rows_the_smallest_stays(spark):
    rows = [(1, "a", "fr", {"k": 2}), (1, "a", "en", {"k": 1}), (1, "a", "en", {"k": 0}), (2, "", None, None), (2, None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, more map<string,int>")
    want = [(1, "a", "en", {"k": 0}), (2, None, "x", None)]
    for parts in (1, 5):
        for order in (docs, docs.orderBy("lang")):
            assert sorted(map(tuple, keep_rows(order.repartition(parts), kept_keys(docs)).collect())) == want
