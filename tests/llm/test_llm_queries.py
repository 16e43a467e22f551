"""Every registered query of the llm operators over the small tables: SQL twins and brute force."""
import math

import duckdb
import pytest
from conftest import SF_SMALL
from llm_helpers import by

import corpus_pipeline
from tillroll.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = duck.sql(queries.ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    want = [dict(zip(want.columns, r, strict=True)) for r in want.fetchall()]
    assert by([r.asDict() for r in got.collect()], *columns) == by(want, *columns)


def test_queries_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def test_conversation_digests(spark, duck):
    said = "</s>[INST] ok [/INST]"
    duck.execute(f"""CREATE OR REPLACE VIEW turns AS SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') t FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{said}'), (-1, 1, 'assistant', '{said}')""")
    want = duck.sql("""SELECT conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn)) turns_sha256,
        coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT loss_chars,
        sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (r = 'assistant'), '')) loss_sha256 FROM turns GROUP BY 1""")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    want = [dict(zip(names, r, strict=True)) for r in want.fetchall()]
    got = queries.op10_chat(spark, SF_SMALL).collect()
    assert by(got, *names) == by(want, *names) and all(r.formatted_chars > 0 for r in got)


def test_pipeline_equals_its_stages_by_brute_force(spark, duck):
    """Each stage judged on its own input, against plain Python."""
    from test_llm_simhash import brute_components, brute_fingerprint

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact dedup", "SimHash near-dedup", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF_SMALL)
    assert clean.columns == columns
    rows = clean.collect()
    unique = {}
    for r in rows:
        if r.text not in unique or unique[r.text].doc_id < r.doc_id:
            unique[r.text] = r
    once = stages["exact dedup"](spark, clean, SF_SMALL)
    assert once.columns == columns and by(once.collect(), *columns) == by(unique.values(), *columns)
    left = sorted(unique.values(), key=lambda r: r.doc_id)
    groups = brute_components([brute_fingerprint(r.text) for r in left], 2)
    near = stages["SimHash near-dedup"](spark, once, SF_SMALL)
    assert near.columns == columns and by(near.collect(), *columns) == by([left[g[0]] for g in groups], *columns)
    packed = stages["packing"](spark, near, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == {left[g[0]].doc_id for g in groups}
    run = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert by(run, "doc_id", "start", "length", "ids_crc32") == by(packed, "doc_id", "start", "length", "ids_crc32")
