"""The registered queries without SQL over whole small tables, against plain Python and the libraries."""
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from sentencepiece import SentencePieceProcessor
from test_llm_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

from tillroll.llm import queries

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()


def test_url_filter(spark):
    got = {r.page_id: r for r in queries.op1_url_filter(spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url").collect()
    assert len(got) == len(pages)
    for page_id, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [rule for rule in RULES if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0]))
                and path.startswith("/" + rule.split("/", 1)[1])]
        r = got[page_id]
        assert (r.host, r.path) == (host, path)
        if fits:
            best = max(fits, key=len)
            assert r.rule == best and r.verdict == RULES[best]
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


def test_packing(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in queries.op3_packing(spark, SF_SMALL).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(pieces) == {d for d, _ in docs}
    for doc_id, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sum(sum(r.length for r in w) not in (2048, 1024, 512, 256) for w in windows.values()) <= 1


def test_sentencepiece(spark, docs):
    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((d, len(ids := sp.encode(t or "")), sha(",".join(map(str, ids))), sha(sp.decode(ids))) for d, t in docs)
    assert sorted(tuple(r) for r in queries.op4_sentencepiece(spark, SF_SMALL).collect()) == want


def test_sharding(spark, docs):
    rows = {r.doc_id: r for r in queries.op5_sharding(spark, SF_SMALL).collect()}
    loads, slots, place = defaultdict(int), defaultdict(list), {}
    for doc_id, text in docs:
        r, raw = rows[doc_id], (text or "").encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw) and r.law == "bytes" and r.grown_shard is None
        assert place.setdefault(text or "", r.shard) == r.shard
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(loads) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = defaultdict(int)
    for doc_id, text in docs:
        groups[text or ""] += rows[doc_id].size
    assert max(loads.values()) - min(loads.values()) <= max(groups.values())


def test_simhash(spark, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, SF_SMALL).collect()}
    docs = sorted(docs, key=lambda d: d[0])
    prints = [brute_fingerprint(t) for _, t in docs]
    want = {}
    for group in brute_components(prints, 2):
        for i in group:
            want[docs[i][0]] = (f"{int(prints[i]) % 2 ** 64:016x}", min(docs[j][0] for j in group))
    assert got == want


def test_toxicity(spark, docs):
    rows = {r.doc_id: r for r in queries.op9_toxicity(spark, SF_SMALL).collect()}
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        r = rows[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert all(0 <= s.start < s.end <= len(text.lower()) for s in r.spans)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    judged = [(rows[d].predicted, y) for d, y in labels.items() if d in rows and rows[d].held_out and y is not None]
    assert judged and sum(p == y for p, y in judged) / len(judged) > 0.8
