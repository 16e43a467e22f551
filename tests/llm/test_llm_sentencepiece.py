import random

import public_tokenizers
import pytest
from llm_helpers import ODD, documents
from sentencepiece import SentencePieceProcessor

from tillroll.llm.common import ChunkTable
from tillroll.llm.sentencepiece_codec import ChunkEncoder, decode, encode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return SentencePieceProcessor(model_file=MODEL)


def test_chunks_give_the_librarys_ids(sp):
    rng = random.Random(4)
    marks = [*" \t\n▁abAé0́‍\x00\x1c\x85\xa0　漢字😀<>/", "</s>", "<s>", "<0x41>", "▁▁", "    ", "the", "ing"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 25))) for _ in range(20000)] + ["", " ", "  ", "▁", "x" * 3000]
    encoder = ChunkEncoder(MODEL)
    assert encoder.by_chunk
    assert [x.tolist() for x in encoder.encode(texts)] == sp.encode(texts)
    encoder.by_chunk = False  # the way for models whose pieces cross markers
    assert [x.tolist() for x in encoder.encode(texts[:50])] == sp.encode(texts[:50])


def test_a_full_table_only_forgets():
    asked = []

    def lengths(chunks):
        asked.extend(chunks)
        return [len(c).to_bytes(4, "little") for c in chunks]

    table = ChunkTable(str.split, lengths, rows=8)
    for i in range(40):  # "a" is met in every text, the others once
        texts = [f"a b{i} c{'x' * i}", "a " + "f" * 500]
        assert [x.tolist() for x in table.ids(texts)] == [[len(w) for w in t.split()] for t in texts]
        assert len(table.young) <= 8 + 3 and "f" * 500 not in table.young
    assert asked.count("a") == 1 and asked.count("f" * 500) == 40


def test_round_trip_of_odd_documents(spark, sp):
    got = decode(encode(documents(spark, ODD), MODEL), MODEL).collect()
    want = [(d, sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for d, t in ODD]
    assert sorted([(r.doc_id, r.ids, r.text) for r in got], key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert decode(encode(documents(spark, []), MODEL), MODEL).count() == 0
