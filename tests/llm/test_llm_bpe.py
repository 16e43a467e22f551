import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from llm_helpers import ODD, documents
from tokenizers import Tokenizer

from tillroll.llm import queries
from tillroll.llm.bpe_codec import SpeculativeEncoder, decode, encode

WORDS, BYTES = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(WORDS)


def odd_texts(n):
    rng = random.Random(12)
    marks = [*" \t\n▁abAé0́‍\x00\x1c\x85\xa0　漢字😀<>/'", "'s", "'RE", "<|endoftext|>", "<|startoftext|>", "<|",
             "    ", "the", "ing", "aaaa", "ßÄÖµªİſ"]
    out = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 25))) for _ in range(n)]
    out += ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(1, 14))) for _ in range(n)]
    return out + ["".join(rng.choice("an!=-.") for _ in range(rng.randint(1, 30))) for _ in range(n)] + ["", " ", "x" * 5000]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_are_the_librarys(path):
    encoder, texts = SpeculativeEncoder(path), odd_texts(5000)
    assert encoder.merges.sound and encoder.by_chunk == (path == WORDS)
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want
    assert 0 < encoder.words_merged < encoder.words_seen  # some proposals hold, some fail


def test_every_pair_of_neighbours_is_told_right():
    """All pairs of tokens of a small vocabulary against merging their strings."""
    rules = [["a", "b"], ["b", "a"], ["a", "a"], ["ab", "a"], ["aa", "aa"], ["c", "ab"], ["aba", "b"], ["ba", "c"], ["cab", "aa"]]
    vocab = {t: i for i, t in enumerate(["a", "b", "c", *[x + y for x, y in rules]])}
    from tillroll.llm.bpe_codec import Merges
    merges = Merges(vocab, rules)
    lib = Tokenizer.from_str(json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
                                         "pre_tokenizer": None, "post_processor": None, "decoder": None,
                                         "model": {"type": "BPE", "vocab": vocab, "merges": rules}}))
    for t, i in vocab.items():
        assert merges.reached[i] == (lib.encode(t).ids == [i])
    good = [(x, y) for x in vocab for y in vocab if merges.reached[vocab[x]] and merges.reached[vocab[y]]]
    fine = merges.compatible(np.array([vocab[x] for x, _ in good]), np.array([vocab[y] for _, y in good]))
    for (x, y), ok in zip(good, fine.tolist(), strict=True):
        assert ok == (lib.encode(x + y).ids == [vocab[x], vocab[y]]), (x, y)


def test_a_vocabulary_with_two_ways_to_a_token_is_left_to_the_library(tmp_path):
    rules = [["a", "b"], ["b", "c"], ["ab", "c"], ["a", "bc"]]  # abc twice
    vocab = {t: i for i, t in enumerate(["a", "b", "c", "ab", "bc", "abc"])}
    conf = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
            "pre_tokenizer": {"type": "Whitespace"}, "post_processor": None, "decoder": None,
            "model": {"type": "BPE", "vocab": vocab, "merges": rules}}
    path = tmp_path / "two.json"
    path.write_text(json.dumps(conf))
    encoder = SpeculativeEncoder(str(path))
    texts = ["abc bc abcabc", "a", "ccba"]
    assert not encoder.merges.sound
    assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in Tokenizer.from_file(str(path)).encode_batch(texts)]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_round_trip_of_odd_documents(spark, path):
    tok = Tokenizer.from_file(path)
    got = decode(encode(documents(spark, ODD), path), path).collect()
    want = [(d, ids := tok.encode(t or "", add_special_tokens=False).ids, tok.decode(ids, skip_special_tokens=False)) for d, t in ODD]
    assert sorted([(r.doc_id, r.ids, r.text) for r in got], key=repr) == sorted(want, key=repr)
    assert decode(encode(documents(spark, []), path), path).count() == 0


def test_query_equals_the_library(spark, tok):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = []
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    got = queries.op12_bpe(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
