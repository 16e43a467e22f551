import itertools
import random
import zlib

import numpy as np
from llm_helpers import ODD, documents
from pyspark.sql import functions as F

from tillroll.llm import toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes = rng.integers(1, 7, rng.integers(1, 6))
        first = np.zeros(sizes.sum(), bool)
        first[np.cumsum(sizes) - sizes] = True
        unary, trans, start = rng.normal(0, 2, len(first)), np.exp(rng.normal(0, 1, (2, 2))), float(np.exp(rng.normal()))
        trans[0, 0] = 1
        p, pairs = toxicity.marginals(unary, first, trans, start)
        at = 0
        for n in sizes.tolist():
            total, one, two = 0.0, np.zeros(n), np.zeros((n, 3))
            for y in itertools.product((0, 1), repeat=n):
                w = (start if y[0] else 1.0) * np.exp(sum(unary[at + i] for i in range(n) if y[i]))
                w *= np.prod([trans[a, b] for a, b in itertools.pairwise(y)])
                total += w
                one += w * np.array(y)
                for i in range(1, n):
                    kind = {(1, 1): 0, (0, 1): 1, (1, 0): 2}.get((y[i - 1], y[i]))
                    if kind is not None:
                        two[i, kind] += w
            assert np.allclose(one / total, p[at:at + n]) and np.allclose(two / total, pairs[at:at + n])
            at += n


def corpus(n=1200, seed=1):
    """Random words; toxic texts hold a bad word or an inflected bad stem."""
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words, toxic = [rng.choice(plain) for _ in range(rng.randint(5, 120))], i % 6 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["Vile", "zzrot" + rng.choice(plain)]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_spans(spark):
    rows, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = documents(spark, rows, extra=False)
    model = toxicity.train(docs, table)
    got = {r.doc_id: r for r in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 150
    right = sum((got[i].toxicity.score >= 0.5) == (i % 6 == 0) for i in held)
    assert right >= 0.98 * len(held)
    for i in held:
        if i % 6 == 0:
            found = [got[i].text[s.start:s.end] for s in got[i].toxicity.spans]
            assert found and all(w == "Vile" or w.startswith("zzrot") for w in found)


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert a.weights == b.weights and a.logit.tolist() == b.logit.tolist()
    flags = spark.createDataFrame([(i,) for i in (0, 1, 2, 7, 23, None)], "doc_id long").select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    assert [r.h for r in flags] == [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in flags]


def test_chain_learns_from_every_toxic_document(monkeypatch):
    """A word of toxic texts that sort last counts, however few words a step of the fit holds."""
    rng = random.Random(3)
    plain = ["".join(rng.choice("bcdefghijk") for _ in range(6)) for _ in range(300)]
    text = lambda bad: " ".join([rng.choice(plain) for _ in range(60)] + bad)
    toxic = sorted([text(["vile"]) for _ in range(120)] + ["яя " + text(["гадость"]) for _ in range(20)])
    texts = sorted([text([]) for _ in range(300)] + ["яя " + text([]) for _ in range(40)]) + toxic
    labels = [0] * 340 + [1] * 140
    whole = toxicity.fit(texts, labels)
    monkeypatch.setattr(toxicity, "CHAIN_TOKENS", 5000)
    model = toxicity.fit(texts, labels)
    assert model.weights["гадость$"] > 0.5 and abs(model.weights["vile$"] - model.weights["гадость$"]) < 2
    p = model.places([toxicity.words(t) for t in ("яя bcdefg гадость", "яя bcdefg")], {})
    assert p[0][2] >= 0.5 and p[0][0] < 0.5 and p[1].max() < 0.5
    assert all(abs(whole.weights[f] - v) < 1e-3 for f, v in model.weights.items())


def test_chain_takes_each_text_once():
    texts = ["a b", "a b", "c", "", "d e", "c", *[f"n{i}" for i in range(80)]]
    labels = [1, 1, 0, 1, 0, 1, *[0] * 80]
    chosen = toxicity.chain_documents(texts, [toxicity.words(t) for t in texts], labels)
    assert sorted(texts[i] for i in chosen if labels[i]) == ["a b", "c"]
    clean = [texts[i] for i in chosen if not labels[i]]
    assert len(clean) == len(set(clean)) == 50 and not {"a b", "c", ""} & set(clean)


def test_a_document_repeated_often_does_not_crowd_out_the_others(spark, monkeypatch):
    rows, labels = corpus(500)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 500)
    repeated = next(r for r in rows if zlib.crc32(str(r[0]).encode()) % 5)
    plain = toxicity.train(documents(spark, rows, extra=False), table)
    often = toxicity.train(documents(spark, [repeated] * 3000 + rows, extra=False), table)
    assert often is not None and often.weights == plain.weights and often.logit.tolist() == plain.logit.tolist()


def test_odd_documents_and_labels(spark):
    rows, labels = corpus(400)
    model = toxicity.train(documents(spark, rows), spark.createDataFrame(
        [*labels, (3, None), (None, 1), (4, 7), (0, 0)], "doc_id long, toxic int"))
    scored = toxicity.score(documents(spark, [*ODD, (99, "İİ vile İ")], extra=False), model).collect()
    assert len(scored) == len(ODD) + 1 and all(0 <= r.toxicity.score <= 1 for r in scored)
    empty = {r.toxicity.score for r in scored if not (r.text or "").strip()}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert next(r for r in scored if r.doc_id == 99).toxicity.score >= 0.5


def test_without_labels_nothing_is_toxic(spark):
    docs = documents(spark, [(1, "vile"), (2, None)], extra=False)
    for labels in ([], [(1, 1)], [(1, 0)]):
        assert toxicity.clean(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 2
    assert toxicity.clean(docs.limit(0), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")).count() == 0


def test_stage_rejects_toxic_documents_and_keeps_columns(spark):
    rows, labels = corpus(900)
    docs = documents(spark, rows)
    out = toxicity.clean(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert out.columns == docs.columns
    left = [r[0] for r in out.select("doc_id").collect()]
    assert sum(i % 6 == 0 for i in left) <= 3 and sum(i % 6 != 0 for i in left) >= 748


def test_spans_are_offsets_of_the_text_where_lower_case_is_longer():
    text = "İİ bad İx worse"
    places = toxicity.words(text.lower())
    hit = np.array([1.0 if w in ("bad", "x", "worse") else 0.0 for w in places])
    assert [text[s["start"]:s["end"]] for s in toxicity._spans(text, hit)] == ["bad", "x", "worse"]
    assert toxicity._spans(text, np.zeros(len(places))) == []
