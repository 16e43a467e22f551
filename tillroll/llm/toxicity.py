"""Toxicity: a linear-chain conditional random field tags toxic words.

Document labels become token labels: a word, or the beginning of words, counts as
toxic where it is found in many toxic training documents and in next to no clean
ones (near copies counted once), and its places in toxic documents are labelled
1.  On these sequences a two-state chain with a weight for each frequent word and
word beginning and with transition weights is fitted by maximum likelihood, on all
distinct toxic texts of the sample and as many clean ones (those with the smallest
hash, 50 at least); no bound of words cuts them, ``CHAIN_TOKENS`` is only how many
words a step of the fit holds at a time.  A document's
score is a logistic function of the largest and the summed marginal, fitted on
the training documents; places whose marginal is 0.5 or more are its spans.

Only the fit uses a sample: at most ``SAMPLE_DOCS`` labelled documents (those with
the smallest hash of their id) of at most ``SAMPLE_BYTES`` bytes each, so the driver
holds a bounded amount.  Scoring reads every whole text in its own task, no
shuffle; forward and backward passes run over all words of a batch at once.

Defined cases: a null or empty text has no words and gets the score of a document
without evidence; rows without a label, with a null id or repeated are scored like
any other; of differing labels of one document 1 counts, and of differing texts of
one id the fit takes the greatest that is not too long; without labels of both
kinds every score is 0; extra columns are kept by ``score`` and ignored elsewhere.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import pick

SAMPLE_DOCS = 6000
SAMPLE_BYTES = 16_384
CHAIN_TOKENS = 200_000
VOCABULARY = 20_000
BATCH_CHARS = 2_000_000
RESULT = "score double, spans array<struct<start: int, end: int>>"

#: Lengths of the word beginnings that are features beside the whole word.
STEMS = range(3, 8)
CACHED_WORDS = 200_000

words = re.compile(r"\w+").findall


def features(word: str) -> list[str]:
    return [word + "$", *(word[:k] for k in STEMS if k <= len(word))]


def _products(e: np.ndarray, trans: np.ndarray, reset: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Message ratios of state 1 to state 0 along each column's rows, for all columns at once.

    Row t maps a ratio r to e[t] * (a01 + r * a11) / (a00 + r * a10), or to
    e[t] * start where the chain starts anew.  Columns are consecutive pieces of
    one chain: their 2x2 products are made side by side, carried from column to
    column, and then every column is walked with its own first value.
    """
    steps, cols = e.shape
    (a00, a01), (a10, a11) = trans
    # m: row vector (1, r) times matrix; kept as four arrays, scaled at each step
    m = [np.ones(cols), np.zeros(cols), np.zeros(cols), np.ones(cols)]
    for t in range(steps):
        x, hit = e[t], reset[t]
        new = []
        for left, right in ((m[0], m[1]), (m[2], m[3])):
            to0 = np.where(hit, left + right, left * a00 + right * a10)
            to1 = np.where(hit, (left + right) * start, left * a01 + right * a11) * x
            new += [to0, to1]
        scale = new[0] + new[1] + new[2] + new[3]
        m = [v / scale for v in new]
    r, first = 1.0, np.empty(cols)
    for c in range(cols):
        first[c] = r
        r = min(max((m[1][c] + r * m[3][c]) / max(m[0][c] + r * m[2][c], 1e-300), 1e-30), 1e30)
    out, r = np.empty_like(e), first
    for t in range(steps):
        r = e[t] * np.where(reset[t], start, (a01 + r * a11) / (a00 + r * a10))
        r = np.clip(r, 1e-30, 1e30)
        out[t] = r
    return out


def _columns(x: np.ndarray, steps: int, fill: float) -> np.ndarray:
    cols = -(-len(x) // steps)
    return np.concatenate([x, np.full(cols * steps - len(x), fill, x.dtype)]).reshape(cols, steps).T


def marginals(unary: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Probability of state 1 at each place, and of (1, 1), (0, 1), (1, 0) at each place and its predecessor.

    ``unary``: log-odds for state 1; ``first``: True where a document starts;
    ``trans``: 2x2 potentials; ``start``: potential of starting in state 1.
    """
    n = len(unary)
    if not n:
        return np.empty(0), np.empty((0, 3))
    steps = min(512, max(1, int(n ** 0.5)))
    e = np.exp(np.clip(unary, -30, 30))
    forward = _products(_columns(e, steps, 1.0), trans, _columns(first, steps, True), np.float64(start)).T.ravel()[:n]
    # backward: ratio of the messages that leave a place; the same walk on the reversed chain.  The walk
    # yields e * message, the message itself is that of the place after it, folded through the transition.
    last = np.append(first[1:], True)
    # at a document's last place the message is 1, so the walk starts anew with ratio e there
    back = _products(_columns(e[::-1], steps, 1.0), np.array([[trans[0, 0], trans[1, 0]], [trans[0, 1], trans[1, 1]]]),
                     _columns(last[::-1], steps, True), np.float64(1.0)).T.ravel()[:n][::-1]
    message = back / e  # of state 1 to state 0, from all that follows
    odds = forward * message
    p = odds / (1 + odds)
    prev = np.concatenate([[1.0], forward[:-1]])
    cells = np.stack([trans[0, 0] * np.ones(n), trans[0, 1] * back, trans[1, 0] * prev, trans[1, 1] * prev * back], 1)
    cells /= cells.sum(1, keepdims=True)
    cells[first] = 0
    return p, cells[:, [3, 1, 2]]


@dataclass
class Model:
    """Feature weights, chain potentials and the logistic function over a document's marginals."""

    weights: dict[str, float]
    bias: float
    trans: np.ndarray
    start: float
    logit: np.ndarray

    def unary(self, docs: list[list[str]], known: dict[str, float]) -> np.ndarray:
        """Log-odds of all words; ``known`` keeps words met before (bounded)."""
        if len(known) > CACHED_WORDS:
            known.clear()
        get = self.weights.get
        for w in {w for d in docs for w in d if w not in known}:
            known[w] = self.bias + sum(get(f, 0.0) for f in features(w))
        return np.array([known[w] for d in docs for w in d], float)

    def places(self, docs: list[list[str]], known: dict[str, float]) -> list[np.ndarray]:
        """Marginals of the words of each text."""
        unary = self.unary(docs, known)
        sizes = np.array([len(d) for d in docs])
        first = np.zeros(len(unary), bool)
        starts = np.cumsum(sizes) - sizes
        first[starts[sizes > 0]] = True
        return np.split(marginals(unary, first, self.trans, self.start)[0], starts[1:])

    def score(self, p: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-evidence(p) @ self.logit)))


def evidence(p: np.ndarray) -> np.ndarray:
    return np.array([1.0, p.max(initial=0), np.log1p(p.sum())])


def _family(tokens: list[str]) -> int:
    """The smallest hash of a three-word shingle: near copies mostly share it."""
    import xxhash

    grams = zip(tokens, tokens[1:], tokens[2:]) if len(tokens) > 2 else [tokens]
    return min(xxhash.xxh64_intdigest(" ".join(g)) for g in grams)


def toxic_features(docs: list[list[str]], labels: list[int]) -> tuple[set[str], Counter]:
    """Features of many toxic documents and next to no clean ones; and how many documents each
    feature of toxic documents has.

    Near copies count once.
    """
    once: dict[tuple[int, int], set[str]] = {}
    for tokens, y in zip(docs, labels, strict=True):
        if tokens:
            once.setdefault((y, _family(tokens)), set(tokens))
    n = [sum(y == k for y, _ in once) for k in (0, 1)]
    toxic, clean = Counter(), Counter()
    for (y, _), found in once.items():
        if y:
            toxic.update({f for w in found for f in features(w)})
    known: dict[str, list[str]] = {}  # what a word has in common with toxic documents; the rest is of no use
    for (y, _), found in once.items():
        if not y:
            for w in found:
                if w not in known:
                    known[w] = [f for f in features(w) if f in toxic]
            clean.update({f for w in found for f in known[w]})
    least = max(5, 0.015 * n[1])
    flagged = {f for f, c in toxic.items() if c >= least and c / n[1] >= 50 * (clean[f] + 0.5) / max(n[0], 1)}
    toxic.update(clean)
    return flagged, toxic


def chain_documents(texts: list[str], docs: list[list[str]], labels: list[int]) -> list[int]:
    """Numbers of the documents the chain is fitted on: each distinct toxic text with words once,
    and as many clean ones (50 at least), in the order of a hash of the text.

    Of differing labels of one text 1 counts.
    """
    import xxhash

    once: dict[str, int] = {}
    for i in sorted(range(len(texts)), key=lambda i: -labels[i]):
        if docs[i]:
            once.setdefault(texts[i], i)
    order = sorted(once.values(), key=lambda i: (xxhash.xxh64_intdigest(texts[i]), texts[i]))
    toxic = [i for i in order if labels[i]]
    return toxic + [i for i in order if not labels[i]][:max(len(toxic), 50)]


def fit(texts: list[str], labels: list[int], rounds: int = 60, held: int | None = None) -> Model:
    """Fit the chain and the document score on labelled texts.

    ``held``: words whose marginals are held at a time, by default ``CHAIN_TOKENS``; the
    sums over all of them are the same for any number.
    """
    same: dict[str, str] = {}  # one object per distinct word
    docs = [[same.setdefault(w, w) for w in words(t.lower())] for t in texts]
    del same
    flagged, count = toxic_features(docs, labels)
    vocabulary = {f: i for i, f in enumerate(sorted(count, key=lambda f: (f not in flagged, -count[f], f))[:VOCABULARY])}
    del count
    chosen = chain_documents(texts, docs, labels)
    word_ids: dict[str, int] = {}
    x = np.fromiter((word_ids.setdefault(w, len(word_ids)) for i in chosen for w in docs[i]), np.int32)
    of = np.fromiter((k for w, n in word_ids.items() for f in features(w) if f in vocabulary for k in (n, vocabulary[f])), np.int64)
    word, feature = of.reshape(-1, 2).T
    toxic = np.array([any(f in flagged for f in features(w)) for w in word_ids], bool)
    sizes = np.array([len(docs[i]) for i in chosen], int)
    y = toxic[x] & np.repeat(np.array([labels[i] for i in chosen], bool), sizes)
    first = np.zeros(len(x), bool)
    starts = np.cumsum(sizes) - sizes
    first[starts] = True
    cuts = [*starts[np.unique(starts // (held or CHAIN_TOKENS), return_index=True)[1]].tolist(), len(x)]
    prev = np.concatenate([[False], y[:-1]])
    seen_pairs = np.array([(y & prev & ~first).sum(), (y & ~prev & ~first).sum(), (~y & prev & ~first).sum()], float)
    seen_word = np.bincount(x[y], minlength=len(word_ids)).astype(float)
    # parameters: feature weights, bias, log potentials of 11, 01, 10, log potential of a start in 1
    theta = np.zeros(len(vocabulary) + 5)
    theta[-5] = -3.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        w, (bias, k11, k01, k10, s) = theta[:-5], theta[-5:]
        unary = bias + np.bincount(word, w[feature], len(word_ids))
        missed, missed_pairs, missed_starts = seen_word.copy(), seen_pairs.copy(), float((y & first).sum())
        for lo, hi in zip(cuts, cuts[1:]):
            p, pairs = marginals(unary[x[lo:hi]], first[lo:hi], np.exp(np.array([[0.0, k01], [k10, k11]])), float(np.exp(s)))
            missed -= np.bincount(x[lo:hi], p, len(word_ids))
            missed_pairs -= pairs.sum(0)
            missed_starts -= p[first[lo:hi]].sum()
        grad = np.concatenate([np.bincount(feature, missed[word], len(w)), [missed.sum()], missed_pairs, [missed_starts]]) - 0.01 * theta
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad ** 2
        theta += 0.2 * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-8)
    w, (bias, k11, k01, k10, s) = theta[:-5], theta[-5:]
    model = Model({f: float(w[i]) for f, i in vocabulary.items()}, float(bias),
                  np.exp(np.array([[0.0, k01], [k10, k11]])), float(np.exp(s)), np.zeros(3))
    known: dict[str, float] = {}
    seen = np.array([evidence(p) for at in range(0, len(docs), 500) for p in model.places(docs[at:at + 500], known)])
    target, beta = np.array(labels, float), np.zeros(3)
    for _ in range(25):  # Newton's method, lightly held
        q = 1 / (1 + np.exp(-seen @ beta))
        beta += np.linalg.solve((seen * (q * (1 - q))[:, None]).T @ seen + 0.05 * np.eye(3), seen.T @ (target - q) - 0.05 * beta)
    model.logit = beta
    return model


def held_out(doc_id: Column) -> Column:
    """True for the fifth of documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on a bounded sample of labelled documents; None without both kinds of label."""
    sample = (pick(labels, "doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))
    rows = (pick(docs, "doc_id", "text").filter(F.octet_length("text").between(1, SAMPLE_BYTES))
            .join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
            .select("text", "toxic").toPandas())  # one row per id of the sample
    rows = rows.sort_values(["toxic", "text"])  # the fit does not depend on the order of tasks
    return fit(rows.text.tolist(), rows.toxic.tolist()) if rows.toxic.nunique() == 2 else None


def score(docs: DataFrame, model: Model | None, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``into``: struct of score and spans (character offsets of tagged words)."""

    @F.pandas_udf(RESULT)
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, float] = {}
        for series in batches:
            texts = [t or "" for t in series]
            out: list[tuple] = []
            while len(out) < len(texts):  # some megabytes of text at a time
                at, chars = len(out), 0
                while at < len(texts) and (chars == 0 or chars + len(texts[at]) <= BATCH_CHARS):
                    chars += len(texts[at])
                    at += 1
                part = texts[len(out):at]
                if model is None:
                    out += [(0.0, [])] * len(part)
                    continue
                places = model.places([words(t.lower()) for t in part], known)
                out += [(model.score(p), _spans(t, p)) for t, p in zip(part, places, strict=True)]
            yield pd.DataFrame(out, columns=["score", "spans"])

    return docs.withColumn(into, tag(F.col(text)))


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Offsets of tagged words in the text itself; a letter whose lower case is longer counts for all of it."""
    if not (p >= 0.5).any():
        return []
    low = text.lower()
    at = [m.span() for m in re.finditer(r"\w+", low)]
    if len(low) != len(text):
        source = [i for i, c in enumerate(text) for _ in c.lower()]
        at = [(source[a], source[b - 1] + 1) for a, b in at]
    return [{"start": a, "end": b} for (a, b), q in zip(at, p, strict=True) if q >= 0.5]


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below 0.5, the model being fitted on them."""
    names = docs.columns
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    scored = score(plain, train(docs, labels), f"_{names.index('text')}", "_toxicity")
    return scored.filter("_toxicity.score < 0.5").drop("_toxicity").toDF(*names)
