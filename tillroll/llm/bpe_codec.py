"""BPE encoding and decoding by speculation: guess tokens greedily, verify, merge only where the guess fails.

The vocabulary's strings are matched greedily, longest first, against each distinct
word.  The tokens so proposed are the merges' own result exactly if they tile the
word, merging alone makes each of them, and no merge crosses a border between two
neighbours before both are complete.  The last point is checked for all distinct
pairs of a batch at once: undo the later of the two merges beside the border, look
whether the symbols that then meet merge earlier, and go on until both are single
symbols.  Words that fail go through the library's merges.

Texts are cut at ASCII white space into chunks where the tokenizer drops white space,
and each worker keeps a bounded table of the chunks that it has met (``ChunkTable``),
joined back by position.  Chunks of letters followed by plain punctuation are words as
they stand; all others take the library's normalizer and splitter, and strings of
special tokens are cut out beforehand as the library does.  With any other
tokenizer the whole text is one chunk.  The rules hold for merges in which every
part is made before the whole and each token by one merge; a vocabulary that breaks this
has all its words merged by the library.

Defined cases: a null or empty text has no ids and decodes to an empty text; repeated
rows and null ids each give a row; an empty table gives an empty result; extra
columns are ignored; texts of any length are encoded whole.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import ChunkTable, per_worker, pick

BATCH_ROWS = 256
TABLE_ROWS = 300_000
MERGED_WORDS = 1000
SIZE_BITS = 20  # a match is its token's id and, in so many bits, its length
NEVER = 2 ** 31 - 1  # the rank of a pair that no rule merges

#: The normalizer and splitter that drop white space and never look across it.
DROPS_BLANKS = (
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    [{"type": "Split", "behavior": "Removed", "invert": True,
      "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}},
     {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}])
#: Letters of one byte pair that normalizing only lower-cases, and punctuation that never joins them.
PLAIN, AFTER = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"


class Merges:
    """The merge rules as tables, and the check of neighbouring tokens."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str]]):
        self.size = max(vocab.values(), default=-1) + 1
        self.left, self.right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        self.rank = np.full(self.size, -1, np.int64)
        a, b, made = (np.array(x, np.int64) for x in ([vocab[m[0]] for m in merges], [vocab[m[1]] for m in merges],
                                                      [vocab[m[0] + m[1]] for m in merges]))
        keys = a * self.size + b
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.left[made], self.right[made], self.rank[made] = a, b, np.arange(len(made))
        once = len(np.unique(made)) == len(made) and len(np.unique(keys)) == len(keys)
        #: whether neighbours can tell a proposal right or wrong
        self.sound = bool(once and (np.maximum(self.rank[a], self.rank[b]) < np.arange(len(made))).all())
        #: tokens that merging alone makes: both parts are, and nothing crosses their border before
        reached = np.ones(self.size, bool)
        fine = self.compatible(a, b, np.arange(len(made)))
        for t, x, y, ok in zip(made.tolist(), a.tolist(), b.tolist(), fine.tolist(), strict=True):
            reached[t] = ok and reached[x] and reached[y]
        self.reached = reached

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(a), NEVER)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge of rank below ``limit`` crosses the border of tokens ``a`` and ``b``.

        Of equal ranks the leftmost merge comes first, so one that crosses the border
        beats an equal one right of it and loses to an equal one left of it.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NEVER) if limit is None else limit.astype(np.int64)
        fine, todo = np.ones(len(a), bool), np.arange(len(a))
        while len(todo):
            crossed = self.pair_rank(a, b) < limit
            fine[todo[crossed]] = False
            go_on = ~crossed & (np.maximum(self.rank[a], self.rank[b]) >= 0)
            todo, a, b = todo[go_on], a[go_on], b[go_on]
            undo_left = self.rank[a] > self.rank[b]
            limit = np.where(undo_left, self.rank[a], self.rank[b] + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return fine


class SpeculativeEncoder:
    """Exactly the library's ids, with most distinct words never merged."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        model = conf["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                                                for t in conf["added_tokens"]):
            raise ValueError(f"{path}: not a plain byte-level BPE ({model['type']} {odd})")
        suffix = model.get("end_of_word_suffix") or ""
        rules = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges(model["vocab"], rules)
        self.exact = Tokenizer.from_str(json.dumps(
            conf | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": [],
                    "post_processor": None, "truncation": None, "padding": None}))
        # A word is followed by "\n"; a token with the suffix takes it in.
        self.greedy = ahocorasick.Automaton()
        self.ended = bool(suffix)
        self.ends = np.array([False] * self.merges.size)
        self.ends[[i for t, i in model["vocab"].items() if suffix and t.endswith(suffix)]] = True
        for token, i in model["vocab"].items():
            if self.merges.reached[i]:
                string = token.removesuffix(suffix) + "\n" if suffix and token.endswith(suffix) else token
                self.greedy.add_word(string, i << SIZE_BITS | len(string))
        self.greedy.make_automaton()
        self.known_pairs = np.zeros(0, np.int64)  # pairs checked lately, and what came out
        self.known_fine = np.zeros(0, bool)
        special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.special = special
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")").split if special else None
        norm, pre = conf["normalizer"] or {}, conf["pre_tokenizer"] or {}
        self.by_chunk = (norm.get("normalizers"), pre.get("pretokenizers")) == DROPS_BLANKS and suffix != ""
        split, self.plain = (lambda t: [t] if t else []), (lambda chunk: None)
        if self.by_chunk:
            split = re.compile(rf"[{PLAIN}]++(?=[{AFTER}]*+(?:[ \t\r\n]|\Z))|[^ \t\r\n]+").findall
            self.plain = re.compile(f"[{PLAIN}]+").fullmatch
            shown = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that stand for themselves
            hidden = [b for b in range(256) if b not in shown]
            chars = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)} | {10: "\n"}
            self.byte_chars = "".join(chars[b] for b in range(256))
        self.table = ChunkTable(split, self._chunks, TABLE_ROWS)
        self.words_seen = self.words_merged = 0

    def _words_of(self, chunk: str) -> list[str | int]:
        """The words of a chunk, in bytes' characters, and the ids of special tokens in it."""
        out: list[str | int] = []
        for piece in self.cut(chunk) if self.cut else [chunk]:
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                text = self.tok.normalizer.normalize_str(piece) if self.tok.normalizer else piece
                out += [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        return out

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        simple = [c for c in chunks if self.plain(c)]
        alone: dict[str, str] = {}
        if simple:
            line = codecs.charmap_decode("\n".join(simple).lower().encode(), "strict", self.byte_chars)[0]
            alone = dict(zip(simple, line.split("\n"), strict=True))
        parts = {c: self._words_of(c) for c in chunks if c not in alone}
        words = list({*alone.values(), *(w for p in parts.values() for w in p if isinstance(w, str))})
        ids = dict(zip(words, self.encode_words(words), strict=True))
        return [ids[alone[c]] if c in alone
                else b"".join(ids[w] if isinstance(w, str) else array("I", [w]).tobytes() for w in parts[c]) for c in chunks]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words: proposed, verified, and merged where that fails."""
        if not words:
            return []
        self.words_seen += len(words)
        ok, ids, starts = self._propose(words)
        at = (starts * 4).tolist()
        out = list(map(ids.tobytes().__getitem__, map(slice, at[:-1], at[1:])))
        failed = np.flatnonzero(~ok).tolist()
        self.words_merged += len(failed)
        for i, merged in zip(failed, self._merge([words[i] for i in failed]), strict=True):
            out[i] = merged
        return out

    def _merge(self, words: list[str]) -> Iterator[bytes]:
        """The library's merges; where tokens tell the end of a word, for many words in a call."""
        size = MERGED_WORDS if self.ended else 1
        lines = [" ".join(words[at:at + size]) for at in range(0, len(words), size)]
        for e in self.exact.encode_batch_fast(lines, add_special_tokens=False):
            ids = np.array(e.ids, "<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist() if self.ended else [len(ids) * 4]
            yield from map(ids.tobytes().__getitem__, map(slice, [0, *stops[:-1]], stops))

    def _propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word's proposal holds, all proposed ids and where each word's begin."""
        line = "\n".join(words) + "\n"
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        last, match = np.fromiter(chain.from_iterable(self.greedy.iter_long(line)), np.int64).reshape(-1, 2).T
        ids, size = match >> SIZE_BITS, match & ((1 << SIZE_BITS) - 1)
        word = np.searchsorted(ends, last, side="right")
        starts = np.searchsorted(word, np.arange(len(words) + 1))
        tiled = np.bincount(word, size, len(words)) == (lengths if self.ended else lengths - 1)
        ok = tiled if self.merges.sound else np.zeros(len(words), bool)
        inner = np.flatnonzero(word[1:] == word[:-1])
        bad = ~self._fine(ids[inner], ids[inner + 1])
        ok[word[inner[bad]]] = False
        return ok, ids.astype("<u4"), starts

    def _fine(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` for all pairs, each distinct pair once; a bounded number of results is kept."""
        pairs, back = np.unique(a * self.merges.size + b, return_inverse=True)
        at = np.searchsorted(self.known_pairs, pairs)
        known = np.append(self.known_pairs, -1)[at] == pairs
        fine = np.append(self.known_fine, False)[at]
        new = pairs[~known]
        fine[~known] = self.merges.compatible(new // self.merges.size, new % self.merges.size)
        keep = len(self.known_pairs) + len(new) <= TABLE_ROWS
        merged = np.concatenate([self.known_pairs, new]) if keep else pairs
        results = np.concatenate([self.known_fine, fine[~known]]) if keep else fine
        order = np.argsort(merged, kind="stable")
        self.known_pairs, self.known_fine = merged[order], results[order]
        return fine[back]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.table.ids(texts)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and the ids of each whole text, without special tokens added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("speculative", tokenizer), lambda: SpeculativeEncoder(tokenizer))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(offsets, np.concatenate(ids).view(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), lists], ["doc_id", "ids"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids and the library's decoding of them, special tokens kept, as ``text``.

    A tokenizer without a decoder puts one blank between the tokens' strings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(tokenizer)
        strings = np.full(tok.get_vocab_size(with_added_tokens=True), None, object)
        for token, i in tok.get_vocab(with_added_tokens=True).items():
            strings[i] = token
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                if tok.decoder is None:
                    ends = np.cumsum(part.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                    flat = strings[part.column(1).flatten().to_numpy(zero_copy_only=False)]
                    texts = [" ".join(x.tolist()) for x in np.split(flat, ends[:-1])]
                else:
                    texts = tok.decode_batch([i or [] for i in part.column(1).to_pylist()], skip_special_tokens=False)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 ["doc_id", "ids", "text"])

    return pick(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
