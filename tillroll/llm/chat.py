"""Chat formatting in budgeted windows.

A conversation's turns are rendered with markers around role and text, control
strings inside them escaped reversibly.  Prefix sums of the turns' tokens cut the
conversation into spans of whole turns within a token budget.  Each window repeats
the system turn and some of the last turns before its span, and its loss mask
covers the assistant texts of its own span only, so each is a target exactly once.
A turn too long for the budget gets a window of its own and is never cut.

One shuffle brings the turns of a conversation, in order, to one task, which reads
them as a stream; windows that are full leave it, the last one stays open, so what a
task holds is at most ``BLOCK_TURNS`` turns or ``BLOCK_CHARS`` characters and one window.
A conversation of more than ``BLOCK_TURNS`` turns is dealt in segments to different
tasks.  Segments go by the turns' places, not by their numbers: equal turns are counted,
the distinct ones sorted into ranges, and sums of the counts before a turn in its
range and of the ranges before give its place.  The system turn and the last turns
before a segment, as many as the history's tokens can hold, are sent along.

Reading back streams the windows of a conversation in order; its memory is one
window.  A digest over a conversation is a digest over one stream, so that stream
is read by one task.

Defined cases: a null text or role is empty; turns are ordered by number (null
first), then role and text, so repeated turns are kept; a null conversation id is a
conversation; turn numbers may have gaps, be negative or as large as time stamps, only
their order counts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import per_worker, pick
from tillroll.session import materialize

BUDGET = 2048
HISTORY = 512
BLOCK_TURNS = 1024
BLOCK_CHARS = 8_000_000
LEAST_TOKENS = 8  # a turn's markers alone are more, with any tokenizer that parts letters from punctuation
PREFIX = 200  # characters of a text by which turns are dealt into ranges
CONTROL = re.compile(r"<s>|</s>|\[INST\]|\[/INST\]")
TURN = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]</s>", re.DOTALL)

WINDOWS = ("conv_id long, segment long, window int, text string, turns int, new_turns int, tokens int, "
           "loss array<struct<start: int, end: int>>")
WINDOW_ROW = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("window", pa.int32()), ("text", pa.string()),
                        ("turns", pa.int32()), ("new_turns", pa.int32()), ("tokens", pa.int32()),
                        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def escape(text: str) -> str:
    """No control string is left in the result; ``unescape`` gives the text back."""
    doubled = text.replace("\\", "\\\\") if "\\" in text else text
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], doubled)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's string and where its escaped text starts and ends."""
    head, body = f"<s>{escape(role)}[INST]", escape(text)
    return f"{head}{body}[/INST]</s>", len(head), len(head) + len(body)


def spans(tokens: list[int], first: int, system: int, budget: int, history: int) -> list[tuple[int, int, int]]:
    """(start of the history, start, end) of windows over turns from ``first`` on.

    ``tokens``: of the turns, those before ``first`` being context; ``system``: tokens
    of the system turn, which every window holds beside its span.
    """
    sums, out, at = [0, *accumulate(tokens)], [], first
    while at < len(tokens):
        room = budget - system
        # the longest run of turns before the span within the history's share
        back = min(at, bisect_left(sums, sums[at] - min(history, room)))
        while back < at and sums[at + 1] - sums[back] > room:  # the turn itself comes before its history
            back += 1
        end = max(at + 1, bisect_right(sums, sums[back] + room) - 1)
        out.append((back, at, end))
        at = end
    return out


class _Segment:
    """Turns of one segment on their way to windows."""

    def __init__(self, conv_id, segment, budget, history):
        self.conv_id, self.segment, self.budget, self.history = conv_id, segment, budget, history
        self.system, self.turns, self.fresh, self.number, self.chars, self.room = None, [], 0, 0, 0, BLOCK_TURNS

    def add(self, turn: tuple, is_context: bool) -> None:
        self.turns.append(turn)
        self.fresh += is_context
        self.chars += len(turn[0])

    def full(self) -> bool:
        return len(self.turns) - self.fresh >= self.room or self.chars >= BLOCK_CHARS and len(self.turns) - self.fresh > 1

    def windows(self, last: bool) -> list[tuple]:
        """Windows over the turns not yet in one; but for the last time, the last of them stays
        open, with the turns before it that its history may hold."""
        out = []
        system = [self.system] if self.system else []
        tokens = [t[4] for t in self.turns]
        found = spans(tokens, self.fresh, sum(t[4] for t in system), self.budget, self.history)
        stays = found.pop()[1] if found and not last else len(tokens)
        for back, at, end in found:
            used = self.turns[back:end]
            lead = [t for t in system if not any(t is u for u in used)]  # the first window holds it itself
            text, loss, where = [], [], 0
            for n, (string, start, stop, target, _) in enumerate(lead + used):
                if target and n >= len(lead) + at - back:
                    loss.append((where + start, where + stop))
                text.append(string)
                where += len(string)
            out.append((self.conv_id, self.segment, self.number, "".join(text), len(lead) + len(used), end - at,
                        sum(t[4] for t in lead + used), loss))
            self.number += 1
        kept, held = stays, 0
        while kept and held + tokens[kept - 1] <= self.history:
            kept -= 1
            held += tokens[kept]
        self.turns, self.fresh = self.turns[kept:], stays - kept
        self.chars = sum(len(t[0]) for t in self.turns)
        self.room = BLOCK_TURNS if out else 2 * self.room  # a window of very many turns: look again later
        return out


#: Fixed value: how byte-level tokenizers of this kind split a text into words.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class TokenCounter:
    """Number of tokens of texts.

    A byte-level tokenizer whose ids follow its merges is also one for ``tiktoken``, which
    takes a quarter of the time; other tokenizers, and texts of over ``LONG`` characters,
    take the library that the file is made for.
    """

    LONG = 100_000

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        self.tok, self.fast = Tokenizer.from_file(path), None
        self.tok.encode_special_tokens = True  # control strings of the tokenizer are ordinary text here
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre, model = conf["pre_tokenizer"] or {}, conf["model"]
        rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        plain = conf["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        special = {t["content"] for t in conf["added_tokens"]}
        ids = {t: i for t, i in model["vocab"].items() if t not in special}
        in_order = [ids.get(a + b) for a, b in rules] == list(range(256, 256 + len(rules)))
        if plain and in_order and len(ids) == 256 + len(rules) and not model.get("end_of_word_suffix"):
            shown = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that stand for themselves
            hidden = [b for b in range(256) if b not in shown]
            byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}
            self.fast = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks={bytes(byte[c] for c in t): i for t, i in ids.items()},
                                          special_tokens={})

    def __call__(self, texts: list[str]) -> list[int]:
        if self.fast is None:
            return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return [len(self.fast.encode_ordinary(t)) if len(t) <= self.LONG else len(self.tok.encode(t, add_special_tokens=False)) for t in texts]


def _places(deep: DataFrame) -> DataFrame:
    """The turns of long conversations (with ``n``, their number of turns) and each one's place ``at``, from 0."""
    spark = deep.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    distinct = deep.groupBy("conv_id", "n", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    ranged = materialize(distinct.repartitionByRange(width, F.col("conv_id").asc_nulls_first(), *order[:2], F.substring("text", 1, PREFIX))
                         .withColumn("range", F.spark_partition_id()), "turn_ranges")
    totals = ranged.groupBy("range", "conv_id").agg(F.sum("copies").alias("total"))
    offsets = totals.select("range", F.col("conv_id").alias("same"), F.coalesce(F.sum("total").over(
        Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    before = F.coalesce(F.sum("copies").over(
        Window.partitionBy("range", "conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = ranged.withColumn("before", before)
    return (local.join(offsets, (local["range"] == offsets["range"]) & local["conv_id"].eqNullSafe(offsets["same"]))
            .select("conv_id", "n", "turn", "role", "text", (F.col("offset") + F.col("before")).alias("first"), "copies")
            .select("conv_id", "n", "turn", "role", "text",
                    F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)).alias("at")))


def windows(turns: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY, least: int = LEAST_TOKENS) -> DataFrame:
    """Formatted windows of all conversations (conv_id, turn, role, text); see ``WINDOWS``.

    ``least``: tokens that a turn has at least, which bounds how many turns a history holds.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    long = materialize(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK_TURNS)
                       .withColumnRenamed("conv_id", "same"), "long_conversations")
    here = F.col("conv_id").eqNullSafe(F.col("same"))
    whole = rows.join(long, here, "left_anti").select("conv_id", F.lit(0).cast("long").alias("segment"), F.lit(2).alias("kind"),
                                                     F.lit(0).cast("long").alias("at"), "turn", "role", "text")
    dealt = whole
    if not long.isEmpty():
        placed = materialize(_places(rows.join(long, here).drop("same")).withColumn("segment", F.floor(F.col("at") / BLOCK_TURNS)), "turn_places")
        later = F.floor((F.col("n") - 1) / BLOCK_TURNS)
        heads = (placed.filter("at = 0 AND role = 'system'")
                 .select("conv_id", F.explode(F.sequence(F.lit(1).cast("long"), later)).alias("segment"), F.lit(0).alias("kind"), "at", "turn", "role", "text"))
        carried = -(-history // least)
        tails = (placed.filter((F.col("segment") < later) & (F.col("at") % BLOCK_TURNS >= BLOCK_TURNS - carried))
                 .select("conv_id", (F.col("segment") + 1).alias("segment"), F.lit(1).alias("kind"), "at", "turn", "role", "text"))
        own = placed.select("conv_id", "segment", F.lit(2).alias("kind"), "at", "turn", "role", "text")
        dealt = whole.unionByName(own).unionByName(heads).unionByName(tails)
    dealt = (dealt.repartition("conv_id", "segment").select("conv_id", "segment", "kind", "role", "text", "at", "turn")
             .sortWithinPartitions("conv_id", "segment", "kind", "at", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, at = per_worker(("count", tokenizer), lambda: TokenCounter(tokenizer)), None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                conv_ids, segments, kinds, roles, texts = (c.to_pylist() for c in batch.slice(lo, 256).columns[:5])
                rendered = [render(r, t) for r, t in zip(roles, texts, strict=True)]
                sizes = count([r[0] for r in rendered])
                for conv_id, segment, kind, role, turn, size in zip(conv_ids, segments, kinds, roles, rendered, sizes, strict=True):
                    if at is None or (conv_id, segment) != (at.conv_id, at.segment):
                        if at:
                            yield from _batches(at.windows(last=True))
                        at = _Segment(conv_id, segment, budget, history)
                    turn = (*turn, role == "assistant", size)
                    if kind == 0 or (kind == 2 and segment == 0 and role == "system" and not at.turns and at.system is None):
                        at.system = turn
                    if kind:
                        at.add(turn, kind == 1)
                    if at.full():
                        yield from _batches(at.windows(last=False))
        if at:
            yield from _batches(at.windows(last=True))

    return dealt.mapInArrow(run, WINDOWS)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        *columns, loss = zip(*rows, strict=True)
        spans_of = [pa.array([s[i] for found in loss for s in found], pa.int32()) for i in (0, 1)]
        ends = pa.array([0, *accumulate(map(len, loss))], pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(spans_of, ["start", "end"]))
        yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns, WINDOW_ROW, strict=False)), lists.cast(WINDOW_ROW.field("loss").type)],
                                         schema=WINDOW_ROW)


def parse(text: str, last: int | None = None) -> list[tuple[str, str]]:
    """Role and text of the turns of a window, or of the last few."""
    found = TURN.findall(text)
    return [(unescape(r), unescape(t)) for r, t in (found if last is None else found[len(found) - last:])]


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation say when read back; see ``DIGESTS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out = None, []

        def close() -> None:
            conv_id, n, turns, chars, loss, size = at
            out.append({"conv_id": conv_id, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                        "loss_sha256": loss.hexdigest(), "formatted_chars": size})

        for batch in batches:
            conv_ids, texts, news = (batch.column(c).to_pylist() for c in ("conv_id", "text", "new_turns"))
            masks = batch.column("loss")
            starts, ends = (masks.flatten().field(i).to_pylist() for i in (0, 1))
            upto = accumulate(masks.value_lengths().to_pylist())
            done = 0
            for conv_id, text, new, end in zip(conv_ids, texts, news, upto, strict=True):
                if at is None or at[0] != conv_id:
                    if at:
                        close()
                    at = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text, new):
                    at[2].update(f"{role}\n{said}\n".encode())
                for i in range(done, end):
                    target = unescape(text[starts[i]:ends[i]])
                    at[3] += len(target)
                    at[4].update(target.encode())
                done = end
                at[1] += new
                at[5] += len(text)
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
        if at:
            close()
        yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return (formatted.select("conv_id", "segment", "window", "text", "new_turns", "loss").repartition("conv_id")
            .sortWithinPartitions("conv_id", "segment", "window").mapInArrow(run, DIGESTS))
