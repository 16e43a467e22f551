import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import chat

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "[", "/INST]", "<", "/s>", "\\", "\\\\", "s>", "x", "\n", "<s", "INST]"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(PIECES).map("".join), st.lists(PIECES).map("".join))))
def test_turns_come_back_whatever_they_hold(turns):
    for _, text in turns:
        assert chat.unescape(chat.escape(text)) == text and not chat.CONTROL.search(chat.escape(text))
    assert chat.parse("".join(chat.render(r, t)[0] for r, t in turns)) == turns


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=40), st.integers(0, 20), st.integers(10, 100), st.integers(0, 50), st.integers(0, 3))
def test_spans_are_turn_aligned_and_within_the_budget(tokens, system, budget, history, first):
    first = min(first, len(tokens))
    found = chat.spans(tokens, first, system, budget, history)
    at = first
    for back, start, end in found:
        assert back <= start == at < end
        used = system + sum(tokens[back:end])
        assert used <= budget or (end == start + 1 and back == start)  # only a turn that is too long by itself
        assert sum(tokens[back:start]) <= history
        at = end
    assert at == len(tokens)


def digest(rows):
    """What reading back must give, per conversation."""
    out = {}
    for c, _, r, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        n, turns, loss = out.setdefault(c, (0, "", ""))
        out[c] = (n + 1, turns + f"{r or ''}\n{t or ''}\n", loss + (t or "") * (r == "assistant"))
    return {c: (n, hashlib.sha256(a.encode()).hexdigest(), len(b), hashlib.sha256(b.encode()).hexdigest()) for c, (n, a, b) in out.items()}


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, segment string, TEXT int")


def read_back(spark, rows, **kw):
    windows = chat.windows(turns(spark, rows), TOKENIZER, **kw)
    got = chat.digests(windows).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == digest(rows)
    assert len(got) == len(digest(rows))
    return windows


def conversation(rng, c, n, system=True):
    roles = (["system"] if system else []) + ["user", "assistant"] * n
    words = ["hello", "</s>", "[INST]", "ça", "漢字", "\\", "budget"]
    return [(c, i, r, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i, r in enumerate(roles[:n])]


@pytest.mark.parametrize("budget,history", [(2048, 512), (200, 60), (40, 0)])
def test_conversations_come_back(spark, budget, history):
    rng = random.Random(1)
    rows = [row for c in range(30) for row in conversation(rng, c, rng.randint(1, 40), c % 3 == 0)]
    windows = read_back(spark, rows, budget=budget, history=history).collect()
    for w in windows:
        assert w.tokens <= budget or w.new_turns == 1
        said = chat.parse(w.text)
        assert len(said) == w.turns
        first = next((t for c, i, r, t in rows if c == w.conv_id and i == 0 and r == "system"), None)
        if first is not None:
            assert said[0] == ("system", first)  # every window keeps the system turn
    if budget < 300:
        assert any(w.turns > w.new_turns + 1 for w in windows) == (history > 0)


def test_odd_turns(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "no number"), (1, 1, "assistant", ""), (2, 5, "assistant", "x" * 40_000),
            (None, 0, "user", "nobody"), (None, 1, "assistant", "</s>"), (3, 0, "tool", "[INST]"), (3, 0, "assistant", "tie"), (-7, -5, "assistant", "before")]
    read_back(spark, rows, budget=64)


def test_long_conversation_is_dealt_in_segments(spark):
    rows = [(4, i, "system" if i == 0 else ("user", "assistant")[i % 2], f"turn {i} [INST]") for i in range(3000)]
    windows = read_back(spark, rows, budget=300).collect()
    assert {w.segment for w in windows} == {0, 1, 2}
    for w in windows:
        assert chat.parse(w.text)[0] == ("system", "turn 0 [INST]")
    second = next(w for w in windows if w.segment == 1 and w.window == 0)
    assert ("assistant", "turn 1023 [INST]") in chat.parse(second.text)  # history from the segment before
    assert sum(w.new_turns for w in windows) == 3000


@pytest.mark.parametrize("numbers", [lambda i: 2000 * i, lambda i: -10 ** 12 + 1_700_000_000 * i, lambda i: i * i * 10 ** 9])
def test_windows_go_by_order_not_by_numbers(spark, numbers):
    def formatted(n, number):
        rows = [(4, number(i), "system" if i == 0 else ("user", "assistant")[i % 2], f"turn {i}") for i in range(n)]
        return sorted((w.segment, w.window, w.text, w.new_turns) for w in read_back(spark, rows, budget=300).collect())

    dense = formatted(2300, lambda i: i)
    assert formatted(2300, numbers) == dense and any(w[3] < 30 for w in dense)


def test_two_turns_far_apart(spark):
    rows = [(1, 0, "system", "s"), (1, 1_700_000_000_000, "user", "u"), (2, -2 ** 63, "user", "first"), (2, 2 ** 63 - 1, "assistant", "last")]
    assert read_back(spark, rows).count() == 2


def test_long_conversation_without_numbers(spark):
    """Null and equal numbers, and one turn repeated often, are dealt in segments as well."""
    rows = [(5, None, "user", "again")] * 1500 + [(5, None, "user", f"{i:04d}") for i in range(700)] + [(None, 3, "assistant", "x")] * 1100
    windows = read_back(spark, rows, budget=300).collect()
    assert {(w.conv_id, w.segment) for w in windows} == {(5, 0), (5, 1), (5, 2), (None, 0), (None, 1)}
    assert max(w.tokens for w in windows) <= 300


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_are_the_librarys(name):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.encode_special_tokens = True
    rng = random.Random(3)
    marks = [*"  \t\n\xa0\x1c\u3000aAzé0'.,!~漢😀", " a", "  b", " 's", "'s", "<|endoftext|>", " the", "the ", " I'll", "\r\n "]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 30))) for _ in range(20_000)] + ["", "x" * 3000 + " y", " " * 5000 + "z", "ab " * 50_000]
    count = chat.TokenCounter(public_tokenizers.path(name))
    assert (count.fast is not None) == name.startswith("byte")
    got = [n for at in range(0, len(texts), 256) for n in count(texts[at:at + 256])]
    assert got == [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


@pytest.mark.parametrize("n", [2000, 6000])
def test_blocks_leave_no_trace_in_windows(n):
    """The windows of a stream are those of all its turns at once, whatever the block."""
    rng = random.Random(n)
    sizes = [rng.randint(8, 60) for _ in range(n)]
    seen, at = [], chat._Segment(1, 0, 300, 100)
    for i, size in enumerate(sizes):
        at.add((f"<{i}>", 0, 0, False, size), False)
        if at.full():
            seen += at.windows(last=False)
            assert sum(t[4] for t in at.turns[:at.fresh]) <= 100
    seen += at.windows(last=True)
    want = ["".join(f"<{i}>" for i in range(back, end)) for back, _, end in chat.spans(sizes, 0, 0, 300, 100)]
    assert [w[3] for w in seen] == want


def test_repeated_targets_are_masked(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text number {i}") for i in range(20)]
    seen = [w.text[s.start:s.end] for w in sorted(read_back(spark, rows, budget=80, history=40).collect(), key=lambda w: w.window) for s in w.loss]
    assert seen == [f"text number {i}" for i in range(1, 20, 2)]


def test_empty_table(spark):
    assert chat.digests(chat.windows(turns(spark, []), TOKENIZER)).count() == 0
