"""Properties of the parts that run inside tasks."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowspark.llm import token_counts
from flowspark.llm.chat_format import Formatter, Template
from flowspark.llm.packing import difference, encoder, fill_windows
from flowspark.llm.simhash import _stars
from flowspark.llm.substring_dedup import FMIndex, WaveletMatrix
from flowspark.llm.token_counts import counter
from flowspark.llm.vocabulary import default_path, load

LIBRARY = Tokenizer.from_file(default_path())
PARTS = st.sampled_from(
    ["a", "the", " ", "  ", "\n", "\t", "'s", "'re", "'", "é", "漢", "😀", "12", ".", "!!", "<|endoftext|>",
     "<|", "\x1c", "\x85", "　", " \n ", "ing", "ION", "aaaa", "--"]
)
TEXTS = st.lists(PARTS, max_size=16).map("".join)
CONTROLS = ["<|turn|>", "<|text|>", "<|end|>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "|>", "\n", "a"]


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_and_counts_are_the_librarys(text):
    assert np.frombuffer(encoder(default_path()).encode(text), "<u4").tolist() == ids(text)
    assert counter(default_path()).count(text) == len(ids(text))


@settings(max_examples=150, deadline=None)
@given(TEXTS.map(lambda t: t.replace("<|endoftext|>", "")), st.integers(0, 12))
def test_every_prefix(text, budget):
    known = counter(default_path())
    prefixes = known.prefixes(text)
    assert prefixes == [len(ids(text[:i])) for i in range(len(text) + 1)]
    assert known.longest_within(text, budget) == max(i for i, n in enumerate(prefixes) if n <= budget)


@given(st.lists(st.sampled_from(CONTROLS), max_size=12).map("".join))
def test_escaping_is_reversible(text):
    formatter = Formatter(Template())
    escaped = formatter.escape(text)
    assert formatter.unescape(escaped) == text
    assert not any(control in escaped for control in CONTROLS[:6])


@settings(deadline=None)
@given(st.lists(st.integers(1, 512), min_size=1, max_size=120))
def test_differencing(lengths):
    lengths = np.array(lengths)
    window, fills = difference(lengths, 7)
    assert np.bincount(window, weights=lengths, minlength=7).tolist() == fills.tolist()
    assert np.bincount(fill_windows(lengths, 512), weights=lengths).max() <= 512


@settings(deadline=None)
@given(st.lists(st.integers(0, 5), max_size=80), st.lists(st.integers(1, 5), min_size=1, max_size=6))
def test_backward_search_counts(sequence, pattern):
    """0 ends a segment; no pattern has it."""
    sequence = np.array([*sequence, 0])
    index = FMIndex(sequence, 6, 12)
    low, high = np.array([0]), np.array([len(sequence)])
    for symbol in reversed(pattern):
        low, high = index.extend(np.array([symbol]), low, high)
    n = len(pattern)
    expected = sum(sequence[i : i + n].tolist() == pattern for i in range(len(sequence)))
    assert max(0, (high - low)[0]) == expected


@given(st.lists(st.integers(0, 9), min_size=1, max_size=200))
def test_wavelet_ranks(values):
    values = np.array(values)
    tree = WaveletMatrix(values, 10)
    for symbol in range(10):
        places = np.arange(len(values) + 1)
        expected = np.r_[0, np.cumsum(values == symbol)]
        assert (tree.rank(np.full(len(places), symbol), places) == expected).all()


@settings(deadline=None)
@given(st.sets(st.integers(0, 2**16 - 1), min_size=1, max_size=60))
def test_stars_join_all_links(values):
    value = np.array(sorted(values), np.int64)
    a, b = _stars(value, np.zeros(len(value), np.int64), np.ones(len(value), bool), 3)

    def parts(pairs):
        root = {v: v for v in value.tolist()}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for x, y in pairs:
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
        return [find(v) for v in value.tolist()]
    near = np.bitwise_count(value[:, None] ^ value[None, :]) <= 3
    pairs = [(int(value[i]), int(value[j])) for i, j in zip(*np.nonzero(near))]
    assert parts(zip(a.tolist(), b.tolist())) == parts(pairs)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=6), st.integers(0, 12))
def test_batches(texts, limit):
    """Texts of a batch, whose chunks are numbered together, count and encode as alone."""
    counts, fitting = counter(default_path()).count_all(texts, limit)
    assert counts == [len(ids(t)) for t in texts]
    known = counter(default_path())
    for text, n, chars in zip(texts, counts, fitting):
        inside = known.prefixes(text)
        assert chars == (len(text) if n <= limit else max(i for i, c in enumerate(inside) if c <= limit))
    encoded = dict(encoder(default_path()).encode_all(texts, 1))
    assert [encoded[i].tolist() for i in range(len(texts))] == [[*ids(t), 1] for t in texts]


@pytest.mark.parametrize(
    "text", [" " * 3_000_000, "\n" * 3_000_000, "\t" * 3_000_000, " " * 3_000_000 + "word", "a" * 3_000_000,
             "one  " + " \n" * 1_000_000 + "two", "漢" * 300_000],
    ids=["spaces", "breaks", "tabs", "spaces and a word", "letters", "mixed", "ideographs"],
)
def test_very_long_runs(text):
    wanted = ids(text)
    assert np.frombuffer(encoder(default_path()).encode(text), "<u4").tolist() == wanted
    assert counter(default_path()).count_all([text, ""])[0] == [len(wanted), 0]


def test_what_is_remembered_stays_bounded(monkeypatch):
    """By pre-tokens and by their length, also where prefixes are asked for text by text."""
    monkeypatch.setattr(token_counts, "REMEMBERED", 1000)
    monkeypatch.setattr(token_counts, "REMEMBERED_CHARS", 20_000)
    known = token_counts.PrefixCounter(load(default_path()))
    for n in range(40):
        known.forget()
        known.prefixes(" ".join(f"w{n}x{i}" for i in range(300)))
        assert len(known._pieces) < 1000 + 1300 and len(known._stable) <= 1000
    for n in range(5):
        known.count_all([chr(97 + n) * 19_000])
        assert known._chars < 20_000 + 19_000
