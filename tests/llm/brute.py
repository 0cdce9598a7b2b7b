"""What the operators must give, computed plainly in one process."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    return (text or "").encode().split()


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    n = len(words)
    return (
        n,
        sum(len(w.decode()) for w in words),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


def substrings(texts, window):
    """(n_words, n_removed, kept_sha256) of each text."""
    rows = [words_of(t) for t in texts]
    starts = Counter()
    for words in rows:
        starts.update(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    out = []
    for words in rows:
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            if starts[tuple(words[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        kept = [w for w, k in zip(words, keep) if k]
        out.append((len(words), len(words) - len(kept), sha(b" ".join(kept))))
    return out


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def lines(docs):
    """[(doc_id, n_lines, n_dropped, kept text)] of (doc_id, text) rows; NULL ids come last."""
    holders = defaultdict(set)
    big = float("inf")
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= 10:
                holders[line_key(line)].add(big if doc is None else doc)
    out = []
    for doc, text in docs:
        own = (text or "").split("\n")
        at = big if doc is None else doc
        kept = [
            line
            for line in own
            if len(line_key(line)) < 10
            or len(holders[line_key(line)]) < 2
            or min(holders[line_key(line)]) == at
        ]
        out.append((doc, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def simhash(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = max(1, len(words) - width + 1)
    shingles = [b" ".join(words[i : i + width]) for i in range(size)]
    ones = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle, 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def component_of(values, radius=3):
    """For each value, the smallest index that it reaches by links."""
    value = np.array(values, np.uint64)
    parent = list(range(len(value)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(value)):
        for j in np.flatnonzero(np.bitwise_count(value ^ value[i]) <= radius):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(value))]


def check_packing(rows, ids_of, capacity=2048):
    """Asserts that pieces hold every id once and lie gapless in sequences; returns the fill."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids_of)
    for doc, own in by_doc.items():
        ids, place = ids_of[doc], 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (place, len(ids)) and r.length > 0
            part = np.array(ids[place : place + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            place += r.length
        assert place == len(ids)
    for own in by_sequence.values():
        place = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= capacity
    return sum(r.length for r in rows) / (capacity * len(by_sequence))
