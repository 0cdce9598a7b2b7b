"""A byte-level BPE vocabulary and the cutting of texts before it.

The vocabulary comes from the JSON file of the tokenizers library; its path is a parameter.
Texts are cut at added tokens first, then at single spaces: no pre-token crosses a space
that follows a non-space or precedes one, so each chunk between spaces is encoded apart from
the others. The chunks of a batch are numbered by Arrow, and what is costly is done once for
each distinct one. Where a space stands inside a longer run of white space, the text is cut
by the pre-token pattern itself.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Fixed value: the pre-token pattern of this family of vocabularies.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Bits of the right part in a pair of ids.
PAIR = 24
SPACE = re.compile(r"\s")
OTHER_SPACE = re.compile(r"[^\S ]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable stand-in of each byte: itself if visible, else the next from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """ids by bytes, merges by parts and added tokens of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, byte_of = content["model"], _byte_of()
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.bytes_of = {
            i: bytes(byte_of[c] for c in token)
            for token, i in model["vocab"].items()
            if token not in self.added
        }
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.longest = max(map(len, self.id_of))
        #: Merges by both parts, ``left << PAIR | right``, and the parts of each token.
        self.merged: dict[int, int] = {}
        self.left, self.right = [-1] * len(model["vocab"]), [-1] * len(model["vocab"])
        before = -1
        for left, right in model["merges"]:
            whole = model["vocab"][left + right]
            if whole <= before:
                raise ValueError("ids must rise in the order of merges")
            before = whole
            self.left[whole], self.right[whole] = model["vocab"][left], model["vocab"][right]
            self.merged[self.left[whole] << PAIR | self.right[whole]] = whole
        self._added = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")"
        )

    def segments(self, text: str) -> list[str]:
        """Ordinary text at even places, added tokens at odd ones."""
        if any(token in text for token in self.added):
            return self._added.split(text)
        return [text]


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


class Chunks(NamedTuple):
    """Texts as numbers of distinct chunks; concatenated, a text's chunks are the text."""

    #: The text of each row, and where its chunks begin in ``codes``.
    order: np.ndarray
    offsets: np.ndarray
    codes: np.ndarray
    #: The distinct chunks.
    values: list[str]
    #: The ids of chunks that are added tokens, by number.
    added: dict[int, int]


def _at_spaces(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """(offsets, codes, values, whether a text has a space inside a longer run of white space),
    texts cut at every space."""
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    parts = lists.values.dictionary_encode()
    codes, values = parts.indices.to_numpy(), parts.dictionary.to_pylist()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    count = len(values)
    begins, ends = np.zeros(count, bool), np.zeros(count, bool)
    for code, value in enumerate(values):
        if not value or OTHER_SPACE.search(value):
            begins[code], ends[code] = value[:1].isspace(), value[-1:].isspace()
    empty = np.fromiter((not v for v in values), bool, count)
    left, right = (ends | empty)[codes], (begins | empty)[codes]
    first = offsets[:-1]
    left[first] = ends[codes[first]]  # nothing stands before an empty first chunk
    inside = left[:-1] & right[1:]
    inside[offsets[1:-1] - 1] = False
    before = np.r_[0, np.cumsum(inside)]
    return offsets, codes, values, before[offsets[1:] - 1] > before[first]


def cut_texts(texts: list[str], vocabulary: Vocabulary) -> Chunks:
    """The chunks of a batch of texts."""
    special = [any(token in text for token in vocabulary.added) for text in texts]
    plain = [i for i, found in enumerate(special) if not found]
    if plain:
        offsets, codes, values, inner = _at_spaces([texts[i] for i in plain])
    else:
        offsets, codes, values, inner = np.zeros(1, np.int64), np.zeros(0, np.int32), [], np.zeros(0, bool)
    # The first chunk of a text has no space before it, all others have.
    lengths = np.diff(offsets)
    first = np.zeros(len(codes), bool)
    first[offsets[:-1]] = True
    bare, numbers = np.unique(codes[first], return_inverse=True)
    codes = codes.astype(np.int64)
    codes[first] = len(values) + numbers
    codes = codes[np.repeat(~inner, lengths)]
    whole = [" " + v for v in values] + [values[i] for i in bare]
    used = np.bincount(codes, minlength=len(whole)) > 0
    codes = (np.cumsum(used) - 1)[codes] if len(codes) else codes
    values = [v for v, keep in zip(whole, used.tolist()) if keep]
    order = [i for i, skip in zip(plain, inner.tolist()) if not skip]
    counts = lengths[~inner].tolist()
    # Texts with added tokens or longer runs of white space, by the pattern.
    known: dict[str, int] = {}
    more: list[int] = []
    added: dict[int, int] = {}
    rest = sorted({i for i, found in enumerate(special) if found} | {plain[i] for i in np.flatnonzero(inner)})
    for i in rest:
        before = len(more)
        for number, segment in enumerate(vocabulary.segments(texts[i])):
            if number % 2:
                code = known.setdefault(segment, len(values) + len(known))
                added[code] = vocabulary.added[segment]
                more.append(code)
            else:
                for piece in PRE_TOKEN.findall(segment):
                    more.append(known.setdefault(piece, len(values) + len(known)))
        order.append(i)
        counts.append(len(more) - before)
    return Chunks(
        np.array(order, np.int64),
        np.r_[0, np.cumsum(counts, dtype=np.int64)],
        np.r_[codes, np.array(more, np.int64)],
        values + list(known),
        added,
    )


def is_simple(value: str) -> bool:
    """Whether a chunk is a space and then only other characters; such chunks can be put
    together, and each has one pre-token that begins with a space."""
    return len(value) > 1 and value[0] == " " and not SPACE.search(value, 1)
