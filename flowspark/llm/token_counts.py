"""Token counts: byte-pair tokens at every prefix by dynamic programming.

The encoding of a prefix ends with exactly one token that can follow the encoding of the
rest, so the counts of all prefixes of a pre-token come from one pass: the last token at
each place is the one that BPE leaves apart from the last token before it. No text is
encoded twice: a batch's texts are numbers of distinct chunks, whose pre-tokens go through the
dynamic program once, and a document's counts are sums over its chunks. From the stored
counts, truncation and budget questions are look-ups.

Cases: a NULL or empty text has no tokens. Added tokens inside a text count as one, as the
library's default has it. Rows are counted alone, so repeated rows get equal counts, and
further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import ship
from flowspark.llm.vocabulary import (
    PAIR,
    PRE_TOKEN,
    Vocabulary,
    cut_texts,
    default_path,
    is_simple,
    load,
)

WHITE = regex.compile(r"\s{2,}")

#: Remembered pre-tokens and token pairs of one worker, and code points of the former; each
#: starts anew beyond it, before the next batch or text.
REMEMBERED = 400_000
REMEMBERED_CHARS = 8_000_000


class PrefixCounter:
    """Exact token counts at prefixes of texts, in code points."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._merge, self._left, self._right = (
            vocabulary.merged.get, vocabulary.left, vocabulary.right
        )
        self._pieces: dict[str, bytes | list[int]] = {}
        self._chars = 0
        self._stable: dict[int, bool] = {}

    def stable(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side.

        Undoes the later of both tokens' last merges, again and again. The parts that touch
        must never have a merge that comes before the one just undone; between equal merges
        the left one comes first.
        """
        pair = left << PAIR | right
        known = self._stable.get(pair)
        if known is not None:
            return known
        merge, left_of, right_of = self._merge, self._left, self._right
        bound, result = 1 << 62, True
        while True:
            whole = merge(left << PAIR | right)
            if whole is not None and whole < bound:
                result = False
                break
            if left > right:
                bound, left = left, right_of[left]
            else:
                bound, right = right + 1, left_of[right]
            if left < 0 or right < 0:  # what came last is a byte, so both are
                break
        if len(self._stable) >= REMEMBERED:
            self._stable.clear()
        self._stable[pair] = result
        return result

    def solve(self, pieces: list[str]) -> None:
        """Finds and remembers the prefix counts of sorted pre-tokens.

        At each place one token at most can end the prefix, so the order of trying does not
        matter: the last token grown by a byte comes first, then new tokens from the
        shortest on. What a pre-token shares with the one before it is taken over.
        """
        find, longest, stable = self.vocabulary.id_of.get, self.vocabulary.longest, self.stable
        last, count, begin = [-1], [0], [0]
        before = b""
        for piece in pieces:
            data = piece.encode()
            common, most = 0, min(len(before), len(data))
            while common < most and before[common] == data[common]:
                common += 1
            del last[common + 1 :], count[common + 1 :], begin[common + 1 :]
            start = begin[-1]
            for end in range(common + 1, len(data) + 1):
                token = find(data[start:end])
                if token is None or (start and not stable(last[start], token)):
                    for start in range(end - 1, max(-1, end - longest - 1), -1):
                        token = find(data[start:end])
                        if token is not None and (not start or stable(last[start], token)):
                            break
                last.append(token)
                count.append(count[start] + 1)
                begin.append(start)
            before = data
            if len(data) == len(piece):
                counts = count[1:]
            else:
                counts, place = [], 0
                for char in piece:
                    place += len(char.encode())
                    counts.append(count[place])
            if len(piece) == 3 and piece[0] == "'" and piece[1].isalpha():
                counts[1] = 2  # a contraction cut short is an apostrophe and a letter
            self._pieces[piece] = bytes(counts) if counts[-1] < 256 else counts
            self._chars += len(piece)

    def forget(self) -> None:
        """Starts anew if much is remembered."""
        if len(self._pieces) >= REMEMBERED or self._chars >= REMEMBERED_CHARS:
            self._pieces.clear()
            self._chars = 0

    def _ends(self, piece: str) -> bytes | list[int]:
        """Tokens of every prefix of a pre-token, in code points, the empty one left out."""
        known = self._pieces.get(piece)
        if known is None:
            self.solve([piece])
            known = self._pieces[piece]
        return known

    def _of_values(self, values: list[str], added: dict[int, int]) -> np.ndarray:
        """Tokens of each chunk, all new pre-tokens in one sorted pass."""
        simple = [i not in added and is_simple(v) for i, v in enumerate(values)]
        pieces = PRE_TOKEN.findall("".join([v for v, together in zip(values, simple) if together]))
        place = np.cumsum([piece[0] == " " for piece in pieces]) - 1
        owner = np.flatnonzero(simple)[place] if pieces else np.zeros(0, np.int64)
        more: list[int] = []
        for i in np.flatnonzero(~np.array(simple, bool)).tolist():
            if i not in added:
                found = PRE_TOKEN.findall(values[i])
                pieces += found
                more += [i] * len(found)
        owner = np.r_[owner, np.array(more, np.int64)]
        numbered = pa.array(pieces, pa.large_string()).dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        self.solve(sorted(p for p in distinct if p not in self._pieces))
        known = self._pieces
        totals = np.array([known[p][-1] for p in distinct], np.int64)
        counts = np.bincount(
            owner, weights=totals[numbered.indices.to_numpy()], minlength=len(values)
        ).astype(np.int64)
        counts[list(added)] = 1
        return counts

    def count_all(self, texts: list[str], limit: int | None = None) -> tuple[list[int], list[int]]:
        """Tokens of each text, and, with a limit, the code points of its longest prefix that
        has at most so many tokens."""
        self.forget()
        cut = cut_texts(texts, self.vocabulary)
        counts = self._of_values(cut.values, cut.added)
        before = np.r_[0, np.cumsum(counts[cut.codes])]
        tokens = np.empty(len(texts), np.int64)
        tokens[cut.order] = before[cut.offsets[1:]] - before[cut.offsets[:-1]]
        fitting = list(map(len, texts))
        if limit is None:
            return tokens.tolist(), fitting
        over = np.flatnonzero(tokens[cut.order] > limit)
        if len(over):
            lengths = np.fromiter(map(len, cut.values), np.int64, len(cut.values))
            chars = np.r_[0, np.cumsum(lengths[cut.codes])]
            low = cut.offsets[over]
            # The first chunk that does not fit as a whole.
            at = np.searchsorted(before, before[low] + limit, "right") - 1
            starts = (chars[at] - chars[low]).tolist()
            left = (limit - (before[at] - before[low])).tolist()
            texts_over = cut.order[over].tolist()
            for i, code, start, rest in zip(texts_over, cut.codes[at].tolist(), starts, left):
                part = [1] * len(cut.values[code]) if code in cut.added else self._chunk(cut.values[code])
                fitting[i] = self._within(texts[i], start, part, limit, rest)
        return tokens.tolist(), fitting

    def _chunk(self, value: str) -> list[int]:
        """Tokens of every prefix of a chunk, the empty one left out."""
        counts: list[int] = []
        for piece in PRE_TOKEN.findall(value):
            base = counts[-1] if counts else 0
            counts += [base + n for n in self._ends(piece)]
        return counts

    def _within(self, text: str, start: int, part: list[int], limit: int, rest: int) -> int:
        """Code points of the longest prefix that ends in the chunk from ``start``, of which
        ``rest`` tokens fit."""
        if WHITE.search(text, max(0, start - 1), start + len(part) + 1):
            inside = self.prefixes(text[: start + len(part) + 1])
            return max(i for i, n in enumerate(inside) if n <= limit)
        return start + max((i for i, n in enumerate(part, 1) if n <= rest), default=0)

    def parts(self, text: str) -> list:
        """Prefix counts inside each pre-token of the text, in order."""
        out: list = []
        for i, segment in enumerate(self.vocabulary.segments(text)):
            if i % 2:  # an added token is not cut
                out.append([1] * len(segment))
            else:
                out += map(self._ends, PRE_TOKEN.findall(segment))
        return out

    def count(self, text: str) -> int:
        return sum(part[-1] for part in self.parts(text))

    def prefixes(self, text: str) -> list[int]:
        """Tokens of text[:i] for i = 0, 1, …; inside an added token, of the whole token."""
        counts = [0]
        for part in self.parts(text):
            base = counts[-1]
            counts += [base + n for n in part]
        total = counts[-1]
        for run in WHITE.finditer(text):  # cut inside a run, the run so far is one pre-token
            start = run.start()
            for i, n in enumerate(self._ends(run[0]), 1):
                counts[start + i] = counts[start] + n
        counts[-1] = total
        return counts

    def longest_within(self, text: str, budget: int) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens."""
        return self.count_all([text], budget)[1][0]


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The counter of this worker, which keeps what earlier batches had it remember."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(load(path))
    return _COUNTERS[path]


def prefix_tokens(text: Column, path: str | None = None) -> Column:
    """array<int>: tokens of each prefix of ``text`` of 0, 1, … code points."""
    path = path or default_path()

    @F.arrow_udf("array<int>")
    def table(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = counter(path)
        for batch in batches:
            rows = []
            for text in batch.to_pylist():
                known.forget()
                rows.append(np.array(known.prefixes(text), np.int32))
            yield pa.array(rows, pa.list_(pa.int32()))

    return table(F.coalesce(text, F.lit("")))


def tokens_at(prefixes: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` code points, from a column of ``prefix_tokens``."""
    return F.get(prefixes, F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(prefixes) - 1))


def truncation_point(prefixes: Column, budget: int) -> Column:
    """Code points of the longest prefix within a budget of tokens, from stored counts."""
    places = F.transform(prefixes, lambda n, i: F.when(n <= budget, i))
    return F.array_max(places)


def token_counts(docs: DataFrame, limit: int = 512, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and the code points that fit into ``limit``."""
    path = path or default_path()
    ship(docs.sparkSession)

    @F.arrow_udf("struct<n_tokens:long,fitting_chars:long>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = counter(path)
        for batch in batches:
            tokens, fitting = known.count_all(batch.to_pylist(), limit)
            yield pa.StructArray.from_arrays(
                [pa.array(tokens, pa.int64()), pa.array(fitting, pa.int64())],
                ["n_tokens", "fitting_chars"],
            )

    text = F.coalesce(docs["text"], F.lit(""))
    counted = docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), count(text).alias("_c")
    )
    return counted.select(
        "doc_id",
        "n_bytes",
        "_c.n_tokens",
        (F.col("_c.n_tokens") > limit).alias("over_limit"),
        "_c.fitting_chars",
    )
