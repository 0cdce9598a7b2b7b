"""Packing: token sequences of at most one window, filled by multiway differencing.

Documents are encoded and cut into pieces where they are read; a piece that fills a window
is a sequence by itself, and only lengths and checksums travel. The remaining pieces are
dealt evenly into groups of about ``windows`` windows. In a group, every piece starts as a
partial partition (itself and empty windows); the two partitions of the largest spread are
merged again and again, the fullest windows of one with the emptiest of the other. If the
result has a window above the capacity, the group gets more windows and starts anew.

Cases: a NULL or empty text is the end token alone, so every row has a piece. Repeated rows
are packed each, dealt by their place in the scan and not by their content. An empty table
gives no rows; further columns do not matter.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowspark.llm.common import saved, ship
from flowspark.llm.vocabulary import PRE_TOKEN, cut_texts, default_path, is_simple, load

#: Code points from which a chunk, and a run of white space, is left to the other library.
LONG = 50_000
#: Tokens whose ids are laid out at once, but for a text with more.
BLOCK_TOKENS = 1 << 20


class Encoder:
    """Ids of texts as the tokenizers library gives them.

    Distinct chunks are encoded by tiktoken from the same vocabulary, which takes a fraction of
    the time on short strings, those without further white space all together. Its pattern
    engine overflows on very long runs of white space, so pre-tokens of ``LONG`` code points
    and more are given to the tokenizers library, one by one.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.vocabulary = load(path)
        self._quick = tiktoken.Encoding(
            "packing",
            pat_str=PRE_TOKEN.pattern,
            mergeable_ranks=self.vocabulary.id_of,
            special_tokens={},
        )
        #: Whether a token begins with a space.
        self._spaced = np.zeros(max(self.vocabulary.bytes_of) + 1, bool)
        self._spaced[[i for i, b in self.vocabulary.bytes_of.items() if b[:1] == b" "]] = True

    @cached_property
    def _slow(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def _alone(self, value: str) -> list[int]:
        if len(value) < LONG:
            return self._quick.encode_ordinary(value)
        ids: list[int] = []
        for piece in PRE_TOKEN.findall(value):
            if len(piece) < LONG:
                ids += self._quick.encode_ordinary(piece)
            else:
                ids += self._slow.encode(piece, add_special_tokens=False).ids
        return ids

    def of_values(self, values: list[str], added: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all values one after the other, tokens of each value)."""
        simple = [len(v) < LONG and i not in added and is_simple(v) for i, v in enumerate(values)]
        text = "".join([v for v, together in zip(values, simple) if together])
        joined = self._quick.encode_to_numpy(text) if text else np.zeros(0, np.uint32)
        marks = np.flatnonzero(self._spaced[joined])
        counts = np.zeros(len(values), np.int64)
        is_joined = np.array(simple, bool)
        counts[is_joined] = np.diff(np.r_[marks, len(joined)])
        alone = {
            i: np.array([added[i]] if i in added else self._alone(values[i]), np.uint32)
            for i in np.flatnonzero(~is_joined).tolist()
        }
        for i, ids in alone.items():
            counts[i] = len(ids)
        ends = np.cumsum(counts)
        flat = np.empty(ends[-1] if len(ends) else 0, np.uint32)
        flat[np.repeat(is_joined, counts)] = joined
        for i, ids in alone.items():
            flat[ends[i] - len(ids) : ends[i]] = ids
        return flat, counts

    def encode_all(self, texts: list[str], end_id: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(number of a text, its ids and ``end_id``), every text once, in any order."""
        cut = cut_texts(texts, self.vocabulary)
        flat, counts = self.of_values(cut.values, cut.added)
        first = np.cumsum(counts) - counts
        total = np.r_[0, np.cumsum(counts[cut.codes])][cut.offsets]  # tokens before each row
        low, rows = 0, len(cut.order)
        while low < rows:
            high = max(low + 1, int(np.searchsorted(total, total[low] + BLOCK_TOKENS, "right")) - 1)
            codes = cut.codes[cut.offsets[low] : cut.offsets[high]]
            lengths = counts[codes]
            start = np.cumsum(lengths) - lengths
            ids = flat[np.repeat(first[codes] - start, lengths) + np.arange(lengths.sum())]
            places = total[low : high + 1] - total[low]
            if end_id is not None:
                ids = np.insert(ids, places[1:], np.uint32(end_id))
                places = places + np.arange(high - low + 1)
            for row in range(high - low):
                yield int(cut.order[low + row]), ids[places[row] : places[row + 1]]
            low = high

    def encode(self, text: str) -> bytes:
        """The ids of one text, four little-endian bytes each."""
        ((_, ids),) = self.encode_all([text])
        return ids.astype("<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


#: Pieces of a group, which bounds its partial partitions where pieces are tiny.
GROUP_PIECES = 8192
#: Groups that a task packs where there are many more of them than cores.
GROUPS_A_TASK = 16

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, slot long"


def pieces(docs: DataFrame, capacity: int, grain: int, end_id: int, path: str) -> DataFrame:
    """The pieces of each row; ``slot`` numbers them by their place in the scan.

    What does not fill a window is cut at every ``grain`` tokens: windows of few large
    pieces cannot be brought near each other.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_all
        slot = TaskContext.get().partitionId() << 36
        for batch in batches:
            rows: list[tuple] = []
            doc_ids, texts = (c.to_pylist() for c in batch.columns)
            for number, ids in encode([t or "" for t in texts], end_id):
                n = len(ids)
                full = n - n % capacity
                places = [*range(0, full, capacity), *range(full, n, grain)]
                data = np.ascontiguousarray(ids, "<u4")
                for start, stop in zip(places, [*places[1:], n]):
                    crc = zlib.crc32(data[start:stop])
                    rows.append((doc_ids[number], start, stop - start, crc, n, slot))
                    slot += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 6)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "slot"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def difference(lengths: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each length, fill of each window) by Karmarkar-Karp multiway differencing.

    A partial partition holds the fills of its windows, largest first, and for each window
    a chain of items (its first and last one); merging joins chains.
    """
    follow = np.full(len(lengths), -1)
    heap = []
    for item in np.argsort(-lengths, kind="stable"):
        fills = np.zeros(windows, np.int64)
        first = np.full(windows, -1)
        fills[0], first[0] = lengths[item], item
        heap.append((-int(lengths[item]), int(item), fills, first, first.copy()))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, order, fills, first, last = heapq.heappop(heap)
        _, _, fills2, first2, last2 = heapq.heappop(heap)
        fills2, first2, last2 = fills2[::-1], first2[::-1], last2[::-1]
        both = (first >= 0) & (first2 >= 0)
        follow[last[both]] = first2[both]
        fills = fills + fills2
        first = np.where(first >= 0, first, first2)
        last = np.where(first2 >= 0, last2, last)
        largest = np.argsort(-fills, kind="stable")
        fills, first, last = fills[largest], first[largest], last[largest]
        heapq.heappush(heap, (int(fills[-1] - fills[0]), order, fills, first, last))
    _, _, fills, first, _ = heap[0]
    window = np.empty(len(lengths), np.int64)
    item, place = first[first >= 0], np.flatnonzero(first >= 0)
    while len(item):
        window[item] = place
        item = follow[item]
        place, item = place[item >= 0], item[item >= 0]
    return window, fills


def fill_windows(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each length, none above the capacity, in as few windows as work."""
    total = int(lengths.sum())
    windows = max(1, -(-total // capacity))
    while True:
        window, fills = difference(lengths, windows)
        if fills.max() <= capacity:
            return window
        windows += 1


def packing(
    docs: DataFrame,
    capacity: int = 2048,
    grain: int = 512,
    end_id: int = 1,
    windows: int = 256,
    path: str | None = None,
) -> DataFrame:
    """One row per piece with the sequence it lies in and its offset there."""
    ship(docs.sparkSession)
    cut = saved(pieces(docs, capacity, grain, end_id, path or default_path()), "pieces")
    short = F.col("length") < capacity
    count, tokens = cut.where(short).agg(F.count(F.lit(1)), F.sum("length")).first()
    groups = max(1, round((tokens or 0) / (windows * capacity)), -(-count // GROUP_PIECES))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("slot", ignore_index=True)
        window = fill_windows(group["length"].to_numpy(), capacity)
        # An id that no other group has: the first slot in it is a piece of this group only.
        first = group.groupby(window)["slot"].transform("min")
        group["sequence_id"] = 2 * first + 1
        group["offset"] = group.groupby(window)["length"].cumsum() - group["length"]
        return group.drop(columns=["slot", "_group"])

    result = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    # Groups are small to move and long to pack, so their tasks are not sized by bytes.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    tasks = min(groups, max(4 * cores, groups // GROUPS_A_TASK))
    packed = (
        cut.where(short)
        .withColumn("_group", F.pmod(F.xxhash64("slot"), F.lit(groups)))
        .repartition(tasks, "_group")
        .groupBy("_group")
        .applyInPandas(pack, f"{result}, sequence_id long, offset long")
    )
    full = cut.where(~short).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (2 * F.col("slot")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(full)
