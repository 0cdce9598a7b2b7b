"""Substring dedup: windows of words that start anywhere else are found with FM-indexes.

Equal windows share their anchor, the smallest hash of the short word runs inside. Texts
are cut into segments, runs of windows with one anchor, and segments meet by anchor, so
each window is streamed against the one shard that can hold its other occurrences. Anchors
of a single segment drop out there. Of the rest, the distinct segments of many anchors form
a shard: a compressed FM-index (suffix order up to the window length, wavelet matrix over
the Burrows-Wheeler transform). Backward search extends each segment's match to the left
while at least two occurrences are left and starts again one word before the end when it
fails: these matching statistics give the intervals to remove.

An anchor with more than ``hot_anchor`` segments, or ``ANCHOR_SHARDS`` shards of words, is too
large for one task. Segments are counted by anchor beforehand, so those of such an anchor
never meet; its windows are counted one by one by two hashes instead, combined before the
shuffle.

Texts travel once for each join, compressed, and are keyed by hash and length, so copies of
a text are one text; a text that occurs twice loses every window without a search.

Cases: NULL, empty and short texts have no window and lose nothing. Repeated rows are
copies like any others. ``doc_id`` may be NULL or repeated. An empty table gives no rows;
further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import saved, ship

ANCHOR_WORDS = 5
#: Words hashed at once, words of a shard's index, windows of a streamed piece.
BLOCK_WORDS = 500_000
SHARD_WORDS = 600_000
PIECE_WINDOWS = 128
#: Shards' words that one anchor may have: an index holds whole anchors.
ANCHOR_SHARDS = 2
#: Rows of whole anchors that are counted together.
MET_ROWS = 40_000
#: Texts of a task that are known to have been sent; the set starts anew beyond it.
SEEN = 1_000_000

#: A segment's place and size in one number: first word, whether its anchor repeats, words.
REPEATS = 1 << 31
SIZE = REPEATS - 1

_STEP = 0x9E3779B97F4A7C15
_STEP_BACK = pow(_STEP, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base & ((1 << 64) - 1), np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class Hashes:
    """Hashes of runs of the words of several texts set one after the other."""

    def __init__(self, words: list[bytes]) -> None:
        digest = xxhash.xxh64_intdigest
        self.word = np.fromiter(map(digest, words), np.uint64, len(words))
        weighted = self.word * _powers(_STEP, len(words))
        self._sums = np.r_[np.zeros(1, np.uint64), np.add.accumulate(weighted)]
        self._back = _powers(_STEP_BACK, len(words) + 1)

    def runs(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        total = self._sums[start + size] - self._sums[start]
        return _mixed(total * self._back[start])


def _smallest(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(minimum, its first place) of every ``width`` neighbours."""

    def lower(left: slice, right: slice) -> tuple[np.ndarray, np.ndarray]:
        first = value[left] <= value[right]
        return (
            np.where(first, value[left], value[right]),
            np.where(first, place[left], place[right]),
        )

    value, place, span = values, np.arange(len(values), dtype=np.int32), 1
    while 2 * span <= width:
        value, place = lower(slice(None, -span), slice(span, None))
        span *= 2
    n = len(values) - width + 1
    return lower(slice(n), slice(width - span, width - span + n))


def segments(hashes: Hashes, sizes: np.ndarray, window: int):
    """(anchor, content hash, text, first word in it, words, repeats) of all segments.

    ``repeats`` tells that the anchor lies at several places of the segment, so that a
    window may occur in it twice.
    """
    n = len(hashes.word)
    none = np.zeros(0, np.int64)
    if n < window:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    width = window - ANCHOR_WORDS + 1
    grams = hashes.runs(np.arange(n - ANCHOR_WORDS + 1), ANCHOR_WORDS)
    anchor, anchor_at = _smallest(grams, width)
    ends = np.cumsum(sizes)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(n - window + 1)
    place = place[place + window <= ends[text_of[: len(place)]]]
    anchor, anchor_at = anchor[place], anchor_at[place]
    # Windows across two texts are left out, so a new text is a gap between places.
    changed = (anchor[1:] != anchor[:-1]) | (np.diff(place) != 1)
    first = np.flatnonzero(np.r_[np.ones(min(1, len(place)), bool), changed])
    start = place[first]
    words = np.diff(np.r_[first, len(place)]) + window - 1
    text = text_of[start]
    inside = start - (ends - sizes)[text]
    repeats = anchor_at[first] != anchor_at[np.r_[first[1:], len(place)] - 1]
    return anchor[first], hashes.runs(start, words), text, inside, words, repeats


def _blocks(batches: Iterator[pa.RecordBatch], once: bool) -> Iterator[tuple[list, list[bytes], list[int]]]:
    """((hash, bytes) of texts, their words one after the other, how many), block by block."""
    seen: set[tuple[int, int]] = set()
    keys, words, sizes = [], [], []
    for batch in batches:
        for key, size, text in zip(*(c.to_pylist() for c in batch.columns)):
            if once and (key, size) in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add((key, size))
            own = text.encode().split()
            keys.append((key, size))
            sizes.append(len(own))
            words += own
            if len(words) >= BLOCK_WORDS:
                yield keys, words, sizes
                keys, words, sizes = [], [], []
    if keys:
        yield keys, words, sizes


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


SEGMENT = ["anchor", "content", "text_hash", "text_bytes", "span"]


def _cut(window: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, words, sizes in _blocks(batches, once=True):
            anchor, content, text, start, size, repeats = segments(
                Hashes(words), np.array(sizes), window
            )
            key = np.array(keys, np.int64).reshape(-1, 2)[text]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(anchor),
                    _signed(content),
                    pa.array(key[:, 0]),
                    pa.array(key[:, 1]),
                    pa.array(start << 32 | repeats.astype(np.int64) << 31 | size, pa.int64()),
                ],
                SEGMENT,
            )

    return cut


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor and content: drops anchors of one segment, counts copies.

    ``copies`` is the number of equal segments at the first of them and 0 at the others.
    """

    def judged(rows: list[np.ndarray]) -> pa.RecordBatch:
        anchor, content = rows[0], rows[1]
        n = len(anchor)
        new_anchor = np.r_[True, anchor[1:] != anchor[:-1]]
        new_kind = new_anchor | np.r_[True, content[1:] != content[:-1]]
        group = np.diff(np.r_[np.flatnonzero(new_anchor), n])
        kind = np.flatnonzero(new_kind)
        copies = np.zeros(n, np.int64)
        copies[kind] = np.diff(np.r_[kind, n])
        keep = (np.repeat(group, group) > 1) | (rows[4] & REPEATS != 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in (*rows, copies)], [*SEGMENT, "copies"]
        )

    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(rows[0]):
            continue
        held.append(rows)
        size += len(rows[0])
        if size <= MET_ROWS or held[0][0][0] == rows[0][-1]:
            continue
        rows = [np.concatenate(c) for c in zip(*held)]
        cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last anchor may go on
        yield judged([c[:cut] for c in rows])
        held, size = [[c[cut:] for c in rows]], size - cut
    if size:
        yield judged([np.concatenate(c) for c in zip(*held)])


class WaveletMatrix:
    """Rank of symbols in a sequence; packed bits and a count for each 64 of them."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        self.depth = max(1, int(symbols - 1).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        for level in reversed(range(self.depth)):
            bit = (values >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.r_[packed, np.zeros(8 - len(packed) % 8, np.uint8)].view(np.uint64)
            self.bits.append(packed)
            counts = np.bitwise_count(packed).astype(np.int64)
            self.ones.append(np.r_[0, np.cumsum(counts)])
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.r_[values[bit == 0], values[bit == 1]]
        every = np.arange(symbols)
        #: Where the bottom level has each symbol's first place.
        self.first = self._bottom(every, np.zeros_like(every))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._bottom(symbol, place) - self.first[symbol]

    def _bottom(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for i, level in enumerate(reversed(range(self.depth))):
            ones = self._ones(i, place)
            one = (symbol >> level) & 1 == 1
            place = np.where(one, self.zeros[i] + ones, place - ones)
        return place

    def _ones(self, i: int, place: np.ndarray) -> np.ndarray:
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        inside = self.bits[i][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.ones[i][word] + np.bitwise_count(inside)


class FMIndex:
    """Backward search over a sequence of symbols whose suffixes are sorted by ``order``.

    Counts are right for patterns up to the order. Beyond it, an interval holds places
    where the first ``order`` symbols of the pattern stand, so an extension that finds two
    of them still proves the windows at its left end.
    """

    def __init__(self, sequence: np.ndarray, symbols: int, order: int) -> None:
        n = len(sequence)
        rank, span = sequence.astype(np.int64), 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - span] = rank[span:] + 1
            pair = rank * (n + symbols + 1) + after
            suffixes = np.argsort(pair, kind="stable")
            pair = pair[suffixes]
            new = np.r_[False, pair[1:] != pair[:-1]]
            rank = np.empty(n, np.int64)
            rank[suffixes] = np.cumsum(new)
            span *= 2
            if span > order or rank[suffixes[-1]] == n - 1:
                break
        self.below = np.r_[0, np.cumsum(np.bincount(sequence, minlength=symbols))]
        self.tree = WaveletMatrix(sequence[suffixes - 1], symbols)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of the patterns with one more symbol before them."""
        n = len(symbol)
        rank = self.tree.rank(np.r_[symbol, symbol], np.r_[low, high])
        base = self.below[symbol]
        return base + rank[:n], base + rank[n:]


def matched_windows(index: FMIndex, sequence: np.ndarray, start: np.ndarray, stop: np.ndarray, window: int):
    """(piece, first word, end) of the maximal matches of at least ``window`` words.

    Pieces are [start, stop) of ``sequence``, all streamed at once from their ends; words
    are counted in ``sequence``. Every window inside a match occurs twice or more.
    """
    n = len(sequence)
    piece = np.arange(len(start))
    end = stop.copy()
    place = stop.copy()
    low, high = np.zeros(len(start), np.int64), np.full(len(start), n, np.int64)
    found = []
    while len(piece):
        symbol = sequence[place - 1]
        new_low, new_high = index.extend(symbol, low, high)
        more = new_high - new_low >= 2
        low, high = np.where(more, new_low, low), np.where(more, new_high, high)
        place = np.where(more, place - 1, place)
        done = more & (place == start[piece])
        stopped = ~more | done
        hit = stopped & (end - place >= window)
        if hit.any():
            found.append((piece[hit], place[hit], end[hit]))
        # The next window not known to match ends where its start is one word further left.
        after = np.where(hit, place - 1 + window, end - 1)
        end = np.where(stopped, after, end)
        place = np.where(stopped, end, place)
        low, high = np.where(stopped, 0, low), np.where(stopped, n, high)
        go = ~done & (end - start[piece] >= window)
        piece, end, place, low, high = (x[go] for x in (piece, end, place, low, high))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def _shard(rows: list[tuple[int, int, int, bytes]], window: int) -> pa.RecordBatch:
    """Matches of distinct segments (anchor, content, copies, words) among themselves."""
    number: dict[bytes, int] = {}
    symbols: list[int] = []
    start, size = [], []
    for _, _, _, words in rows:
        own = [number.setdefault(w, len(number) + 1) for w in words.split(b" ")]
        start.append(len(symbols))
        size.append(len(own))
        symbols += own
        symbols.append(0)
    streamed = np.array(symbols, np.int64)
    start, size = np.array(start), np.array(size)
    # A segment with copies stands in the index twice, so that counts see them.
    twice = np.flatnonzero(np.array([copies > 1 for _, _, copies, _ in rows]))
    again = [streamed[start[i] : start[i] + size[i] + 1] for i in twice]
    sequence = np.concatenate([streamed, *again])
    index = FMIndex(sequence, len(number) + 1, window)
    pieces = [
        (i, p)
        for i in range(len(rows))
        for p in range(0, int(size[i]) - window + 1, PIECE_WINDOWS)
    ]
    owner = np.array([i for i, _ in pieces])
    low = start[owner] + np.array([p for _, p in pieces])
    high = np.minimum(low + PIECE_WINDOWS + window - 1, start[owner] + size[owner])
    piece, first, end = matched_windows(index, sequence, low, high, window)
    of = owner[piece]
    first, end = first - start[of], end - start[of]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[i][0] for i in of.tolist()], pa.int64()),
            pa.array([rows[i][1] for i in of.tolist()], pa.int64()),
            pa.array(first, pa.int64()),
            pa.array(end, pa.int64()),
        ],
        ["anchor", "content", "first", "end"],
    )


def _search(window: int) -> Callable:
    """Rows sorted by anchor and content into shards of whole anchors, searched one by one."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, bytes]] = []
        words = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and rows[-1][:2] == row[:2]:
                    continue  # the same segment, cut from another copy of its text
                if words >= SHARD_WORDS and rows[-1][0] != row[0]:
                    yield _shard(rows, window)
                    rows, words = [], 0
                rows.append(row)
                words += row[3].count(b" ") + 1
        if rows:
            yield _shard(rows, window)

    return search


def _packed(docs: DataFrame) -> DataFrame:
    """(text_hash, text_bytes, packed): each distinct text of a task once, compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out = []
            for key, size, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, size) not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add((key, size))
                    out.append((key, size, squeeze(text.encode())))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], pa.int64()),
                    pa.array([r[1] for r in out], pa.int64()),
                    pa.array([r[2] for r in out], pa.binary()),
                ],
                ["text_hash", "text_bytes", "packed"],
            )

    return docs.mapInArrow(pack, "text_hash long, text_bytes long, packed binary")


def _unpacked(packed: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed).split()


TEXT = ["text_hash", "text_bytes"]


def removed_spans(texts: DataFrame, window: int, hot_anchor: int) -> DataFrame:
    """(text_hash, text_bytes, first, end): words of texts to remove, spans may overlap."""
    fields = "anchor long, content long, text_hash long, text_bytes long, span long"
    segments = saved(texts.mapInArrow(_cut(window), fields), "segments")
    words = F.col("span").bitwiseAND(F.lit(SIZE))
    hot_anchors = saved(
        segments.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(words).alias("words"))
        .where((F.col("n") > hot_anchor) | (F.col("words") > ANCHOR_SHARDS * SHARD_WORDS))
        .select("anchor"),
        "hot-anchors",
    )
    any_hot = not hot_anchors.isEmpty()
    cold = segments.join(hot_anchors, "anchor", "left_anti") if any_hot else segments
    met = saved(
        cold.repartition("anchor")
        .sortWithinPartitions("anchor", "content", "text_hash", "span")
        .mapInArrow(_meet, f"{fields}, copies long"),
        "met",
    )
    wanted = (
        met.where("copies > 0")
        .groupBy(*TEXT)
        .agg(F.collect_list(F.struct("anchor", "content", "span", "copies")).alias("wanted"))
    )
    sent = _packed(texts).join(wanted, TEXT).select(*TEXT, "packed", "wanted")

    def words_of_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for packed, wanted in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = _unpacked(packed)
                for w in wanted:
                    first, size = w["span"] >> 32, w["span"] & SIZE
                    body = b" ".join(words[first : first + size])
                    out.append((w["anchor"], w["content"], w["copies"], body))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                ["anchor", "content", "copies", "words"],
            )

    matches = saved(
        sent.mapInArrow(words_of_segments, "anchor long, content long, copies long, words binary")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "content")
        .mapInArrow(_search(window), "anchor long, content long, first long, end long"),
        "matches",
    )
    offset = F.shiftright("span", 32)
    spans = met.join(matches, ["anchor", "content"]).select(
        *TEXT, (offset + F.col("first")).alias("first"), (offset + F.col("end")).alias("end")
    )
    if not any_hot:
        return spans
    hot = segments.join(hot_anchors, "anchor", "left_semi")
    return spans.unionByName(_hot_spans(texts, hot, window))


def _hot_spans(texts: DataFrame, hot: DataFrame, window: int) -> DataFrame:
    """Spans of the windows of hot anchors that occur twice, by counts of whole windows."""
    wanted = hot.groupBy(*TEXT).agg(F.collect_set("span").alias("wanted"))
    sent = _packed(texts).join(wanted, TEXT).select(*TEXT, "packed", "wanted")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, size, packed, wanted = (c.to_pylist() for c in batch.columns)
            for i in range(len(key)):
                words = _unpacked(packed[i])
                hashes, salted = Hashes(words), Hashes([b"\x00" + w for w in words])
                places = np.unique(
                    np.concatenate(
                        [np.arange(s >> 32, (s >> 32) + (s & SIZE) - window + 1) for s in wanted[i]]
                    )
                )
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(hashes.runs(places, window)),
                        _signed(salted.runs(places, window)),
                        pa.array(np.full(n, key[i]), pa.int64()),
                        pa.array(np.full(n, size[i]), pa.int64()),
                        pa.array(places, pa.int64()),
                    ],
                    ["h1", "h2", *TEXT, "first"],
                )

    each = saved(
        sent.mapInArrow(windows, "h1 long, h2 long, text_hash long, text_bytes long, first long")
        .distinct(),
        "windows",
    )
    shared = each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return each.join(shared.select("h1", "h2"), ["h1", "h2"]).select(
        *TEXT, "first", (F.col("first") + window).alias("end")
    )


def substring_dedup(docs: DataFrame, window: int = 35, hot_anchor: int = 20_000) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    ship(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit(""))
    keyed = docs.select(
        "doc_id",
        F.xxhash64(text).alias("text_hash"),
        F.octet_length(text).cast("long").alias("text_bytes"),
        text.alias("text"),
    )
    texts = keyed.select(*TEXT, "text")
    spans = (
        removed_spans(texts, window, hot_anchor)
        .groupBy(*TEXT)
        .agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    )
    rows = keyed.select("doc_id", *TEXT)
    copies = rows.groupBy(*TEXT).agg(F.count(F.lit(1)).alias("copies"))

    @F.arrow_udf("struct<n_words:long,n_removed:long,kept_sha256:string>")
    def digest(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for packed, spans, copies in batches:
            out = []
            for body, own, n in zip(packed.to_pylist(), spans.to_pylist(), copies.to_pylist()):
                words = _unpacked(body)
                keep = np.ones(len(words), bool)
                if n > 1 and len(words) >= window:
                    keep[:] = False
                for span in own or ():
                    keep[span["first"] : span["end"]] = False
                kept = [words[i] for i in np.flatnonzero(keep).tolist()]
                out.append(
                    {
                        "n_words": len(words),
                        "n_removed": len(words) - len(kept),
                        "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
                    }
                )
            yield pa.array(
                out,
                pa.struct(
                    [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
                ),
            )

    # Written, so that the rows of a text that many documents are can be split.
    digests = saved(
        _packed(texts)
        .join(copies, TEXT)
        .join(spans, TEXT, "left")
        .select(*TEXT, digest("packed", "spans", "copies").alias("d"))
        .groupBy(*TEXT)
        .agg(F.min("d").alias("d")),
        "digests",
    )
    return rows.join(digests, TEXT).select("doc_id", "d.n_words", "d.n_removed", "d.kept_sha256")
