"""SimHash near-dedup: fingerprints, BK-trees over candidate shards, linked components.

Two fingerprints that differ in at most ``radius`` bits agree in at least
``blocks - radius`` of their ``blocks`` blocks of bits. Each distinct fingerprint is
therefore routed to one shard for each choice of so many blocks, keyed by their bits, and
every link meets in some shard. A shard holds a BK-tree: children are keyed by their
Hamming distance to the parent, and a search follows only the edges within the radius. The
trees live in the tasks that own the shards; broadcasting them would move a structure that
grows with the corpus to every executor. A shard above ``hot_shard`` fingerprints is divided
again by blocks of the bits in another order: its links agree in as many of those, so each
fingerprint goes to as many smaller shards, and no tree is copied. That goes on until no shard
is above it. Every order fixes further bits, with five blocks and three bits all but 13, or 8192
fingerprints, after five of them.

Shards give stars (each fingerprint and the smallest one of its part), never pairs; stars
join to components by alternating large-star and small-star steps on written tables.

Cases: a NULL text or one without words has fingerprint zero and links like any other; a
text of fewer words than a shingle is one shingle. Equal fingerprints are one node, so
copies of any number cost no more than their rows. ``doc_id`` may be NULL or repeated: the
component's id is the smallest known one. An empty table gives no rows. Further columns
do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import saved, ship

BITS = 64
SEED = 42
#: Shingles whose bits are counted at once, and pairs of a search held at once.
SHINGLE_BLOCK = 65_536
SEARCH_BLOCK = 2_000_000
#: Orders of the bits by which shards are divided, the first one as they are. More are never
#: needed: with the fewest blocks, four for three bits, these leave two bits free.
LEVELS = 13


def shingles_of(text: str, width: int) -> list[bytes]:
    """All runs of ``width`` words; a shorter text is one, a text without words has none."""
    words = text.encode().lower().split()  # bytes: A-Z and the six ASCII spaces only
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)))))


def fingerprint_of(text: str, width: int = 3) -> int:
    """Signed 64 bits; each is set if more than half of the shingles' hashes have it."""
    shingles = shingles_of(text, width)
    if not shingles:
        return 0
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(shingles), SHINGLE_BLOCK):
        part = shingles[start : start + SHINGLE_BLOCK]
        hashes = np.fromiter((digest(s, SEED) for s in part), np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(shingles), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    @F.arrow_udf("long")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint_of(t, width) for t in batch.to_pylist()], pa.int64())

    return compute(F.coalesce(text, F.lit("")))


class BKForest:
    """BK-trees over groups of fingerprints, built and searched level by level.

    ``group`` is sorted; the first item of a group is its root.
    """

    def __init__(self, value: np.ndarray, group: np.ndarray) -> None:
        self.value = value
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        self.root = np.repeat(first, np.diff(np.r_[first, len(value)]))
        item = np.flatnonzero(self.root != np.arange(len(value)))
        node = self.root[item]
        edges, children = [], []
        while len(item):
            edge = node * (BITS + 1) + np.bitwise_count(value[item] ^ value[node])
            order = np.argsort(edge, kind="stable")
            item, edge = item[order], edge[order]
            new = np.r_[True, edge[1:] != edge[:-1]]
            child = item[new]
            edges.append(edge[new])
            children.append(child)
            node = np.repeat(child, np.diff(np.r_[np.flatnonzero(new), len(item)]))
            rest = ~new
            item, node = item[rest], node[rest]
        edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.argsort(edge, kind="stable")
        self.edge = edge[order]
        self.child = (np.concatenate(children) if children else np.zeros(0, np.int64))[order]

    def links(self, query: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, other item within the radius), in blocks."""
        waiting = [(query, self.root[query])]
        while waiting:
            item, node = waiting.pop()
            if len(item) > SEARCH_BLOCK:
                half = len(item) // 2
                waiting += [(item[half:], node[half:]), (item[:half], node[:half])]
                continue
            distance = np.bitwise_count(self.value[item] ^ self.value[node]).astype(np.int64)
            near = (distance <= radius) & (item != node)
            if near.any():
                yield item[near], node[near]
            base = node * (BITS + 1)
            low = np.searchsorted(self.edge, base + np.maximum(distance - radius, 0), "left")
            high = np.searchsorted(self.edge, base + np.minimum(distance + radius, BITS), "right")
            count = high - low
            if count.any():
                start = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count)
                place = start + np.arange(count.sum())
                waiting.append((np.repeat(item, count), self.child[place]))


class Parts:
    """Union by smallest index over arrays of pairs."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def find(self, item: np.ndarray) -> np.ndarray:
        top = self.parent[item]
        while True:
            above = self.parent[top]
            if np.array_equal(above, top):
                self.parent[item] = top
                return top
            top = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            if len(a):
                np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _stars(value: np.ndarray, group: np.ndarray, asks: np.ndarray, radius: int):
    """(fingerprint, smaller linked fingerprint) that join all links of the queries."""
    forest, parts = BKForest(value.view(np.uint64), group), Parts(len(value))
    for a, b in forest.links(np.flatnonzero(asks), radius):
        parts.join(a, b)
    top = parts.find(np.arange(len(value)))
    moved = np.flatnonzero(top != np.arange(len(value)))
    return value[moved], value[top[moved]]


def _masks(blocks: int, radius: int, level: int) -> list[int]:
    """The bits of each choice of ``blocks - radius`` blocks, signed."""
    bits = np.arange(BITS) if level == 0 else np.random.default_rng(level).permutation(BITS)
    size = -(-BITS // blocks)
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = 0
        for block in chosen:
            for bit in bits[block * size : (block + 1) * size].tolist():
                mask |= 1 << bit
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def _shard_keys(fp: Column, blocks: int, radius: int, level: int = 0) -> Column:
    """One key for each choice of ``blocks - radius`` blocks: the choice and their bits."""
    keys = [
        F.struct(F.lit(number).alias("choice"), fp.bitwiseAND(F.lit(mask)).alias("bits"))
        for number, mask in enumerate(_masks(blocks, radius, level))
    ]
    return F.array(*keys)


def _dealt(fingerprints: DataFrame, radius: int, blocks: int, hot_shard: int) -> DataFrame:
    """(tree, fp): the shards of two and more; every link meets in one of them."""

    def keyed(rows: DataFrame, level: int, *within: str) -> DataFrame:
        keys = _shard_keys(F.col("fp"), blocks, radius, level)
        return rows.select("fp", *within, F.explode(keys).alias("key")).select(
            "fp", F.xxhash64(*within, "key.choice", "key.bits").alias("tree")
        )

    rows, out = keyed(fingerprints, 0), []
    for level in range(1, LEVELS + 1):
        # Written, so that the join has an exchange for each side and hot shards are split.
        counts = saved(
            rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shards"
        )
        if level == LEVELS or counts.where(F.col("n") > hot_shard).isEmpty():
            out.append(rows.join(counts.select("tree"), "tree").select("tree", "fp"))
            break
        sized = rows.join(counts, "tree")
        out.append(sized.where(F.col("n") <= hot_shard).select("tree", "fp"))
        hot = sized.where(F.col("n") > hot_shard).select("tree", "fp")
        rows = saved(keyed(hot, level, "tree"), "hot-shards")
    return reduce(DataFrame.union, out)


def links(
    fingerprints: DataFrame, radius: int = 3, blocks: int = 5, hot_shard: int = 8192
) -> DataFrame:
    """(a, b): stars, b < a, that connect distinct fingerprints ``fp`` as all links would."""
    dealt = _dealt(fingerprints, radius, blocks, hot_shard)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def found(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            tree, value = rows
            a, b = _stars(value, tree, np.ones(len(value), bool), radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

        def complete() -> tuple[np.ndarray, ...]:
            return tuple(np.concatenate(column) for column in zip(*held))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            if sum(len(h[0]) for h in held) >= 8 * hot_shard:
                rows = complete()
                cut = np.searchsorted(rows[0], rows[0][-1])  # the last tree may go on
                if cut:
                    yield found(tuple(c[:cut] for c in rows))
                held = [tuple(c[cut:] for c in rows)]
        if held:
            yield found(complete())

    return (
        dealt.repartition("tree")
        .sortWithinPartitions("tree", "fp")
        .mapInArrow(search, "a long, b long")
        .where("a is not null")
        .distinct()
    )


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node of each connected component with edges (a, b), b < a.

    A large-star step links every larger neighbour of a node to its smallest one, a
    small-star step every smaller neighbour; both keep components, and rounds end when they
    change nothing. Every round is a written table.
    """

    def sides(pairs: DataFrame) -> DataFrame:
        return pairs.select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                    F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
                )
            ).alias("s")
        ).select("s.*")

    def smallest(rows: DataFrame) -> DataFrame:
        # Written, so that the join has an exchange for each side and a hub's rows are split.
        least = saved(rows.groupBy("u").agg(F.min("v").alias("m")), "least")
        return rows.join(least.select("u", F.least("u", "m").alias("m")), "u")

    def state(pairs: DataFrame) -> tuple[int, int]:
        row = pairs.agg(
            F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")
        ).first()
        return row["n"], row["x"]

    current = saved(edges, "links")
    before = state(current)
    for _ in range(max_rounds):
        if not before[0]:
            break
        large = (
            smallest(sides(current))
            .where("v > u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        small = smallest(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        pairs = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                )
            ).alias("s")
        ).select("s.*")
        current = saved(pairs.where("a > b").distinct(), "links")
        after = state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components still changed after {max_rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


NO_ID = (1 << 63) - 1


def with_components(
    docs: DataFrame, width: int = 3, radius: int = 3, blocks: int = 5
) -> DataFrame:
    """doc_id, text_hash, fp, root and component_id per row of ``docs``.

    ``root`` is the smallest fingerprint of the component and names it uniquely.
    """
    ship(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit(""))
    rows = saved(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            F.xxhash64(text).alias("text_hash"),
            fingerprint(text, width).alias("fp"),
        ),
        "fingerprints",
    )
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(nodes.select("fp"), radius, blocks))
    placed = saved(
        nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "components",
    )
    # Written for the same reason: a root may have most of the fingerprints.
    ids = saved(placed.groupBy("root").agg(F.min("first").alias("component_id")), "ids")
    named = placed.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def first_of_each(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """The row of the smallest doc_id of each root, the columns of ``docs``.

    ``grouped`` has doc_id, text_hash and root of every row.
    """

    def key(doc: Column, text_hash: Column) -> list[Column]:
        return [F.coalesce(doc, F.lit(NO_ID)).alias("_doc"), text_hash.alias("_text")]

    kept = (
        grouped.groupBy("root")
        .agg(F.min(F.struct(*key(F.col("doc_id"), F.col("text_hash")))).alias("kept"))
        .select("kept.*")
    )
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    rows = docs.select(
        *key(docs["doc_id"].cast("long"), text_hash),
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
    )
    # Of rows that are equal in id and text one stays; they combine before their shuffle.
    one = rows.groupBy("_doc", "_text").agg(F.first("_row").alias("_row"))
    return one.join(kept, ["_doc", "_text"], "left_semi").select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns]
    )


def one_of_each(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """The row of the smallest doc_id of each component, the columns of ``docs``."""
    return first_of_each(docs, with_components(docs, width, radius))


def simhash_near_dedup(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    return with_components(docs, width, radius).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
