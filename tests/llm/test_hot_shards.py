"""Hot shards and hot keys are divided, and lose nothing by it."""

from collections import Counter

import numpy as np
import pytest
from brute import component_of

from flowspark.llm import mixing, simhash
from flowspark.llm.fingerprints import _edges_below


@pytest.mark.parametrize("blocks", [5, 4])
def test_hot_shards_are_divided_without_a_loss(spark, blocks):
    """600 fingerprints with equal low bits, and as many near ones."""
    rng = np.random.default_rng(3)
    base = (rng.integers(0, 2**38, 600, dtype=np.uint64) << np.uint64(26)) | np.uint64(12345)
    near = base.copy()
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64)
    value = np.unique(np.r_[base, near])
    df = spark.createDataFrame([(int(v),) for v in value.view(np.int64)], "fp long").repartition(3)
    sizes = simhash._dealt(df, 3, blocks, 32).groupBy("tree").count().toPandas()["count"]
    assert sizes.max() <= 32
    if blocks == 5:
        assert sizes.sum() < 20 * len(value)  # whole copies of the tree: 19 of each in one shard
    found = simhash.links(df, 3, blocks, hot_shard=32)
    rows = simhash.components(found).collect()
    root = {r.node: r.root for r in rows}
    signed = value.view(np.int64).tolist()
    got = [root.get(v, v) for v in signed]
    expected = component_of(value)
    assert len(set(expected)) < len(value)
    groups = lambda names: sorted(
        sorted(v for v, n in zip(signed, names) if n == name) for name in set(names)
    )
    assert groups(got) == groups(expected)


def test_mixing_spreads_rows_without_an_id(spark):
    """A third of the rows have no id and a third are one row: their ranges stay small."""
    rows = [(None, f"text {i} of these") for i in range(900)]
    rows += [(5, "the same text again")] * 900 + [(i, f"own {i} text") for i in range(10, 910)]
    docs = spark.createDataFrame([(d, t, "s", None) for d, t in rows],
                                 "doc_id long, text string, source string, lang string")
    got = mixing.mix(docs, range_rows=64)
    assert got.count() == 2700
    taken = got.groupBy().sum("taken").first()[0]
    target = got.first()["target"]
    assert taken == int(target)
    mixed = mixing.mix_documents(docs, range_rows=64)
    assert mixed.where("doc_id = 5").count() == 900


def test_mixing_keeps_a_null_apart_from_numbers(spark):
    rows = [(None, "a b c", "s")] * 3 + [(-1, "a b c", "s")] * 2 + [(-1, "a b c", None)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = Counter((r.doc_id, r.source) for r in mixing.mix(docs).collect() for _ in range(-(-r.taken // 3)))
    kept = Counter((r.doc_id, r.source) for r in mixing.mix_documents(docs).collect())
    assert taken == kept


def test_rows_repeated_in_full_are_one(spark):
    docs = spark.createDataFrame(
        [(7, "the same text", "x")] * 500 + [(9, "another text of words", "x")],
        "doc_id long, text string, _row string",
    ).repartition(6)
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [7, 9]


def test_edges_below(spark):
    """Places among sorted edges, with repeats, against counting."""
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 120):
        edges = sorted([-(1 << 63), *rng.integers(-5, 40, n).tolist()][: n or None]) if n else []
        values = [-(1 << 63), -6, *range(-5, 42), (1 << 63) - 1]
        df = spark.createDataFrame([(v,) for v in values], "v long")
        got = df.select(
            "v", _edges_below(edges, df["v"], False).alias("less"), _edges_below(edges, df["v"], True).alias("most")
        ).collect()
        for r in got:
            assert (r.less, r.most) == (sum(e < r.v for e in edges), sum(e <= r.v for e in edges))
