"""Whitening against numpy's SVD of the whole centred matrix, and its edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowspark.llm import whitening


def brute(vectors, components=16):
    """By row: deviation and whitened values of every component, up to sign; and the shares."""
    width = max(map(len, vectors))
    full = [[*v, *[0.0] * (width - len(v))] for v in vectors]
    x = np.floor(64 * np.array(full, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    _, singular, right = np.linalg.svd(centred)
    values, sides = np.r_[singular**2 / n, np.zeros(width)][:width], right.T
    kept = [k for k in range(min(components, width)) if values[k] > 1e-18 * values[0]]
    white = ((n * x - sums) / n) @ sides[:, kept] / np.sqrt(values[kept])
    return n, ((n * x - sums) ** 2).sum(axis=1), white, values[kept] / values.sum()


def check(df, ids, vectors, tolerance=1e-8):
    rows = df.toPandas()
    n, deviations, white, shares = brute(vectors)
    assert set(rows.n) == {n} and len(rows) == len(ids) * white.shape[1]
    assert rows.identity_error.nunique() == 1 and rows.identity_error.max() < 1e-6
    got = rows.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < tolerance
    explained = rows.groupby("component").explained.first().to_numpy()
    assert np.abs(explained / shares - 1).max() < 1e-9
    first = rows[rows.component == 1].set_index("vec_id").deviation.loc[ids]
    assert first.tolist() == deviations.tolist()
    return rows


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame(
        [(i, None if v is None else [None if c is None else float(c) for c in v], "x", 1.0)
         for i, v in zip(ids, vectors)],
        "vec_id long, embedding array<float>, deviation string, whitened double",
    ).repartition(5)


def test_query_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [r for r in docs.collect() if r.embedding is not None
            and all(c is not None and np.isfinite(c) for c in r.embedding)]
    check(whitening.embedding_whitening(docs), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_ill_conditioned(spark):
    """Spreads from 4000 down to one step of the grid, mixed over all dimensions."""
    draw = np.random.default_rng(3)
    spread = np.geomspace(4000, 0.5, 12)
    mixed = draw.normal(size=(900, 12)) * spread @ np.linalg.qr(draw.normal(size=(12, 12)))[0]
    vectors = mixed.astype(np.float32).tolist()
    check(whitening.embedding_whitening(table(spark, vectors)), range(900), vectors, 1e-7)


def test_without_full_rank(spark):
    """Constant, repeated and added dimensions; fewer vectors than dimensions."""
    draw = np.random.default_rng(4)
    a = draw.integers(-50, 50, size=(300, 4))
    wide = np.c_[a, a[:, 0], np.full(300, 7), a[:, 1] + a[:, 2], a[:, 3] * 0]
    vectors = (wide / 64).tolist()
    assert check(whitening.embedding_whitening(table(spark, vectors)), range(300), vectors).component.max() == 4
    few = (draw.integers(-50, 50, size=(5, 24)) / 64).tolist()
    assert check(whitening.embedding_whitening(table(spark, few)), range(5), few).component.max() == 4


def test_repeated_vectors_are_fitted_once(spark):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(60, 6)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 40
    check(whitening.embedding_whitening(table(spark, vectors)), range(100), vectors)


def test_unusable_vectors(spark):
    draw = np.random.default_rng(6)
    good = draw.normal(size=(40, 3)).astype(np.float32).tolist() + [[1.5], [], [0.25, -2.0]]
    bad = [None, [1, None, 2], [float("nan"), 1, 1], [float("inf"), 0, 0], [0, -float("inf"), 0]]
    df = table(spark, [*good, *bad])
    check(whitening.embedding_whitening(df), range(len(good)), good)


def test_ids(spark):
    vectors = [[0, 1], [2, 5], [4, 1], [4, 1]]
    rows = whitening.embedding_whitening(table(spark, vectors, [None, None, 9, 9])).collect()
    assert sorted((str(r.vec_id), r.component) for r in rows) == sorted(
        (i, c) for i in ("None", "None", "9", "9") for c in (1, 2)
    )


@pytest.mark.parametrize("vectors", [[], [[1, 2]] * 3, [[]], [None]])
def test_nothing_to_whiten(spark, vectors):
    df = table(spark, vectors) if vectors else table(spark, [[1]]).limit(0)
    assert whitening.embedding_whitening(df).count() == 0


def test_large_numbers(spark):
    """Sums and deviations beyond 64 bits."""
    vectors = [[3e15, 1.0], [-3e15, 2.0], [1e15, 4.0], [3e38, 1.0]]
    rows = whitening.embedding_whitening(table(spark, vectors)).collect()
    assert {r.n for r in rows} == {4} and all(r.deviation is None for r in rows)
    small = whitening.embedding_whitening(table(spark, vectors[:3])).collect()
    assert all(np.isfinite(r.whitened) for r in small)


def test_solve_right():
    draw = np.random.default_rng(7)
    factor = np.triu(draw.normal(size=(9, 9))) + 4 * np.eye(9)
    rows = draw.normal(size=(20, 9))
    assert np.allclose(whitening.solve_right(rows, factor) @ factor, rows)


def test_model_and_rows(spark):
    draw = np.random.default_rng(8)
    df = table(spark, draw.normal(size=(50, 5)).tolist())
    rows, model, error = whitening.whiten(df, components=2)
    assert model.components.shape == (5, 2) and model.values[0] >= model.values[1] and error < 1e-8
    assert rows.columns == ["vec_id", "deviation", "whitened"]
    assert rows.where(F.size("whitened") == 2).count() == 50
