"""Embedding whitening: shifted CholeskyQR over the centred rows, then the SVD of R.

Entries are put on a grid of integers, so sums and deviations are exact and repeated vectors
are equal; each distinct vector is fitted once. A is the centred fit list. Every pass takes
its rows through the triangular solves so far (Q = A R1^-1 R2^-1 ...), adds up the Gram
matrix of Q and factors it by Cholesky. A shift keeps the first factor defined however
ill-conditioned A is; further passes bring Q to orthonormal columns, or to zero where A lacks
rank, and the last Gram matrix enters as its symmetric root. With R the product of all
factors, A^T A = R^T R, so right singular vectors of R are the components and squared
singular values over n the eigenvalues. A^T A itself, which squares the condition number, is
never decomposed.

Rows stay where they are: a task holds one batch and a matrix of dimensions squared, and
hands on its sums row by row of the matrix. The driver sees matrices and sums of the
dimensions only, never vectors; so do the tasks that project. A vector that many rows have is
combined before the shuffle.

Cases: a NULL vector and one with a NULL, NaN or infinite entry are left out. Shorter vectors
are read as ending in zeros, so an empty one is the zero vector; integers beyond 64 bits
stop at the largest. Repeated rows and ids are all returned, a NULL id too. Components of
variance zero cannot be whitened and are not returned: a table of one distinct vector, or an
empty one, gives no rows. A deviation beyond 64 bits is NULL. Further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import saved, ship

SCALE = 64
OFFSET = 1_000_000
#: Rows that a task takes through a solve at once.
BLOCK = 4096
#: Passes over the fit list at most; three do for a condition number below 1e8.
PASSES = 6
#: A column of Q whose squared length is below this has no rank, within this of 1 is done.
NO_RANK, DONE = 1e-10, 1e-6
#: Singular values below this part of the largest count as zero.
RANK = 1e-10
LONG = (1 << 63) - 1


@dataclass
class Model:
    """What projecting needs: sums, components (columns, by falling eigenvalue), eigenvalues."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


def on_grid(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * entry) + offset of each entry."""
    # Casting floating numbers stops at the ends of their range where decimals would fail.
    top = float(1 << 62)
    return F.transform(
        vector,
        lambda c: F.least(F.greatest(F.floor(F.least(F.greatest(
            c.cast("double") * scale, F.lit(-top)), F.lit(top))), F.lit(-(1 << 62))), F.lit(1 << 62))
        + F.lit(offset).cast("long"),
    )


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    infinite = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite)
    )


def _matrix(vectors: pa.Array, width: int, fill: int) -> np.ndarray:
    """Rows of integers of equal width."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    ends = vectors.offsets.to_numpy().astype(np.int64)
    flat = vectors.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(ends)
    if (lengths == width).all():
        return flat[ends[0] : ends[-1]].reshape(len(vectors), width)
    out = np.full((len(vectors), width), fill, np.int64)
    inside = np.arange(width) < lengths[:, None]
    out[inside] = flat[ends[0] : ends[-1]]
    return out


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit integers where they suffice, Python's otherwise."""
    if not x.size or n * max(int(x.max()), -int(x.min())) + max(map(abs, sums), default=0) < LONG:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_differences(x, n, sums) / n).astype(float)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    apart = _differences(x, n, sums)
    largest = max(int(apart.max()), -int(apart.min())) if apart.size else 0
    if largest * largest * max(1, apart.shape[1]) <= LONG:
        return (apart * apart).sum(axis=1, dtype=np.int64).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in apart]
    return [d if d <= LONG else None for d in exact]


def solve_right(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows @ factor^-1 for an upper triangular factor, by forward substitution."""
    out = np.array(rows, order="F")
    for j in range(factor.shape[0]):
        if j:
            out[:, j] -= out[:, :j] @ factor[:j, j]
        out[:, j] /= factor[j, j]
    return out


def _gram(fit: DataFrame, width: int, fill: int, rows_of) -> np.ndarray:
    """Q^T Q, where ``rows_of`` makes rows of Q from rows of integers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                q = rows_of(_matrix(batch.column(0).slice(start, BLOCK), width, fill))
                total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            size = len(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(size), size)),
                    pa.array(np.tile(np.arange(size), size)),
                    pa.array(total.ravel()),
                ],
                ["i", "j", "g"],
            )

    cells = fit.select("x").mapInArrow(add, "i long, j long, g double")
    found = cells.groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow()
    i, j, g = (found[c].to_numpy() for c in ("i", "j", "g"))
    size = int(i.max()) + 1 if len(i) else 0
    out = np.zeros((size, size))
    out[i, j] = g
    return (out + out.T) / 2


def _sums(fit: DataFrame, width: int, fill: int) -> tuple[int, list[int]]:
    """Vectors, and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, [0] * (width + 1)
        for batch in batches:
            x = _matrix(batch.column(0), width, fill)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            n += len(x)
            for place, (h, l) in enumerate(zip(high.tolist(), low.tolist())):
                totals[place] += (h << 32) + l
        if n:
            totals[width] = n  # the last place counts
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width + 1), pa.int64()), pa.array(list(map(str, totals)))],
                ["place", "total"],
            )

    parts = fit.select("x").mapInArrow(add, "place long, total string")
    rows = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("t"))
    found = {r["place"]: int(r["t"]) for r in rows.collect()}
    return found.get(width, 0), [found.get(place, 0) for place in range(width)]


def fit_whitening(fit: DataFrame, components: int, fill: int) -> Model:
    """The model of a written table of distinct vectors ``x`` of integers."""
    width = fit.agg(F.max(F.size("x"))).first()[0] or 0
    n, sums = _sums(fit, width, fill)
    nothing = Model(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    if n < 2 or not width:
        return nothing
    factors: list[np.ndarray] = []
    unit = np.finfo(float).eps / 2
    for number in range(PASSES):
        before = list(factors)

        def rows_of(x: np.ndarray) -> np.ndarray:
            q = _centred(x, n, sums)
            for factor in before:
                q = solve_right(q, factor)
            return q

        gram = _gram(fit, width, fill, rows_of)
        lengths, sides = np.linalg.eigh(gram)
        ready = (lengths < NO_RANK) | (abs(lengths - 1) < DONE)
        if number and (ready.all() or number == PASSES - 1):
            root = np.sqrt(np.where(lengths < NO_RANK, 0, lengths))[:, None] * sides.T
            break
        if not lengths[-1] > 0:
            return nothing
        shift = 11 * (n * width + width * (width + 1)) * unit * lengths[-1]
        # The bound grows with n; a part of the largest eigenvalue keeps the factor's use.
        shift = min(shift, 1e-6 * lengths[-1])
        factors.append(np.linalg.cholesky(gram + shift * np.eye(width)).T)
    whole = root
    for factor in reversed(factors):
        whole = whole @ factor
    _, singular, right = np.linalg.svd(whole)
    kept = np.flatnonzero(singular > RANK * singular[0])[:components]
    values = singular**2 / n
    return Model(n, sums, right[kept].T, values[kept], float(values.sum()))


def whiten(
    table: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    components: int = 16,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> tuple[DataFrame, Model, float]:
    """(rows, model, largest entry by which whitened fit list's covariance misses identity).

    A row for each usable vector: ``key``, ``deviation`` and the array ``whitened``.
    """
    ship(table.sparkSession)
    grid = table.where(usable(F.col(vector))).select(
        F.col(key), on_grid(F.col(vector), scale, offset).alias("x")
    )
    fit = saved(grid.select("x").distinct(), "vectors")
    model = fit_whitening(fit, components, offset)
    n, sums, width = model.n, model.sums, len(model.sums)
    towards = model.components / np.sqrt(model.values)

    def white(x: np.ndarray) -> np.ndarray:
        return _centred(x, n, sums) @ towards

    error = 0.0
    if len(model.values):
        covariance = _gram(fit, width, offset, white) / n
        error = float(abs(covariance - np.eye(len(covariance))).max())

    @F.arrow_udf("struct<deviation:long,whitened:array<double>>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = _matrix(batch, width, offset)
            rows = white(x)
            ends = np.arange(len(x) + 1, dtype=np.int32) * rows.shape[1]
            yield pa.StructArray.from_arrays(
                [
                    pa.array(_deviations(x, n, sums), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel())),
                ],
                ["deviation", "whitened"],
            )

    projected = grid.select(F.col(key), project("x").alias("_p")).select(F.col(key), "_p.*")
    return projected, model, error


def embedding_whitening(embeddings: DataFrame, components: int = 16, **settings) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, one row for
    each usable vector and component."""
    rows, model, error = whiten(embeddings, components=components, **settings)
    explained = [float(v / model.trace) for v in model.values]
    shares = F.array(*map(F.lit, explained)).cast("array<double>")
    return (
        rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_place", "whitened"))
        .select(
            "vec_id",
            (F.col("_place") + 1).alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("_place")).alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
        )
    )
