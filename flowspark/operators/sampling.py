"""Samples and splits.

The keyed forms need a key that is unique per row; ``sources.row_identity`` gives rows of files
one from where they stand. Other rows take the forms on ``rand``: they follow the scan's
partitioning, yet copies of a row are drawn independently, where a digest of the row's content
would keep all or none of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.functions.hashing import digest_below, key_digest
from flowspark.schema import COMMON_FRACTION, LABEL, RARE_CLASSES, quoted


def hash_sample(
    df: DataFrame, fraction: float, key: str, seed: int = 42, purpose: str | None = None
) -> DataFrame:
    digest = key_digest(F.col(quoted(key)), seed, purpose)
    return df.filter(digest_below(digest, fraction))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stratified_sample(
    df: DataFrame,
    fractions: Mapping[str, float] | None = None,
    default: float = COMMON_FRACTION,
    key: str | None = None,
    seed: int = 42,
    label: str = LABEL,
) -> DataFrame:
    """Per-class sample in one pass over the input, without a shuffle.

    Classes missing from ``fractions`` are kept at ``default``; the rare classes are
    kept whole unless told otherwise.
    """
    if fractions is None:
        fractions = dict.fromkeys(RARE_CLASSES, 1.0)
    classes_at: dict[float, list[str]] = {}
    for name, fraction in fractions.items():
        classes_at.setdefault(fraction, []).append(name)

    def choose(of) -> Column:
        chosen = F.lit(None)
        for fraction, names in classes_at.items():
            chosen = F.when(F.col(quoted(label)).isin(names), of(fraction)).otherwise(chosen)
        return F.coalesce(chosen, of(default))

    if key is None:
        return df.filter(F.rand(seed) < choose(F.lit))
    digest = key_digest(F.col(quoted(key)), seed)
    return df.filter(choose(lambda fraction: digest_below(digest, fraction)))


def with_split(
    df: DataFrame,
    weights: Mapping[str, float],
    key: str,
    seed: int = 42,
    column: str = "split",
) -> DataFrame:
    """Name of the part each row belongs to, in one pass."""
    digest = key_digest(F.col(quoted(key)), seed, purpose="split")
    total = sum(weights.values())
    *heads, last = weights
    part, reached = F.lit(last), 0.0
    bounds = []
    for name in heads:
        reached += weights[name]
        bounds.append((name, reached / total))
    for name, bound in reversed(bounds):
        part = F.when(digest_below(digest, bound), F.lit(name)).otherwise(part)
    return df.withColumn(column, part)


def hash_split(
    df: DataFrame, weights: Sequence[float], key: str, seed: int = 42
) -> list[DataFrame]:
    """Disjoint parts that together are the input."""
    named = {str(i): w for i, w in enumerate(weights)}
    parts = with_split(df, named, key, seed, column="_split")
    return [parts.filter(F.col("_split") == name).drop("_split") for name in named]


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Spark's own split; it sorts every partition once per part to be repeatable."""
    return df.randomSplit(list(weights), seed=seed)


def scan_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Random split of rows read straight from files, without a key and without a sort.

    ``rand`` follows the partition and the order of rows, both of which a file scan
    repeats on every pass and retry. Not for frames that were shuffled: there
    ``random_split`` pays for its sort.
    """
    drawn = df.withColumn("_draw", F.rand(seed))
    total, low, parts = sum(weights), 0.0, []
    for i, weight in enumerate(weights):
        high = low + weight / total
        inside = F.col("_draw") >= low
        if i < len(weights) - 1:
            inside = inside & (F.col("_draw") < high)
        parts.append(drawn.filter(inside).drop("_draw"))
        low = high
    return parts
