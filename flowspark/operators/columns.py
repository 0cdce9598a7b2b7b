"""Column names and column choice."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.schema import DASHBOARD_FEATURES, LABEL, PREDICTED, quoted

log = logging.getLogger(__name__)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip column names; of names equal after stripping the first column is kept.

    Columns are addressed by position, so names that differ only by case or are truly
    equal do not become ambiguous.
    """
    first = {}
    for position, name in enumerate(df.columns):
        clean = name.strip()
        if clean in first:
            log.warning("column %r repeats %r and is dropped", name, clean)
        else:
            first[clean] = position
    by_position = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return by_position.selectExpr(*[f"_{i} AS {quoted(clean)}" for clean, i in first.items()])


def rename_strip(df: DataFrame) -> DataFrame:
    """Strip column names by position; nothing is dropped."""
    return df.toDF(*[name.strip() for name in df.columns])


def feature_columns(df: DataFrame, exclude: Iterable[str] = (LABEL,)) -> list[str]:
    left_out = set(exclude)
    return [name for name in df.columns if name not in left_out]


def dashboard_projection(
    df: DataFrame,
    predicted: str = PREDICTED,
    features: Sequence[str] = DASHBOARD_FEATURES,
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """Predicted class and those of the dashboard's features the frame has."""
    wanted = [*passthrough, predicted, *features]
    present = set(df.columns)
    return df.select(*[quoted(c) for c in wanted if c in present])


def computed_once(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same rows, with these columns behind a generator.

    Catalyst copies an expression into every later filter on its result; it does not move
    a filter below a generator, so what made the columns runs once for each row.
    """
    fields = F.struct(*[F.col(quoted(n)).alias(n) for n in names])
    rest = [quoted(c) for c in df.columns if c not in set(names)]
    made = df.select(*rest, F.inline(F.array(fields)))
    return made.select(*[quoted(c) for c in df.columns])
