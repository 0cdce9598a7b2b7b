"""Row selection by class. SQL's three-valued logic holds: a NULL label fails each test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.schema import DEFAULT_CLASS, EXCLUDED_CLASS, LABEL, PREDICTED, RARE_CLASSES


def exclude_class(df: DataFrame, name: str = EXCLUDED_CLASS, label: str = LABEL) -> DataFrame:
    return df.filter(F.col(label) != name)


def keep_classes(
    df: DataFrame, names: Sequence[str] = RARE_CLASSES, label: str = LABEL
) -> DataFrame:
    return df.filter(F.col(label).isin(list(names)))


def drop_classes(
    df: DataFrame, names: Sequence[str] = RARE_CLASSES, label: str = LABEL
) -> DataFrame:
    return df.filter(~F.col(label).isin(list(names)))


def non_benign(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.filter(F.col(label) != DEFAULT_CLASS)


def alerts(df: DataFrame, predicted: str = PREDICTED) -> DataFrame:
    """Flows predicted to be an attack."""
    return df.filter(F.col(predicted) != DEFAULT_CLASS)


def labelled(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.filter(F.col(label).isNotNull())
