"""Numeric cleaning and label mapping of flow records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.functions.labels import canonical_label
from flowspark.functions.numeric import finite_or_zero, to_double
from flowspark.operators.columns import feature_columns, normalize_columns
from flowspark.schema import DEFAULT_CLASS, LABEL, quoted


def cast_features(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Features as DOUBLE, NULL where the text is no number."""
    return df.selectExpr(*map(quoted, keep), *map(to_double, features))


def cast_and_clean(
    df: DataFrame,
    features: Sequence[str] | None = None,
    keep_label: bool = False,
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """Features as finite DOUBLE; NULL, unparsable, NaN and infinite values are 0.0.

    Only the features remain, plus ``Label`` if asked for, plus ``passthrough``. The
    latter keeps keys and timestamps alive for sampling and windowed statistics.

    The cast and the test stand in two projections: Catalyst does not merge a
    projection into one that uses its result twice, so each text is parsed once.
    """
    if features is None:
        features = feature_columns(df, exclude=(LABEL, *passthrough))
    tail = [LABEL] if keep_label and LABEL in df.columns else []
    return cast_features(df, features, keep=[*passthrough, *tail]).selectExpr(
        *map(quoted, passthrough), *map(finite_or_zero, features), *map(quoted, tail)
    )


def fill_missing(df: DataFrame, value: float = 0.0) -> DataFrame:
    """NULL and NaN of numeric columns become ``value``; infinities stay."""
    return df.na.fill(value)


def map_labels(df: DataFrame, default: str = DEFAULT_CLASS, label: str = LABEL) -> DataFrame:
    """Raw label text to class; a frame without the column is returned as it is."""
    if label not in df.columns:
        return df
    return df.withColumn(label, canonical_label(F.col(quoted(label)), default=default))


def preprocess_for_training(
    df: DataFrame,
    features: Sequence[str] | None = None,
    passthrough: Sequence[str] = (),
    default: str = DEFAULT_CLASS,
    drop_null_labels: bool = False,
) -> DataFrame:
    """Clean names, clean numbers, mapped labels."""
    df = normalize_columns(df)
    if drop_null_labels:
        df = df.filter(F.col(LABEL).isNotNull())
    return map_labels(
        cast_and_clean(df, features, keep_label=True, passthrough=passthrough), default
    )


def preprocess_for_inference(
    df: DataFrame,
    features: Sequence[str] | None = None,
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """Clean names and numbers; every column that is no feature goes, labels too."""
    return cast_and_clean(normalize_columns(df), features, passthrough=passthrough)
