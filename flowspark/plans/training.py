"""Train and evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.operators.classifier import INDEXED, fit_forest, save_model, score
from flowspark.operators.metrics import metrics_from_counts
from flowspark.operators.profile import row_counts
from flowspark.operators.sampling import (
    bernoulli_sample,
    hash_sample,
    hash_split,
    random_split,
)
from flowspark.schema import LABEL
from flowspark.sources.row_identity import ROW_KEY, with_row_key


@dataclass(frozen=True)
class Evaluation:
    model: PipelineModel
    metrics: DataFrame
    confusion: DataFrame
    counts: DataFrame

    def release(self) -> None:
        """Give back the kept counts; the frames stay usable and count anew."""
        self.counts.unpersist()


def split_sets(
    df: DataFrame,
    key: str | None,
    train: float = 0.8,
    scored: float = 0.3,
    seed: int = 42,
    from_files: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Training part, and the sample of the test part that is scored.

    With a key both are decided by digest, each under its own purpose. Without one, rows
    read straight ``from_files`` (Parquet) get theirs from where they stand; others are drawn by
    Spark's own split, which sorts.
    """
    weights = [train, 1.0 - train]
    if key is None and not from_files:
        train_df, test_df = random_split(df, weights, seed)
        return train_df, bernoulli_sample(test_df, scored, seed)
    keyed = with_row_key(df) if key is None else df
    by = key or ROW_KEY
    train_df, test_df = hash_split(keyed, weights, by, seed)
    test_df = hash_sample(test_df, scored, by, seed, purpose="test")
    return (train_df, test_df) if key else (train_df.drop(by), test_df.drop(by))


def evaluate(model: PipelineModel, test: DataFrame, label: str = LABEL) -> Evaluation:
    """Score once and count (label, prediction) pairs; every figure comes from those few
    counts, which are kept until ``release``."""
    counts = row_counts(score(model, test), [label, INDEXED, "prediction"])
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    confusion = counts.select(label, INDEXED, "prediction", "count").orderBy(label, "prediction")
    return Evaluation(model, metrics_from_counts(counts), confusion, counts)


def train_and_evaluate(
    df: DataFrame,
    features: Sequence[str] | None = None,
    key: str | None = None,
    model_path: str | None = None,
    seed: int = 42,
    label: str = LABEL,
    from_files: bool = False,
    train_share: float = 0.8,
    scored_share: float = 0.3,
    **params,
) -> Evaluation:
    """Split, fit, evaluate on held-out rows and save the model if a path is given.

    ``train_share`` of the rows is learned from and ``scored_share`` of the rest scored;
    1.0 scores all that is held out.
    """
    if features is None:
        features = [c for c in df.columns if c not in (label, key)]
    train, test = split_sets(df, key, train_share, scored_share, seed, from_files)
    model = fit_forest(train, features, label, seed=seed, **params)
    result = evaluate(model, test, label)
    if model_path is not None:
        save_model(model, model_path)
    return result


def metric_rows(metrics: DataFrame) -> DataFrame:
    """The metrics as one row each."""
    return metrics.unpivot(
        [], ["accuracy", "weightedRecall", "weightedPrecision", "f1"], "metric", "value"
    ).select("metric", F.round("value", 6).alias("value"))
