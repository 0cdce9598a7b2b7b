"""Topic to detections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from flowspark.operators.classifier import score
from flowspark.schema import FEATURES
from flowspark.streaming.detection import Scorer, detect


def model_scorer(model: PipelineModel, labels: Sequence[str] | None = None) -> Scorer:
    """Scorer of cleaned flows."""
    return partial(score, model, labels=labels, skip_invalid=False)


def detect_with_model(
    messages: DataFrame,
    model: PipelineModel,
    features: Sequence[str] = FEATURES,
    labels: Sequence[str] | None = None,
    passthrough: Sequence[str] = (),
    valid_only: bool = False,
) -> DataFrame:
    """Detections of a message batch or stream. ``labels`` overrides the names the model
    was fitted with."""
    return detect(messages, features, model_scorer(model, labels), passthrough, valid_only)
