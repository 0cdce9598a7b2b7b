"""Counts per time window and class on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowspark.operators.profile import attacks_per_window
from flowspark.schema import PREDICTED


def attacks_per_window_stream(
    detections: DataFrame,
    time: str = "kafka_timestamp",
    label: str = PREDICTED,
    width: str = "1 minute",
    lateness: str = "10 minutes",
) -> DataFrame:
    """Windows leave the state, and in append mode appear in the sink, once the newest
    event is ``lateness`` past their end. Later rows are not counted."""
    return attacks_per_window(detections.withWatermark(time, lateness), time, label, width)
