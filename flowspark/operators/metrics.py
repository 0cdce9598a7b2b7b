"""Classification metrics from confusion counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.operators.profile import row_counts


def classification_metrics(
    df: DataFrame, label: str = "label_indexed", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy, weighted recall, weighted precision and F1 of scored rows, as one row."""
    return metrics_from_counts(row_counts(df, [label, prediction]), label, prediction)


def metrics_from_counts(
    counts: DataFrame, label: str = "label_indexed", prediction: str = "prediction"
) -> DataFrame:
    """The same from counted (label, prediction) pairs.

    Each pair adds to its actual class and to its predicted class, which makes the
    per-class totals one aggregation instead of a join.
    """
    def part(name, actual, predicted, hit):
        return F.struct(
            F.col(name).cast("double").alias("class"),
            actual.alias("actual"),
            predicted.alias("predicted"),
            hit.alias("hit"),
        )

    n, none = F.col("count"), F.lit(0).cast("bigint")
    hit = F.when(F.col(label) == F.col(prediction), n).otherwise(none)
    per_class = (
        counts.select(
            F.inline(F.array(part(label, n, none, hit), part(prediction, none, n, none)))
        )
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hit")])
    )
    recall = F.when(F.col("actual") > 0, F.col("hit") / F.col("actual")).otherwise(0.0)
    precision = F.when(F.col("predicted") > 0, F.col("hit") / F.col("predicted")).otherwise(0.0)
    f1 = F.when(
        F.col("hit") > 0,
        2 * F.col("hit") / (F.col("actual") + F.col("predicted")),
    ).otherwise(0.0)
    total = F.sum("actual")
    return per_class.agg(
        (F.sum("hit") / total).alias("accuracy"),
        (F.sum(F.col("actual") * recall) / total).alias("weightedRecall"),
        (F.sum(F.col("actual") * precision) / total).alias("weightedPrecision"),
        (F.sum(F.col("actual") * f1) / total).alias("f1"),
    )
