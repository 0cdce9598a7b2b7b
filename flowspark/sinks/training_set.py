"""The Parquet training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowspark.operators.profile import label_distribution
from flowspark.schema import LABEL


def write_training_set(
    df: DataFrame, path: str, by_label: bool = False, rebalance: bool | None = None
) -> None:
    """Replace the Parquet set at ``path``.

    ``by_label`` lays it out in one folder per class, so that readers of few classes
    skip the rest. Then, or if asked for, the rows are rebalanced first: adaptive
    execution merges small pieces and splits large ones, so a class holding most rows
    still becomes many files of even size. Without it every task writes its own file
    and nothing is shuffled.
    """
    if by_label if rebalance is None else rebalance:
        df = df.hint("rebalance", LABEL) if by_label else df.hint("rebalance")
    writer = df.write.mode("overwrite")
    if by_label:
        writer = writer.partitionBy(LABEL)
    writer.parquet(path)


def written_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per class of a written set. Reads one column of the result in place of
    running the job that made it a second time."""
    return label_distribution(spark.read.parquet(path))
