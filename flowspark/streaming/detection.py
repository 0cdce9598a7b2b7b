"""Live detection."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.operators.columns import dashboard_projection
from flowspark.operators.profile import attack_summary, row_counts
from flowspark.schema import PREDICTED
from flowspark.streaming.parsing import clean_flows

Scorer = Callable[[DataFrame], DataFrame]


def detect(
    messages: DataFrame,
    features: Sequence[str],
    scorer: Scorer,
    passthrough: Sequence[str] = (),
    valid_only: bool = False,
) -> DataFrame:
    """Parse, clean, score and name the class: a stateless chain for batch and stream.

    ``scorer`` adds the predicted class, usually ``partial(score, model)``.
    """
    clean = clean_flows(messages, features, passthrough, valid_only)
    keep = [*passthrough, "kafka_timestamp", "processing_time"]
    return dashboard_projection(scorer(clean), passthrough=keep)


def batch_summary(detections: DataFrame) -> DataFrame:
    """Records per micro-batch and predicted class, from the written detections."""
    return row_counts(detections, ["processing_time", PREDICTED])


def dashboard_writer(path: str, rows: int = 20) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: print a preview and the class counts of each
    non-empty batch and keep the counts at ``path``.

    The batch is scored once and serves all three outputs. A batch run again after a
    failure replaces its own folder, so the kept counts stay right.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            summary = attack_summary(batch).withColumn("batch_id", F.lit(batch_id))
            summary.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            counts = batch.sparkSession.read.parquet(f"{path}/batch={batch_id}")
            records = counts.agg(F.sum("count")).first()[0]
            if records:
                print(f"batch {batch_id}: {records} records")
                batch.show(rows, truncate=False)
                counts.drop("batch_id").orderBy(F.desc("count"), PREDICTED).show(truncate=False)
        finally:
            batch.unpersist()

    return write
