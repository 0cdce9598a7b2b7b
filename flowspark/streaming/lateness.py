"""Late rows of windowed counts: how many a watermark left out.

Spark counts what its state operator drops after the partial aggregation, that is groups, not
rows. Rows are counted by what they leave: every row read is in a written window, in one that is
still open, or late. Rows read come from the progress of each micro-batch, open ones from the
state in the checkpoint, and both are kept as small tables beside the counts.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

INTAKE = "batch_id long, input_rows long, late_groups long, watermark string"


def intake_rows(query: StreamingQuery) -> dict[int, tuple]:
    """Batch, rows read, groups dropped and watermark of the reports the query still holds."""
    rows: dict[int, tuple] = {}
    for report in query.recentProgress:
        dropped = sum(s.numRowsDroppedByWatermark for s in report.stateOperators)
        watermark = (report.eventTime or {}).get("watermark")
        row = (report.batchId, report.numInputRows, dropped, watermark)
        known = rows.get(report.batchId)
        # A trigger without data reports the batch to come, with no rows.
        if known is None or row[1:3] >= known[1:3]:
            rows[report.batchId] = row
    return rows


def finish_counting(
    query: StreamingQuery, intake: str, timeout: float | None = None, every: float = 0.2
) -> None:
    """Waits for the end of a query and appends its batches to the table ``intake``. Reports are
    gathered while it runs, as it holds the newest only."""
    rows: dict[int, tuple] = {}

    def gather() -> None:
        for batch, row in intake_rows(query).items():
            rows[batch] = max(row, rows.get(batch, row), key=lambda r: r[1:3])

    until = None if timeout is None else time.monotonic() + timeout
    try:
        while not query.awaitTermination(every):
            gather()
            if until is not None and time.monotonic() >= until:
                break
    finally:
        query.stop()
    gather()
    if rows:
        made = SparkSession.active().createDataFrame(list(rows.values()), INTAKE).coalesce(1)
        made.write.mode("append").parquet(intake)


def open_rows(spark: SparkSession, checkpoint: str, count: str = "count") -> int:
    """Rows counted in windows that are still open, from the state of a stopped query."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.agg(F.sum(F.col("value").getField(count))).first()[0] or 0


def late_rows(
    counts: DataFrame, intake: DataFrame, opened: int, count: str = "count"
) -> DataFrame:
    """One row: read, counted, still open and late rows, and the groups Spark saw dropped.

    A batch that was reported twice, by a query that was started again, counts once.
    """
    batches = intake.groupBy("batch_id").agg(
        F.max("input_rows").alias("input_rows"), F.max("late_groups").alias("late_groups")
    )
    seen = batches.agg(
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("read"),
        F.coalesce(F.sum("late_groups"), F.lit(0)).alias("late_groups"),
    )
    written = counts.agg(F.coalesce(F.sum(count), F.lit(0)).alias("counted"))
    # Both are one row.
    return seen.join(written).select(
        "read",
        "counted",
        F.lit(opened).cast("long").alias("open"),
        (F.col("read") - F.col("counted") - F.lit(opened)).alias("late"),
        "late_groups",
    )
