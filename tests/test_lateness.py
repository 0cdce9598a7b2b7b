"""Rows a watermark left out."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from flowspark.streaming.lateness import finish_counting, late_rows, open_rows
from flowspark.streaming.running import write_parquet
from flowspark.streaming.windows import attacks_per_window_stream

SCHEMA = "ts timestamp, Label string"
START = datetime(2026, 1, 1)


def test_every_row_is_counted_open_or_late(spark, tmp_path):
    source, out, checkpoint, intake = (str(tmp_path / n) for n in ("in", "out", "ck", "intake"))

    def at(minute, n, label="DoS"):
        return [(START + timedelta(minutes=minute, seconds=i % 60), label) for i in range(n)]

    batches = [
        at(0, 40) + at(30, 5),  # the watermark goes to minute 20
        at(1, 7) + at(1, 2, "DDoS") + at(25, 3),  # nine rows in two groups are late
        at(2, 4) + at(60, 1),
        at(45, 6),  # before the watermark, its window ended by then
    ]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        counts = attacks_per_window_stream(stream, time="ts", label="Label")
        finish_counting(write_parquet(counts, out, checkpoint, None, 2), intake)
        found = late_rows(
            spark.read.schema(counts.schema).parquet(out), spark.read.parquet(intake),
            open_rows(spark, checkpoint),
        ).first()
        assert found.read == found.counted + found.open + found.late
    assert (found.read, found.late, found.late_groups) == (68, 9 + 4 + 6, 4)
    assert (found.counted, found.open) == (48, 1)


def test_batches_reported_twice_count_once(spark):
    intake = spark.createDataFrame(
        [(0, 10, 0, None), (0, 10, 0, None), (1, 5, 2, "x")],
        "batch_id long, input_rows long, late_groups long, watermark string",
    )
    counts = spark.createDataFrame([(9,)], "count long")
    assert tuple(late_rows(counts, intake, 2).first()) == (15, 9, 2, 4, 2)
    nothing = late_rows(counts.limit(0), intake.limit(0), 0).first()
    assert tuple(nothing) == (0, 0, 0, 0, 0)
    assert late_rows(counts, intake, 2).filter(F.col("late") > 3).count() == 1
