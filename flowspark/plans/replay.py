"""Recorded flows to a message topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flowspark.operators.numbering import number_rows
from flowspark.schema import FEATURES, LABEL, flow_schema
from flowspark.scratch import scope
from flowspark.sinks.messages import ReplayTotals, replay_messages, send
from flowspark.sources.flow_csv import CORRUPT, WIDTH, field_count, read_flows


def replay_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    names: Sequence[str] | None = None,
    dense_keys: bool = False,
) -> ReplayTotals:
    """Send every line of the files in one distributed pass.

    Lines with more fields than the header cannot be named and are dropped and
    counted; short lines are sent with the missing fields as ``null``. Keys are unique
    and rise through a file, but have gaps where the scan was cut into tasks. With
    ``dense_keys`` they are 1, 2, 3, ..., for one more pass and a shuffle.
    """
    names = list(names or [*FEATURES, LABEL])
    raw = read_flows(spark, paths, schema=flow_schema(names, label=None), strict=True)
    too_long = field_count(F.col(CORRUPT)) > F.col(WIDTH)
    keyed = raw.withColumn("_key", F.monotonically_increasing_id() + 1)
    with scope():  # the numbered ranges go when all is sent
        if dense_keys:
            keyed = number_rows(keyed.withColumnRenamed("_key", "_position"), "_position", "_key")
        messages = replay_messages(keyed, "_key", names, passthrough=[CORRUPT, WIDTH])
        return send(messages, path=path, dropped=too_long, kafka=kafka)
