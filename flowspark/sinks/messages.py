"""Replay of flow records as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from flowspark.functions.messages import to_message
from flowspark.schema import quoted


@dataclass(frozen=True)
class ReplayTotals:
    sent: int
    dropped: int


def replay_messages(
    df: DataFrame,
    key: str,
    names: Sequence[str],
    time: Column | None = None,
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """``key``, ``value`` and ``timestamp`` of each row's message.

    Field names are those of the batch scan, stripped, so a detector reading the
    messages finds every feature it was trained on, the two same-named headers too.
    """
    return df.select(
        F.col(quoted(key)).cast("string").cast("binary").alias("key"),
        to_message(names).cast("binary").alias("value"),
        (F.current_timestamp() if time is None else time).cast("timestamp").alias("timestamp"),
        *[F.col(quoted(c)) for c in passthrough],
    )


def send(
    df: DataFrame,
    path: str | None = None,
    dropped: Column | None = None,
    kafka: dict[str, str] | None = None,
) -> ReplayTotals:
    """Write messages to a folder or to Kafka and count them on the way.

    Rows for which ``dropped`` holds are counted and left out. The counts belong to
    the writing stage itself, whose tasks each report once, so a lost executor does
    not count rows twice.
    """
    bad = F.lit(False) if dropped is None else F.coalesce(dropped, F.lit(False))
    totals = Observation("replay")
    good = (
        df.observe(
            totals, F.count_if(~bad).alias("sent"), F.count_if(bad).alias("dropped")
        )
        .filter(~bad)
        .select("key", "value", "timestamp")
    )
    if kafka is not None:
        good.drop("timestamp").write.format("kafka").options(**kafka).save()
    else:
        good.write.mode("append").parquet(path)
    return ReplayTotals(totals.get["sent"], totals.get["dropped"])
