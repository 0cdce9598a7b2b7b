"""Is data arriving, and is it readable?"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowspark.functions.messages import is_json_object, is_object, keys_of, once, parse_keys
from flowspark.streaming.parsing import clean_flows, decode_messages
from flowspark.streaming.running import run_for, write_table


def message_format(messages: DataFrame, passthrough: Sequence[str] = ()) -> DataFrame:
    """Per message: is it a JSON object, how many keys, which first, how it begins."""
    text = F.col("json_string")
    parsed = once(decode_messages(messages, passthrough), "parsed", parse_keys(text))
    keys = F.when(is_object(F.col("parsed"), text), keys_of(F.col("parsed")))
    listed = parsed.withColumn("keys", keys)
    return listed.select(
        *passthrough,
        F.col("keys").isNotNull().alias("is_valid"),
        F.coalesce(F.size("keys"), F.lit(0)).alias("n_fields"),
        F.array_join(F.slice("keys", 1, 5), ",").alias("first_fields"),
        F.substring("json_string", 1, 200).alias("beginning"),
    )


def message_health(messages: DataFrame) -> DataFrame:
    """Messages, valid and invalid ones, as one row; on a stream use complete mode."""
    valid = is_json_object(F.col("value").cast("string"))
    counts = messages.agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(valid).alias("valid")
    )
    return counts.withColumn("invalid", F.col("messages") - F.col("valid"))


def observed(messages: DataFrame, name: str = "health") -> DataFrame:
    """Attach the same counts to a stream's progress reports, per micro-batch."""
    valid = is_json_object(F.col("value").cast("string"))
    return messages.observe(
        name, F.count(F.lit(1)).alias("messages"), F.count_if(valid).alias("valid")
    )


def progress_rows(query: StreamingQuery, name: str = "health") -> list[dict]:
    """Batch id, input rows and observed counts of the reports the query still holds."""
    rows = []
    for report in query.recentProgress:
        counts = (report.observedMetrics or {}).get(name)
        rows.append(
            {
                "batch_id": report.batchId,
                "input_rows": report.numInputRows,
                **(counts.asDict() if counts else {}),
            }
        )
    return rows


def total_counts(query: StreamingQuery, name: str = "health") -> dict[str, int]:
    """The counts of :func:`observed` over all reports the query still holds."""
    totals = {"messages": 0, "valid": 0}
    for row in progress_rows(query, name):
        for count in totals:
            totals[count] += row.get(count, 0)
    return totals


def all_counts(
    messages: DataFrame, checkpoint: str, seconds: float, name: str = "message_health"
) -> tuple[dict[str, int], bool]:
    """:func:`message_health` of a stream's present data, and whether all of it was read
    within ``seconds``. The counts are the query's state, so every batch is in them,
    however few progress reports are kept."""
    query = write_table(message_health(messages), name, checkpoint, state_partitions=1)
    ended = run_for(query, seconds)
    row = messages.sparkSession.table(name).first()
    return (row.asDict() if row else {"messages": 0, "valid": 0, "invalid": 0}), ended


def run_and_keep_rows(
    query: StreamingQuery, seconds: float, name: str = "health", every: float = 0.2
) -> tuple[dict[int, dict], bool]:
    """:func:`run_for`, with the :func:`progress_rows` of all batches by batch id. They are
    gathered while the query runs, as it holds the newest reports only."""
    rows: dict[int, dict] = {}

    def gather() -> None:
        for row in progress_rows(query, name):
            known = rows.get(row["batch_id"])
            if known is None or row["input_rows"] >= known["input_rows"]:
                rows[row["batch_id"]] = row

    until, ended = time.monotonic() + seconds, False
    try:
        while not ended and (left := until - time.monotonic()) > 0:
            ended = bool(query.awaitTermination(min(every, left)))
            gather()
    finally:
        query.stop()
    gather()
    return rows, ended


def missing_batches(rows: dict[int, dict]) -> int:
    """Batches before the last one, counted from 0, of which no report was seen."""
    return max(rows) + 1 - len(rows) if rows else 0


def probe_flows(messages: DataFrame, features: Sequence[str]) -> DataFrame:
    """End-to-end parse of a few features, as the health check runs it."""
    return clean_flows(messages, features)
