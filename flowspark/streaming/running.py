"""Starting and ending queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from flowspark.session import in_session, with_settings

# State outside the JVM's heap, of which a checkpoint writes the changes only.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def with_trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Micro-batches at ``interval``, or, without one, all present data and then the end."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def with_state_stores(stream: DataFrame, partitions: int | None) -> DataFrame:
    """The stream for a query with this many state stores. A query keeps the number it first
    started with. Counts per class, or per class and minute, need few: each task sends one
    partial count per group, so more stores only add overhead to every batch. The number
    belongs to a clone of the session, whatever else is planned meanwhile."""
    if partitions is None:
        return stream
    return in_session(stream, with_settings(stream.sparkSession, {SHUFFLE_PARTITIONS: partitions}))


def write_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "5 seconds",
    state_partitions: int | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to a Parquet table. The sink's log makes a restarted query continue
    without repeating or losing rows. ``partition_by`` gives each value a folder."""
    writer = (
        with_state_stores(stream, state_partitions)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, interval).start()


def write_table(
    stream: DataFrame,
    name: str,
    checkpoint: str,
    interval: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep the newest full result as an in-memory table of the driver. Only for
    aggregates whose number of rows is bounded, such as counts per class."""
    own = with_state_stores(stream, state_partitions)
    writer = (
        own.writeStream.format("memory")
        .queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
    )
    query = with_trigger(writer, interval).start()
    if own is not stream:
        table = in_session(own.sparkSession.table(name), stream.sparkSession)
        table.createOrReplaceTempView(name)
    return query


def finish(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for the end, at most ``timeout`` seconds; stop the query in every case."""
    try:
        ended = query.awaitTermination() if timeout is None else query.awaitTermination(timeout)
        if timeout is not None and not ended:
            raise TimeoutError(f"query {query.name or query.id} still runs after {timeout} s")
    finally:
        query.stop()
    return query


def run_until(query: StreamingQuery, seconds: float) -> bool:
    """Wait for the end at most ``seconds`` seconds and leave the query running; whether it has
    ended. A failure is raised."""
    return bool(query.awaitTermination(seconds))


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Wait for the end at most ``seconds`` seconds, then stop the query. True if it had
    ended; its progress reports tell what it did either way, and a failure is raised."""
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


def wait_for_any(queries: Sequence[StreamingQuery]) -> None:
    """Wait until one query ends or fails, then stop the others; a failure is raised.

    Asks the queries themselves: the session's own wait returns at once if any earlier
    query of the session has ended.
    """
    try:
        while all(query.isActive for query in queries):
            queries[0].awaitTermination(1)
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
