"""Message topics: Kafka, or a folder of Parquet files with the same three columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE_SCHEMA = "key binary, value binary, timestamp timestamp"


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source. Start at ``latest`` for live detection, at
    ``earliest`` to see the whole topic."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return {**options, **(extra or {})}


def stream_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Live topic. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, **options)).load()


def read_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """What the topic holds now, as a batch."""
    options.setdefault("starting_offsets", "earliest")
    reader = spark.read.format("kafka")
    return reader.options(**kafka_options(servers, topic, **options)).load()


def stream_folder(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Message files as a stream; the file limit plays the part of the offset limit."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)
