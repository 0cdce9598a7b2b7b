"""Command line options shared by the stream jobs."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from flowspark.sources.messages import read_folder, read_kafka, stream_folder, stream_kafka

MAX_PER_TRIGGER = 1000


def add_topic(parser: argparse.ArgumentParser, starting_offsets: str) -> None:
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--folder", help="folder of message files in place of Kafka")
    parser.add_argument("--topic", default="network_traffic")
    parser.add_argument("--starting-offsets", default=starting_offsets)
    parser.add_argument("--fail-on-data-loss", action="store_true")
    add_limit(parser, "records (Kafka) or files (folder)")


def add_limit(parser: argparse.ArgumentParser, what: str) -> None:
    parser.add_argument(
        "--max-per-trigger",
        type=int,
        default=MAX_PER_TRIGGER,
        help=f"{what} per micro-batch, {MAX_PER_TRIGGER} unless given; 0 for no limit",
    )


def limit(args: argparse.Namespace) -> int | None:
    return args.max_per_trigger or None


def open_topic(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.folder:
        return stream_folder(spark, args.folder, limit(args))
    return stream_kafka(
        spark,
        args.servers,
        args.topic,
        starting_offsets=args.starting_offsets,
        fail_on_data_loss=args.fail_on_data_loss,
        max_offsets_per_trigger=limit(args),
    )


def read_topic(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """What the topic holds now, as a batch."""
    if args.folder:
        return read_folder(spark, args.folder)
    return read_kafka(
        spark, args.servers, args.topic, fail_on_data_loss=args.fail_on_data_loss
    )


def add_trigger(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--interval", default="5 seconds", help="time between micro-batches")
    parser.add_argument(
        "--once", action="store_true", help="process what is there and end, ignoring --interval"
    )


def interval(args: argparse.Namespace) -> str | None:
    return None if args.once else args.interval


def show_report(report: DataFrame, rows: int, output: str | None = None) -> None:
    """Print the first lines and how many were left out; write all of them to ``output``."""
    if output:
        report.write.mode("overwrite").option("header", True).csv(output)
    report.show(rows, truncate=False)
    left_out = report.count() - rows
    if left_out > 0:
        where = output or "nowhere; give a folder for the whole report"
        print(f"{left_out} more lines, written to {where}")
