"""Attack counts per minute, from the detections table as it grows.

Reading the written detections means every flow is scored once, however many
statistics are kept. With ``--intake``, ``flowspark.streaming.lateness.late_rows`` tells how
many rows came too late for their window.
"""

from __future__ import annotations

import argparse

from flowspark.jobs.options import add_limit, add_trigger, interval, limit
from flowspark.session import build_session
from flowspark.streaming.lateness import finish_counting
from flowspark.streaming.running import ROCKSDB, wait_for_any, write_parquet
from flowspark.streaming.windows import attacks_per_window_stream


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_trigger(parser)
    parser.add_argument("--detections", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--width", default="1 minute")
    parser.add_argument("--lateness", default="10 minutes")
    add_limit(parser, "files of detections")
    parser.add_argument("--state-partitions", type=int, default=8)
    parser.add_argument(
        "--intake", help="folder for what each micro-batch read and dropped, to count late rows"
    )
    args = parser.parse_args(argv)
    spark = build_session("attack-rates")
    for name, value in ROCKSDB.items():
        spark.conf.set(name, value)
    schema = spark.read.parquet(args.detections).schema
    reader = spark.readStream.schema(schema)
    if limit(args):
        reader = reader.option("maxFilesPerTrigger", limit(args))
    detections = reader.parquet(args.detections)
    counts = attacks_per_window_stream(detections, width=args.width, lateness=args.lateness)
    query = write_parquet(
        counts, args.output, args.checkpoint, interval(args), args.state_partitions
    )
    if args.intake:
        finish_counting(query, args.intake)
    else:
        wait_for_any([query])


if __name__ == "__main__":
    main()
