"""Score a topic with a saved model.

``--output`` keeps the detections, with their messages' keys, as a Parquet table of one
folder a day; ``--dashboard`` prints every
micro-batch and keeps its class counts instead.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from flowspark.jobs.options import add_topic, add_trigger, interval, open_topic
from flowspark.operators.classifier import load_model
from flowspark.plans.detection import detect_with_model
from flowspark.schema import LITERAL_DECODE_LABELS
from flowspark.session import build_session
from flowspark.streaming.detection import dashboard_writer
from flowspark.streaming.running import wait_for_any, with_trigger, write_parquet


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_topic(parser, starting_offsets="latest")
    add_trigger(parser)
    parser.add_argument("--model", required=True)
    parser.add_argument("--checkpoint", required=True)
    sink = parser.add_mutually_exclusive_group(required=True)
    sink.add_argument("--output")
    sink.add_argument("--dashboard")
    parser.add_argument("--valid-only", action="store_true", help="skip unreadable messages")
    parser.add_argument(
        "--literal-labels", action="store_true", help="decode by the fixed six-name list"
    )
    args = parser.parse_args(argv)
    spark = build_session("detect")
    model = load_model(args.model)
    detections = detect_with_model(
        open_topic(spark, args),
        model,
        features=model.stages[1].getInputCols(),
        labels=LITERAL_DECODE_LABELS if args.literal_labels else None,
        passthrough=["key"],
        valid_only=args.valid_only,
    )
    if args.output:
        dated = detections.withColumn("detected_on", F.to_date("processing_time"))
        query = write_parquet(
            dated, args.output, args.checkpoint, interval(args), partition_by=["detected_on"]
        )
    else:
        writer = (
            detections.writeStream.foreachBatch(dashboard_writer(args.dashboard))
            .outputMode("append")
            .option("checkpointLocation", args.checkpoint)
        )
        query = with_trigger(writer, interval(args)).start()
    wait_for_any([query])


if __name__ == "__main__":
    main()
