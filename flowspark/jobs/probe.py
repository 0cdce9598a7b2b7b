"""Is a topic reachable, are there messages, are they JSON, do they parse?"""

from __future__ import annotations

import argparse

from flowspark.jobs.options import add_topic, open_topic, read_topic
from flowspark.schema import PROBE_FEATURES
from flowspark.scratch import new_folder
from flowspark.session import build_session
from flowspark.streaming.health import (
    all_counts,
    message_format,
    missing_batches,
    observed,
    probe_flows,
    run_and_keep_rows,
)
from flowspark.streaming.running import with_trigger


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_topic(parser, starting_offsets="earliest")
    parser.add_argument("--seconds", type=float, default=60.0, help="longest time per check")
    parser.add_argument("--preview", type=int, default=5, help="messages to print")
    args = parser.parse_args(argv)
    spark = build_session("probe")

    def state(ended: bool) -> str:
        return "all read" if ended else f"stopped after {args.seconds} s"

    counts, ended = all_counts(
        open_topic(spark, args), new_folder(spark, "probe-health"), args.seconds
    )
    print("health", counts, state(ended))
    checks = {
        "format": message_format,
        "flows": lambda messages: probe_flows(messages, PROBE_FEATURES),
    }
    for name, check in checks.items():
        # The rows stay on the executors; reports carry counts only.
        stream = check(observed(open_topic(spark, args)))
        writer = stream.writeStream.format("noop").option(
            "checkpointLocation", new_folder(spark, f"probe-{name}")
        )
        query = with_trigger(writer, None).start()
        rows, ended = run_and_keep_rows(query, args.seconds)
        for _, row in sorted(rows.items()):
            print(name, row)
        totals = {c: sum(r.get(c, 0) for r in rows.values()) for c in ("messages", "valid")}
        missing = missing_batches(rows)
        gap = f", without {missing} batches whose reports were gone" if missing else ""
        print(name, totals, state(ended) + gap)
        check(read_topic(spark, args).limit(args.preview)).show(args.preview, truncate=False)


if __name__ == "__main__":
    main()
