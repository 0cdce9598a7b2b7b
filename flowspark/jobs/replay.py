"""Send recorded CSV flows to a topic."""

from __future__ import annotations

import argparse
import time

from flowspark.plans.replay import replay_csv
from flowspark.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", nargs="+", required=True)
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="Kafka bootstrap servers")
    target.add_argument("--folder", help="folder for message files in place of Kafka")
    parser.add_argument("--topic", default="network_traffic")
    parser.add_argument("--dense-keys", action="store_true", help="keys 1, 2, 3, ...")
    args = parser.parse_args(argv)
    kafka = None
    if args.servers:
        kafka = {"kafka.bootstrap.servers": args.servers, "topic": args.topic}
    started = time.monotonic()
    totals = replay_csv(
        build_session("replay"),
        args.input,
        path=args.folder,
        kafka=kafka,
        dense_keys=args.dense_keys,
    )
    rate = totals.sent / (time.monotonic() - started)
    print(f"sent {totals.sent}, dropped {totals.dropped}, {rate:.0f} messages/s")


if __name__ == "__main__":
    main()
