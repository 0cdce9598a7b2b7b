"""Compact the closed days of the detections table, beside a running detector.

Readers take the table through ``flowspark.sinks.detections.read_detections``.
"""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from flowspark.session import build_session
from flowspark.sinks.detections import compact, vacuum


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--detections", required=True)
    parser.add_argument("--before", type=date.fromisoformat, help="first day that stays; today")
    parser.add_argument("--settled-minutes", type=float, default=60.0)
    parser.add_argument("--vacuum", action="store_true", help="then remove what was replaced")
    args = parser.parse_args(argv)
    spark = build_session("compact")
    known = compact(spark, args.detections, args.before, timedelta(minutes=args.settled_minutes))
    for day, entry in sorted(known.days.items()):
        print(day, f"{entry['rows']} rows in {entry['files']} files for {entry['replaced']}")
    if args.vacuum:
        print(f"{vacuum(spark, args.detections)} replaced folders removed")


if __name__ == "__main__":
    main()
