"""CSV files to the sampled Parquet training set."""

from __future__ import annotations

import argparse

from flowspark.plans.training_set import build_training_set
from flowspark.schema import COMMON_FRACTION, DEFAULT_CLASS, FEATURES
from flowspark.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", nargs="+", required=True, help="CSV files, folders or globs")
    parser.add_argument("--output", required=True)
    parser.add_argument("--key", help="column of unique values that decides what is drawn")
    parser.add_argument("--fraction", type=float, default=COMMON_FRACTION)
    parser.add_argument("--default-class", default=DEFAULT_CLASS)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--by-label", action="store_true", help="one folder per class")
    parser.add_argument("--rebalance", action="store_true", default=None)
    args = parser.parse_args(argv)
    counts = build_training_set(
        build_session("build-training-set"),
        args.input,
        args.output,
        by_label=args.by_label,
        rebalance=args.rebalance,
        features=FEATURES,
        key=args.key,
        default_fraction=args.fraction,
        default_class=args.default_class,
        seed=args.seed,
    )
    counts.show(truncate=False)


if __name__ == "__main__":
    main()
