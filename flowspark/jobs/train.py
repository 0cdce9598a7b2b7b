"""Fit the forest on a training set, print held-out metrics, save the model."""

from __future__ import annotations

import argparse

from flowspark.jobs.options import show_report
from flowspark.plans.training import metric_rows, train_and_evaluate
from flowspark.session import build_session
from flowspark.sources.training_set import read_training_set


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--model", required=True)
    parser.add_argument("--key", help="unique column that decides the split; not a feature")
    parser.add_argument("--trees", type=int, default=20)
    parser.add_argument("--depth", type=int, default=5)
    parser.add_argument("--train-share", type=float, default=0.8, help="rows to learn from")
    parser.add_argument(
        "--scored-share", type=float, default=0.3, help="share of the held-out rows to score"
    )
    parser.add_argument("--confusion", help="folder for the full confusion counts (CSV)")
    parser.add_argument("--seed", type=int, default=42)
    args = parser.parse_args(argv)
    spark = build_session("train")
    result = train_and_evaluate(
        read_training_set(spark, args.input),
        key=args.key,
        model_path=args.model,
        seed=args.seed,
        num_trees=args.trees,
        max_depth=args.depth,
        from_files=True,
        train_share=args.train_share,
        scored_share=args.scored_share,
    )
    metric_rows(result.metrics).show(truncate=False)
    show_report(result.confusion, 100, args.confusion)
    result.release()


if __name__ == "__main__":
    main()
