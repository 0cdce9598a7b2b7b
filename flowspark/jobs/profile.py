"""Schema, labels and label counts of CSV files, file by file."""

from __future__ import annotations

import argparse

from flowspark.jobs.options import show_report
from flowspark.operators.columns import rename_strip
from flowspark.operators.profile import invalid_value_profile, profile_by_file
from flowspark.operators.sketches import column_sketches, distinct_estimates, merged_sketches
from flowspark.schema import FEATURES
from flowspark.session import build_session
from flowspark.sources.flow_csv import read_flows


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", nargs="+", required=True)
    parser.add_argument("--infer", action="store_true", help="print the inferred schema")
    parser.add_argument("--values", action="store_true", help="count invalid values per column")
    parser.add_argument(
        "--sketches", help="folder for distinct-count sketches of each file and column (Parquet)"
    )
    parser.add_argument("--rows", type=int, default=1000, help="lines of the report to print")
    parser.add_argument("--output", help="folder for the full reports (CSV)")
    args = parser.parse_args(argv)
    spark = build_session("profile")
    if args.infer:
        rename_strip(read_flows(spark, args.input, infer=True)).printSchema()
    raw = read_flows(spark, args.input, file_column="file")

    def output(name: str) -> str | None:
        return args.output and f"{args.output}/{name}"

    labels = profile_by_file(raw, "file").orderBy("file", "count")
    show_report(labels, args.rows, output("labels"))
    if args.values:
        kinds = invalid_value_profile(raw, FEATURES).orderBy("column", "kind")
        show_report(kinds, args.rows, output("values"))
    if args.sketches:
        column_sketches(raw, FEATURES, by=["file"]).write.mode("overwrite").parquet(args.sketches)
        merged = merged_sketches(spark.read.parquet(args.sketches))
        show_report(distinct_estimates(merged).orderBy("column"), args.rows, output("distinct"))


if __name__ == "__main__":
    main()
