"""Stored distinct-count sketches."""

import pytest
from pyspark.sql import functions as F

from flowspark.jobs import profile as job
from flowspark.operators.sketches import (
    column_sketches,
    distinct_estimates,
    merged_sketches,
    relative_error,
)
from flowspark.schema import FEATURES, LABEL


@pytest.fixture(scope="module")
def table(spark):
    """Columns of 60,000, 7 and no values; a third of the rows has one value."""
    n = F.col("id")
    return spark.range(90_000).select(
        (n % 9).alias("file"),
        F.when(n % 3 == 0, F.lit("hot")).otherwise(n.cast("string")).alias("many"),
        (n % 7).alias("few"),
        F.lit(None).cast("string").alias("none"),
    )


def test_merging_equals_one_pass(spark, table, tmp_path):
    names = ["many", "few", "none"]
    column_sketches(table, names, by=["file"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 27
    merged = {r["column"]: r for r in distinct_estimates(merged_sketches(stored)).collect()}
    whole = {r["column"]: r for r in distinct_estimates(column_sketches(table, names)).collect()}
    for name, exact in (("many", 60_001), ("few", 7), ("none", 0)):
        bound = 4 * relative_error() * exact
        assert abs(merged[name].distinct_values - exact) <= bound
        assert abs(merged[name].distinct_values - whole[name].distinct_values) <= bound / 2
        assert merged[name]["values"] == whole[name]["values"] and merged[name].missing == whole[name].missing
    assert merged["none"].missing == 90_000


def test_any_grouping_merges_to_the_same(spark, table):
    stored = column_sketches(table, ["many"], by=["file"]).cache()
    thirds = merged_sketches(stored.withColumn("third", F.col("file") % 3), by=["third"])
    direct = distinct_estimates(merged_sketches(stored)).first()
    twice = distinct_estimates(merged_sketches(thirds)).first()
    again = distinct_estimates(merged_sketches(stored.union(stored))).first()
    assert direct.distinct_values == twice.distinct_values == again.distinct_values
    assert twice["values"] == direct["values"] and again["values"] == 2 * direct["values"]


def test_precisions_merge(table):
    fine = column_sketches(table, ["many"], precision=14)
    coarse = column_sketches(table, ["many"], precision=10)
    got = distinct_estimates(merged_sketches(fine.union(coarse))).first().distinct_values
    assert abs(got - 60_001) <= 4 * relative_error(10) * 60_001


def test_empty_table(table):
    got = distinct_estimates(column_sketches(table.limit(0), ["many"])).first()
    assert (got.distinct_values, got["values"], got.missing) == (0, 0, 0)


def test_job_keeps_sketches(spark, tmp_path, capsys):
    for n in range(2):
        lines = [",".join([*(str(i % (k + 1)) for k in range(len(FEATURES))), "BENIGN"]) for i in range(20)]
        (tmp_path / f"{n}.csv").write_text("\n".join([",".join([*FEATURES, LABEL]), *lines]) + "\n")
    job.main(["--input", str(tmp_path), "--sketches", str(tmp_path / "kept")])
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert kept.count() == 2 * len(FEATURES) and kept.select("file").distinct().count() == 2
    assert FEATURES[0] in capsys.readouterr().out
