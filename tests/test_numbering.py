"""Row numbers where one key, or none, has a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from flowspark.operators.numbering import number_rows, range_rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, _place string").repartition(6)


@pytest.mark.parametrize(
    "hot",
    [
        [(None, f"v{i}", "p") for i in range(10_000)],
        [(7, f"v{i}", "p") for i in range(10_000)],
        [(None, "the same", "p")] * 10_000,
    ],
    ids=["no key", "one key", "equal rows without a key"],
)
def test_a_third_of_the_rows_on_one_key(spark, hot, tmp_path):
    rows = [(i, f"w{i}", "p") for i in range(100, 20_100)]
    frame(spark, rows + hot).drop("_place").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    sizes = [r["count"] for r in range_rows(df, "k", 8).groupBy("_range").count().collect()]
    assert sum(sizes) == 30_000 and len(sizes) == 8
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
    got = number_rows(df, "k", "n", partitions=8).collect()
    assert sorted(r.n for r in got) == list(range(1, 30_001))
    in_order = [r.k for r in sorted(got, key=lambda r: r.n)]
    assert in_order == sorted(in_order, key=lambda k: (k is None, k or 0))


def test_columns_and_small_tables(spark):
    df = spark.createDataFrame([(3, {"a": 1}), (None, None), (1, {})], "`a b` long, m map<string,int>")
    got = number_rows(df, "a b", "n")
    assert got.columns == ["a b", "m", "n"]
    assert sorted((r.n, r["a b"]) for r in got.collect()) == [(1, 1), (2, 3), (3, None)]
    assert number_rows(df.where(F.lit(False)), "a b").count() == 0
