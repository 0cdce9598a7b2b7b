import math

import pytest
from pyspark.sql import functions as F

from flowspark.operators.sampling import (
    bernoulli_sample,
    hash_sample,
    hash_split,
    random_split,
    scan_split,
    stratified_sample,
    with_split,
)

N = 20_000


@pytest.fixture(scope="module")
def rows(spark):
    label = F.when(F.col("id") % 10 == 0, "BotNet").when(F.col("id") % 10 == 1, None)
    return spark.range(N).withColumn("Label", label.otherwise("BENIGN")).cache()


def within(count, total, fraction, sigmas=5):
    return abs(count - total * fraction) <= sigmas * math.sqrt(total * fraction * (1 - fraction))


def ids(df):
    return {r.id for r in df.select("id").collect()}


def test_hash_sample_ignores_partitioning(rows):
    one = ids(hash_sample(rows.coalesce(1), 0.1, "id"))
    assert one == ids(hash_sample(rows.repartition(7), 0.1, "id"))
    assert within(len(one), N, 0.1)
    assert one != ids(hash_sample(rows, 0.1, "id", seed=43))
    assert one < ids(hash_sample(rows, 0.2, "id"))
    assert hash_sample(rows, 1.0, "id").count() == N
    assert hash_sample(rows, 0.0, "id").count() == 0


def test_bernoulli_size(rows):
    assert within(bernoulli_sample(rows, 0.1).count(), N, 0.1)


def test_splits_are_disjoint_and_complete(rows):
    for parts in (hash_split(rows, [0.8, 0.2], "id"), random_split(rows, [0.8, 0.2])):
        found = [ids(p) for p in parts]
        assert sum(map(len, found)) == N
        assert len(set.union(*found)) == N
        assert within(len(found[0]), N, 0.8)


def test_scan_split(rows, tmp_path):
    path = str(tmp_path / "rows")
    rows.repartition(6).write.parquet(path)
    table = rows.sparkSession.read.parquet(path)
    parts = scan_split(table, [0.7, 0.2, 0.1])
    found = [ids(p) for p in parts]
    assert sum(map(len, found)) == N == len(set.union(*found))
    assert all(within(len(f), N, w) for f, w in zip(found, [0.7, 0.2, 0.1]))
    # another pass, over other columns, draws the same rows
    again = parts[1].filter(F.col("Label") == "BotNet")
    assert ids(again) == {i for i in found[1] if i % 10 == 0}
    plan = parts[0]._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_three_way_split(rows):
    counts = with_split(rows, {"a": 2, "b": 1, "c": 1}, "id").groupBy("split").count()
    sizes = {r.split: r["count"] for r in counts.collect()}
    assert within(sizes["a"], N, 0.5) and within(sizes["b"], N, 0.25)
    assert sum(sizes.values()) == N


def test_sample_and_split_are_independent(rows):
    sampled = hash_sample(rows, 0.1, "id")
    train, _ = hash_split(sampled, [0.8, 0.2], "id")
    assert within(train.count(), sampled.count(), 0.8)


@pytest.mark.parametrize("key", ["id", None])
def test_stratified(rows, key):
    got = stratified_sample(rows, key=key).groupBy("Label").count()
    sizes = {r.Label: r["count"] for r in got.collect()}
    assert sizes["BotNet"] == N // 10
    assert within(sizes["BENIGN"], N * 8 // 10, 0.1)
    assert within(sizes[None], N // 10, 0.1)


def test_stratified_fractions(rows):
    got = stratified_sample(rows, {"BotNet": 0.5, "BENIGN": 0.0}, default=1.0, key="id")
    sizes = {r.Label: r["count"] for r in got.groupBy("Label").count().collect()}
    assert "BENIGN" not in sizes
    assert sizes[None] == N // 10
    assert within(sizes["BotNet"], N // 10, 0.5)


def test_copies_are_drawn_independently_without_a_key(spark):
    copies = spark.range(N).select(F.lit("same").alias("x"), F.lit("BENIGN").alias("Label"))
    assert within(stratified_sample(copies).count(), N, 0.1)


def test_null_keys_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a")], "id long, Label string")
    with pytest.raises(Exception, match="no key"):
        hash_sample(df, 0.5, "id").collect()
