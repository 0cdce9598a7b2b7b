import random
from collections import Counter

from flowspark.operators.metrics import classification_metrics
from flowspark.operators.numbering import number_rows
from flowspark.operators.profile import (
    attack_summary,
    confusion_counts,
    distinct_per_column,
    invalid_value_profile,
    label_distribution,
    profile_by_file,
    top_k,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F


def test_distribution_is_ordered(spark):
    df = spark.createDataFrame([(x,) for x in "bbaaccc"], ["Label"])
    assert label_distribution(df).collect() == [("a", 2), ("b", 2), ("c", 3)]
    predicted = df.withColumnRenamed("Label", "Predicted_Attack")
    assert attack_summary(predicted).collect() == [("c", 3), ("a", 2), ("b", 2)]
    assert top_k(predicted, 2).collect() == [("c", 3), ("a", 2)]


def test_confusion_order(spark):
    df = spark.createDataFrame([("b", 0.0), ("a", 1.0), ("a", 0.0), ("a", 0.0)],
                               ["Label", "prediction"])
    assert confusion_counts(df).collect() == [("a", 0.0, 2), ("a", 1.0, 1), ("b", 0.0, 1)]


def test_distinct_per_column(spark):
    df = spark.createDataFrame([("1", 1), ("1", 2), (None, 3)], "a string, b int")
    for exact in (True, False):
        got = distinct_per_column(df, ["a", "b"], exact=exact).collect()
        assert {r["column"]: r.distinct_values for r in got} == {"a": 1, "b": 3}


def test_invalid_values(spark):
    df = spark.createDataFrame([("1", None), ("x", "NaN"), ("2", "inf")], "a string, b string")
    got = Counter({(r["column"], r.kind): r["count"]
                   for r in invalid_value_profile(df, ["a", "b"]).collect()})
    assert got == {("a", "valid"): 2, ("a", "unparsable"): 1, ("b", "null"): 1, ("b", "nan"): 1,
                   ("b", "+inf"): 1}


def test_profile_by_file(spark):
    df = spark.createDataFrame([("f", "BENIGN"), ("f", "Bot"), ("f", None), ("g", "BENIGN")],
                               ["file", "Label"])
    got = {(r.file, r.Label): tuple(r)[2:] for r in profile_by_file(df, "file").collect()}
    assert got[("f", "Bot")] == (1, 3, 3, 1)
    assert got[("g", "BENIGN")] == (1, 1, 1, 0)


def test_metrics_equal_mllib(spark):
    random.seed(7)
    pairs = [(float(random.choice([0, 0, 0, 1, 2, 4])), float(random.choice([0, 1, 1, 3, 4])))
             for _ in range(500)]
    df = spark.createDataFrame(pairs, ["label_indexed", "prediction"])
    got = classification_metrics(df).first()
    evaluator = MulticlassClassificationEvaluator(
        labelCol="label_indexed", predictionCol="prediction"
    )
    for name in ("accuracy", "weightedRecall", "weightedPrecision", "f1"):
        expected = evaluator.setMetricName(name).evaluate(df)
        assert abs(got[name] - expected) < 1e-9, name


def test_row_numbers(spark):
    keys = [7, 3, 1_000_003, 12, -5, 999, 1000, 2**60 + 1, 2**60]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(4)
    got = {r.k: r.row_number for r in number_rows(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys), 1)}


def test_row_numbers_of_many(spark):
    df = spark.range(0, 30_000, 3).repartition(8)
    wrong = number_rows(df, "id").filter(F.col("row_number") != F.col("id") / 3 + 1)
    assert wrong.count() == 0


def test_rows_without_a_key_are_numbered_last(spark):
    df = spark.createDataFrame([(5,), (None,), (2,), (None,)], "k bigint")
    got = sorted((r.row_number, r.k) for r in number_rows(df, "k").collect())
    assert got == [(1, 2), (2, 5), (3, None), (4, None)]
