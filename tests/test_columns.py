from flowspark.operators.cleaning import (
    map_labels,
    preprocess_for_inference,
    preprocess_for_training,
)
from flowspark.operators.columns import (
    dashboard_projection,
    feature_columns,
    normalize_columns,
    rename_strip,
)
from flowspark.operators.sets import union_all


def test_first_of_equal_names_wins(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a ", " a", "b"])
    assert normalize_columns(df).collect() == [(1, 3)]
    assert normalize_columns(df).columns == ["a", "b"]


def test_truly_equal_and_case_differing_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["x", "y", "z"]).toDF("a", "a", "A")
    assert normalize_columns(df).columns == ["a", "A"]
    assert normalize_columns(df).collect() == [(1, 3)]


def test_odd_names(spark):
    df = spark.createDataFrame([("1", "2", "3")], [" Flow Bytes/s", "a.b ", "c`d"])
    clean = preprocess_for_inference(df)
    assert clean.columns == ["Flow Bytes/s", "a.b", "c`d"]
    assert clean.collect() == [(1.0, 2.0, 3.0)]


def test_rename_strip_keeps_all(spark):
    df = spark.createDataFrame([(1, 2)], [" a", "b "])
    assert rename_strip(df).columns == ["a", "b"]


def test_training_keeps_label_and_inference_drops_the_rest(spark):
    df = spark.createDataFrame([("5", "x", "Bot", "k")], ["p", "q", " Label", "key"])
    assert feature_columns(rename_strip(df)) == ["p", "q", "key"]
    trained = preprocess_for_training(df, ["p"], passthrough=["key"])
    assert trained.columns == ["key", "p", "Label"]
    assert trained.collect() == [("k", 5.0, "BotNet")]
    assert preprocess_for_inference(df, ["p"]).columns == ["p"]
    assert preprocess_for_inference(df).columns == ["p", "q", "key"]


def test_null_labels_can_be_dropped(spark):
    df = spark.createDataFrame([("1", None), ("2", "Bot")], "p string, Label string")
    assert preprocess_for_training(df).count() == 2
    assert preprocess_for_training(df, drop_null_labels=True).collect() == [(2.0, "BotNet")]


def test_map_labels_without_label(spark):
    df = spark.createDataFrame([(1,)], ["a"])
    assert map_labels(df) is df


def test_dashboard_takes_what_is_there(spark):
    df = spark.createDataFrame([(1.0, "x", 2.0)], ["Flow Duration", "Predicted_Attack", "other"])
    assert dashboard_projection(df).columns == ["Predicted_Attack", "Flow Duration"]


def test_union_keeps_duplicates_and_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], ["n", "s"])
    b = spark.createDataFrame([("x", 1)], ["s", "n"])
    assert union_all([a, b, a]).collect() == [(1, "x")] * 3
