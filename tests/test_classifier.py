import pytest
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowspark.operators.classifier import (
    feature_assembler,
    feature_importances,
    fit_forest,
    fitted_labels,
    index_labels,
    load_model,
    save_model,
    score,
)
from flowspark.operators.profile import row_counts
from flowspark.plans.training import evaluate, split_sets, train_and_evaluate
from flowspark.schema import LITERAL_DECODE_LABELS


@pytest.fixture(scope="module")
def flows(spark):
    """Three classes that one feature tells apart."""
    n = F.col("id")
    label = F.when(n % 10 < 6, "BENIGN").when(n % 10 < 9, "PortScan").otherwise("Bot")
    return (
        spark.range(3000)
        .select(
            n.alias("flow_id"),
            (n % 10).cast("double").alias("x"),
            (n % 7).cast("double").alias("y z/s"),
            label.alias("Label"),
        )
        .coalesce(2)
        .cache()
    )


FEATURES = ["x", "y z/s"]


@pytest.fixture(scope="module")
def model(flows):
    return fit_forest(flows, FEATURES)


def test_indexer_order(spark):
    df = spark.createDataFrame([(x,) for x in "bacc"], ["Label"])
    got = {r.Label: r.label_indexed for r in index_labels(df).collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_assembler_skips_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),)], "x double")
    assert feature_assembler(["x"]).transform(df).count() == 2


def test_forest_settings(spark, model):
    forest = model.stages[-1]
    assert forest.getNumTrees == 20
    assert forest.getOrDefault("maxDepth") == 5
    assert forest.getOrDefault("seed") == 42
    assert forest.getOrDefault("featureSubsetStrategy") == "sqrt"
    importances = {r.feature: r.importance for r in
                   feature_importances(spark, model, FEATURES).collect()}
    assert importances["x"] > importances["y z/s"]
    assert abs(sum(importances.values()) - 1) < 1e-9


def test_scores(flows, model):
    scored = score(model, flows)
    assert scored.count() == flows.count()
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b)
    assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    assert scored.filter(~F.col("prediction").between(0, 2)).count() == 0
    assert fitted_labels(model) == ["BENIGN", "PortScan", "Bot"]
    assert scored.filter(F.col("Predicted_Attack") != F.col("Label")).count() == 0


def test_literal_names_differ(flows, model):
    named = row_counts(score(model, flows, LITERAL_DECODE_LABELS), ["Label", "Predicted_Attack"])
    got = {(r.Label, r.Predicted_Attack) for r in named.collect()}
    assert got == {("BENIGN", "BENIGN"), ("PortScan", "DoS"), ("Bot", "WebAttack")}


def test_scoring_needs_no_label(flows, model):
    scored = score(model, flows.drop("Label"))
    assert "label_indexed" not in scored.columns
    assert scored.count() == flows.count()


def test_invalid_rows_are_skipped_or_refused(spark, model):
    schema = "flow_id int, x double, `y z/s` double"
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0)], schema)
    assert score(model, df).count() == 1
    with pytest.raises(Exception, match="(?i)null"):
        score(model, df, skip_invalid=False).collect()


def test_round_trip(flows, model, tmp_path):
    path = str(tmp_path / "model")
    for _ in range(2):
        save_model(model, path)
    columns = ["flow_id", "prediction", "probability"]
    before = score(model, flows).select(columns).orderBy("flow_id").collect()
    after = score(load_model(path), flows).select(columns).orderBy("flow_id").collect()
    assert before == after


def test_storage_is_released(spark, flows):
    computed = flows.withColumn("x", F.col("x") + 1)
    again = fit_forest(computed, FEATURES, storage=StorageLevel.MEMORY_AND_DISK, partitions=2)
    assert fitted_labels(again)[0] == "BENIGN"
    assert not computed.select(*map(lambda c: f"`{c}`", [*FEATURES, "Label"])).is_cached


@pytest.mark.parametrize("key", ["flow_id", None])
def test_train_and_evaluate(flows, key, tmp_path):
    df = flows if key else flows.drop("flow_id")
    result = train_and_evaluate(df, key=key, model_path=str(tmp_path / "m"))
    train, scored = split_sets(df, key)
    metrics = result.metrics.first()
    assert metrics.accuracy == metrics.weightedRecall == 1.0
    assert metrics.weightedPrecision == metrics.f1 == 1.0
    confusion = result.confusion.collect()
    assert sum(r["count"] for r in confusion) == scored.count()
    assert [r.Label for r in confusion] == sorted(r.Label for r in confusion)
    assert 0 < scored.count() < train.count()
    result.release()


def persisted(spark):
    return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())


def test_kept_rows_are_given_back(spark, flows):
    """Persisted input of a fit, after success and failure, and the counts of an evaluation."""
    before = persisted(spark)
    keep = StorageLevel.MEMORY_AND_DISK
    model = fit_forest(flows, FEATURES, storage=keep, partitions=3, num_trees=2)
    assert persisted(spark) - before == set()
    with pytest.raises(Exception):
        fit_forest(flows.limit(0), FEATURES, storage=keep, num_trees=2)
    assert persisted(spark) - before == set()
    result = evaluate(model, flows)
    assert result.metrics.count() == 1 and len(persisted(spark) - before) == 1
    confusion = sorted(map(tuple, result.confusion.collect()))
    result.release()
    assert persisted(spark) - before == set()
    assert sorted(map(tuple, result.confusion.collect())) == confusion


def test_repartition_of_the_input(flows):
    """The fit takes any number of partitions and knows the same classes."""
    models = [fit_forest(flows, FEATURES, partitions=n, num_trees=2) for n in (None, 5)]
    assert fitted_labels(models[0]) == fitted_labels(models[1])
    assert all(m.stages[-1].getNumTrees == 2 for m in models)
