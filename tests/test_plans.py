"""What Catalyst makes of the operators."""

import re

import pytest
from pyspark.sql import functions as F

from flowspark.catalog.queries import QUERIES
from flowspark.fixtures import FLOW_FEATURES, flows
from flowspark.operators.cleaning import cast_and_clean, cast_features, map_labels
from flowspark.operators.classifier import fit_forest, score
from flowspark.operators.filters import alerts, exclude_class
from flowspark.operators.numbering import number_rows
from flowspark.operators.profile import (
    attack_summary,
    attacks_per_window,
    invalid_value_profile,
    preview,
)
from flowspark.operators.sampling import hash_sample, stratified_sample
from flowspark.plans.detection import detect_with_model
from flowspark.plans.training_set import training_set
from flowspark.schema import FEATURES, LABEL, flow_schema
from flowspark.session import HUGE_METHOD_LIMIT, JIT_LIMIT, tune
from flowspark.sinks.messages import replay_messages
from flowspark.sources.flow_csv import read_flows
from flowspark.streaming.parsing import parse_messages

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def wide_csv(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text(",".join([*FEATURES, LABEL]) + "\n" + ",".join("1" * 78) + ",Bot\n")
    return str(path)


def test_training_set_is_one_scan_without_shuffle(spark, wide_csv):
    text = plan(training_set(read_flows(spark, wide_csv), FEATURES, key=None))
    assert text.count("FileScan") == 1
    assert "Exchange" not in text and "Union" not in text


def test_keyed_sample_comes_before_the_casts(spark):
    text = plan(training_set(flows(spark, SF), FLOW_FEATURES, key="flow_id"))
    assert text.index("try_cast") < text.index("md5")  # printed from the top down
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_stratified_sample_is_one_scan(spark):
    text = plan(stratified_sample(exclude_class(map_labels(flows(spark, SF))), key="flow_id"))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_each_value_is_parsed_once(spark):
    text = plan(cast_and_clean(flows(spark, SF), FLOW_FEATURES))
    assert text.count("try_cast(") == len(FLOW_FEATURES)


def test_only_needed_columns_are_read(spark):
    text = plan(hash_sample(flows(spark, SF), 0.1, "flow_id").select("flow_id"))
    assert "ReadSchema: struct<event_id:bigint>" in text
    text = plan(attacks_per_window(map_labels(flows(spark, SF)).select("ts", LABEL)))
    assert "props" not in text


def test_csv_scan_is_pruned_unless_strict(spark, wide_csv):
    text = plan(read_flows(spark, wide_csv).select(LABEL))
    assert "ReadSchema: struct<Label:string>" in text


def test_counts_are_combined_before_the_shuffle(spark):
    df = map_labels(flows(spark, SF)).withColumnRenamed(LABEL, "Predicted_Attack")
    assert "partial_count" in plan(attack_summary(df))


def test_preview_is_a_top_n(spark):
    assert "TakeOrderedAndProject" in plan(preview(flows(spark, SF), "flow_id", 5))


def test_detection_parses_each_message_once(spark):
    rows = flows(spark, SF)
    clean = map_labels(cast_and_clean(rows, FLOW_FEATURES, keep_label=True))
    model = fit_forest(clean, FLOW_FEATURES, num_trees=2)
    messages = replay_messages(rows, "flow_id", FLOW_FEATURES)
    text = plan(detect_with_model(messages, model, FLOW_FEATURES))
    assert text.count("from_json") == 1 and "atleastnnonnulls" not in text
    assert text.count("try_cast(") == len(FLOW_FEATURES) + 1  # and the prediction's index
    assert "probability" not in text
    assert model.stages[1].getHandleInvalid() == "skip"
    skipping = plan(score(model, clean))
    assert "atleastnnonnulls" in skipping
    # a filter after parsing does not carry the parser along
    filtered = parse_messages(messages, FLOW_FEATURES).filter("`Flow Duration` > '1'")
    assert plan(filtered).count("from_json") == 1


def test_no_python_in_any_plan(spark):
    for name, query in QUERIES.items():
        if name.startswith(("stream_", "train_", "model_", "score_")):
            continue
        text = plan(query(spark, SF))
        assert not re.search("PythonUDF|EvalPython|MapInPandas|BatchEval", text), name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_tune_respects_the_user(spark):
    before = spark.conf.get(HUGE_METHOD_LIMIT)
    try:
        spark.conf.set(HUGE_METHOD_LIMIT, "65535")
        assert tune(spark).conf.get(HUGE_METHOD_LIMIT) == JIT_LIMIT
        spark.conf.set(HUGE_METHOD_LIMIT, "12345")
        assert tune(spark).conf.get(HUGE_METHOD_LIMIT) == "12345"
    finally:
        spark.conf.set(HUGE_METHOD_LIMIT, before)


def test_numeric_schema():
    fields = flow_schema(numeric=True)
    assert len(fields) == 79 and fields["Idle Min"].dataType.simpleString() == "double"
    assert fields[LABEL].dataType.simpleString() == "string"


def test_forest_runs_once_under_filters(spark):
    train = cast_and_clean(map_labels(flows(spark, SF)), FLOW_FEATURES, keep_label=True)
    model = fit_forest(train, FLOW_FEATURES, LABEL, num_trees=2, max_depth=2)
    cast = cast_features(flows(spark, SF), FLOW_FEATURES, keep=["flow_id"])
    for skip in (True, False):
        scored = score(model, cast, skip_invalid=skip)
        plain, filtered = plan(scored), plan(alerts(scored))
        assert filtered.count("UDF(") == plain.count("UDF(")
        assert filtered.count("as double)") == plain.count("as double)")


def test_numbers_are_made_once_for_their_kind(spark):
    text = plan(invalid_value_profile(flows(spark, SF), FLOW_FEATURES))
    assert text.count("try_cast") == 1


def test_numbering_is_no_single_task(spark):
    df = spark.range(0, 10**12, 10**7).select((F.col("id") * 7919 % 10**12).alias("k"))
    text = plan(number_rows(df, "k"))
    # Only the counts of the ranges meet in one task, not the rows.
    assert text.count("SinglePartition") == 1
    assert "HashAggregate" in text[text.index("SinglePartition") :].split("\n", 2)[1]
