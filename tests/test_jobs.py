"""The jobs one after the other: files to training set, model, replay, detections, rates."""

import pytest
from pyspark.sql import functions as F

from flowspark.fixtures import events, wide_flows
from flowspark.jobs import attack_rates, build_training_set, detect, probe, profile, replay, train
from flowspark.schema import DASHBOARD_FEATURES, FEATURES, PREDICTED
from flowspark.sinks.messages import send

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    flows = wide_flows(events(spark, SF)).drop("flow_id")
    flows.write.option("header", True).csv(str(folder / "csv"))
    return folder


def test_jobs(spark, work, capsys):
    def at(name):
        return str(work / name)

    profile.main(["--input", at("csv"), "--infer", "--values"])
    printed = capsys.readouterr().out
    assert "Heartbleed" in printed and "unparsable" in printed and "|-- Idle Min:" in printed

    build_training_set.main(["--input", at("csv"), "--output", at("set"), "--fraction", "0.9"])
    rows = spark.read.parquet(at("set"))
    assert rows.columns == [*FEATURES, "Label"]
    assert 0.8 * 1000 < rows.count() < 1000

    train.main(["--input", at("set"), "--model", at("model"), "--trees", "5"])
    assert "weightedPrecision" in capsys.readouterr().out

    replay.main(["--input", at("csv"), "--folder", at("topic")])
    assert "sent 1000, dropped 0" in capsys.readouterr().out

    probe.main(["--folder", at("topic")])
    assert "'messages': 1000, 'valid': 1000" in capsys.readouterr().out

    detect.main(["--folder", at("topic"), "--once", "--model", at("model"),
                 "--checkpoint", at("c1"), "--output", at("detections")])
    found = spark.read.parquet(at("detections"))
    assert found.count() == 1000
    assert found.columns == ["key", "kafka_timestamp", "processing_time", PREDICTED,
                             *DASHBOARD_FEATURES, "detected_on"]
    assert found.select("key").distinct().count() == 1000
    assert found.filter(F.col(PREDICTED) == "Unknown").count() == 0

    # one message a day ahead closes the windows of the others
    later = spark.range(1).select(
        F.lit(b"").alias("key"),
        F.lit(b"{}").alias("value"),
        (F.current_timestamp() + F.expr("INTERVAL 1 DAY")).alias("timestamp"),
    )
    send(later, at("topic"))
    detect.main(["--folder", at("topic"), "--once", "--model", at("model"),
                 "--checkpoint", at("c1"), "--output", at("detections")])
    attack_rates.main(["--detections", at("detections"), "--once",
                       "--output", at("rates"), "--checkpoint", at("c2")])
    rates = spark.read.parquet(at("rates"))
    assert rates.columns == ["window_start", PREDICTED, "count"]
    assert rates.agg(F.sum("count")).first()[0] == 1000
