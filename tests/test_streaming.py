import datetime
from functools import partial

import pytest
from pyspark.sql import functions as F

from flowspark.catalog.inputs import time_slices
from flowspark.fixtures import rule_scorer
from flowspark.functions.messages import to_message
from flowspark.jobs import probe
from flowspark.operators.profile import attack_summary, attacks_per_window
from flowspark.schema import PREDICTED, PROBE_FEATURES
from flowspark.sinks.messages import replay_messages, send
from flowspark.sources.messages import read_folder, stream_folder
from flowspark.streaming import health
from flowspark.streaming.detection import batch_summary, dashboard_writer, detect
from flowspark.streaming.parsing import clean_flows, parse_messages
from flowspark.streaming.running import finish, run_for, wait_for_any, write_parquet, write_table
from flowspark.streaming.windows import attacks_per_window_stream

START = datetime.datetime(2024, 1, 1)
N = 600


def flows(spark, low=0, high=N):
    n = F.col("id")
    return spark.range(low, high).select(
        n.alias("flow_id"),
        (F.lit(START) + F.make_dt_interval(secs=n * 7)).alias("ts"),
        (n % 90).cast("string").alias("Destination Port"),
        (n % 150).cast("string").alias("Flow Duration"),
        F.when(n % 5 == 0, "Infinity").otherwise((n / 4).cast("string")).alias("Flow Bytes/s"),
    )


def messages(df):
    return replay_messages(df, "flow_id", PROBE_FEATURES, time=F.col("ts"))


@pytest.fixture
def topic(spark, tmp_path):
    folder = str(tmp_path / "topic")
    for low in range(0, N, 200):
        send(messages(flows(spark, low, low + 200)).coalesce(1), folder)
    return folder


detections = partial(detect, features=PROBE_FEATURES, scorer=rule_scorer, passthrough=["key"])
VALUES = ["key", "kafka_timestamp", PREDICTED, *PROBE_FEATURES]


def values(df):
    return sorted(tuple(r) for r in df.select(*[f"`{c}`" for c in VALUES]).collect())


def test_stream_equals_batch_and_restarts(spark, topic, tmp_path):
    output, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = detections(stream_folder(spark, topic, max_files_per_trigger=1))
        finish(write_parquet(stream, output, checkpoint, interval=None), 120)
        return spark.read.parquet(output)

    assert values(run()) == values(detections(read_folder(spark, topic)))
    assert values(run()) == values(detections(read_folder(spark, topic)))
    per_batch = batch_summary(spark.read.parquet(output)).groupBy("processing_time").agg(
        F.sum("count").alias("records")
    )
    assert [r.records for r in per_batch.collect()] == [200, 200, 200]

    send(messages(flows(spark, N, N + 50)), topic)
    assert run().count() == N + 50
    assert values(run()) == values(detections(read_folder(spark, topic)))


def test_running_summary(spark, topic, tmp_path):
    stream = attack_summary(detections(stream_folder(spark, topic, 2)))
    finish(write_table(stream, "running_summary", str(tmp_path / "c")), 120)
    assert spark.table("running_summary").collect() == attack_summary(
        detections(read_folder(spark, topic))
    ).collect()


def test_timeout_stops_the_query(spark, topic, tmp_path):
    query = write_parquet(
        detections(stream_folder(spark, topic)), str(tmp_path / "o"), str(tmp_path / "c"),
        interval="1 second",
    )
    with pytest.raises(TimeoutError):
        finish(query, 1)
    assert not query.isActive


def test_wait_for_any_stops_the_others(spark, topic, tmp_path):
    def start(name, interval):
        return write_parquet(
            detections(stream_folder(spark, topic)), str(tmp_path / f"o{name}"),
            str(tmp_path / f"c{name}"), interval,
        )

    endless, ending = start("a", "1 second"), start("b", None)
    wait_for_any([endless, ending])
    assert not endless.isActive and not ending.isActive
    assert spark.read.parquet(str(tmp_path / "ob")).count() == N


def test_damaged_messages(spark):
    texts = ['{"Destination Port":"80"}', "{bad", None, "[1]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key int, value string")
    df = df.withColumn("timestamp", F.current_timestamp())
    clean = clean_flows(df, PROBE_FEATURES, passthrough=["key"]).orderBy("key")
    assert [r["Destination Port"] for r in clean.collect()] == [80.0, 0.0, 0.0, 0.0]
    assert clean.filter(F.col("processing_time").isNull()).count() == 0
    assert clean_flows(df, PROBE_FEATURES, valid_only=True).count() == 1
    assert health.message_health(df).first() == (4, 1, 3)
    report = {r.key: r for r in health.message_format(df, ["key"]).collect()}
    assert report[0].n_fields == 1 and report[0].first_fields == "Destination Port"
    assert report[1].beginning == "{bad" and not report[1].is_valid
    assert report[2].n_fields == 0 and report[2].first_fields is None


def test_beginning_is_cut_at_200(spark):
    df = spark.createDataFrame([("x" * 300,)], "value string")
    df = df.withColumn("timestamp", F.current_timestamp())
    assert len(health.message_format(df).first().beginning) == 200


def test_progress_counts(spark, topic, tmp_path):
    stream = detections(health.observed(stream_folder(spark, topic, max_files_per_trigger=2)))
    query = finish(
        write_parquet(stream, str(tmp_path / "o"), str(tmp_path / "c"), interval=None), 120
    )
    rows = [r for r in health.progress_rows(query) if r["input_rows"]]
    assert [r["input_rows"] for r in rows] == [400, 200]
    assert [(r["messages"], r["valid"]) for r in rows] == [(400, 400), (200, 200)]


def windows(df):
    return sorted(tuple(r) for r in df.collect())


def run_windows(spark, source, output, checkpoint):
    stream = attacks_per_window_stream(detections(stream_folder(spark, source)))
    finish(write_parquet(stream, output, checkpoint, interval=None), 120)
    return spark.read.schema(stream.schema).parquet(output)


def test_windows_equal_batch_once_closed(spark, tmp_path):
    source, output, checkpoint = (str(tmp_path / d) for d in ("t", "o", "c"))
    send(messages(flows(spark, 0, 300)), source)
    run_windows(spark, source, output, checkpoint)
    send(messages(flows(spark, 300, N)), source)
    still_open = run_windows(spark, source, output, checkpoint)
    expected = attacks_per_window(
        detections(read_folder(spark, source)), "kafka_timestamp", PREDICTED
    ).collect()
    assert 0 < still_open.count() < len(expected)
    send(messages(flows(spark, 10**5, 10**5 + 1)), source)
    assert windows(run_windows(spark, source, output, checkpoint)) == sorted(map(tuple, expected))


def test_rows_behind_the_watermark_are_not_counted(spark, tmp_path):
    source, output, checkpoint = (str(tmp_path / d) for d in ("t", "o", "c"))
    for low, high in ((300, 400), (0, 100), (10**5, 10**5 + 1)):
        send(messages(flows(spark, low, high)), source)
        written = run_windows(spark, source, output, checkpoint)
    # minutes 35 to 46 came first; of minutes 0 to 11 none is within ten minutes of them
    assert written.agg(F.sum("count")).first()[0] == 100


def test_time_slices_cover(spark):
    df = flows(spark).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    parts = time_slices(df, "ts", 4)
    found = [{r.flow_id for r in p.collect()} for p in parts]
    assert sum(map(len, found)) == N == len(set.union(*found))
    assert all(max(a) < min(b) for a, b in zip(found, found[1:]))


def test_dashboard_writer_replaces_a_repeated_batch(spark, topic, tmp_path, capsys):
    """Called as foreachBatch would call it; no query is started."""
    path = str(tmp_path / "dash")
    write = dashboard_writer(path, rows=3)
    batch = detections(read_folder(spark, topic))
    write(batch, 0)
    write(batch, 0)
    write(batch.limit(0), 1)
    shown = capsys.readouterr().out
    assert shown.count(f"batch 0: {N} records") == 2 and "batch 1" not in shown
    kept = spark.read.parquet(f"{path}/batch=0")
    assert sorted(map(tuple, kept.select(PREDICTED, "count").collect())) == sorted(
        map(tuple, attack_summary(batch).collect())
    )


def test_parse_keeps_unknown_fields_out(spark):
    df = spark.createDataFrame([(1, "x")], ["a", "b"]).select(
        to_message(["a", "b"]).alias("value"), F.current_timestamp().alias("timestamp")
    )
    assert parse_messages(df, ["a", "c"]).drop("kafka_timestamp").collect() == [("1", None)]


def test_run_for_stops_without_an_error(spark, topic, tmp_path):
    stream = health.observed(stream_folder(spark, topic, max_files_per_trigger=1))
    writer = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
    query = writer.trigger(processingTime="100 milliseconds").start()
    assert run_for(query, 5) is False and not query.isActive
    counts = health.total_counts(query)
    assert counts["messages"] >= counts["valid"]


def test_probe_counts_more_batches_than_reports_are_held(spark, tmp_path, capsys):
    """Twelve batches, the damaged message in the first one, and two reports held."""
    source, held = str(tmp_path / "t"), "spark.sql.streaming.numRecentProgressUpdates"
    for number in range(12):
        text = "{bad" if number == 0 else "{}"
        rows = spark.range(1).select(
            F.lit(b"").alias("key"),
            F.lit(text).cast("binary").alias("value"),
            F.current_timestamp().alias("timestamp"),
        )
        send(rows.coalesce(1), source)
    before = spark.conf.get(held)
    spark.conf.set(held, "2")
    try:
        probe.main(["--folder", source, "--max-per-trigger", "1"])
    finally:
        spark.conf.set(held, before)
    printed = capsys.readouterr().out
    assert "health {'messages': 12, 'valid': 11, 'invalid': 1} all read" in printed
    for name in ("format", "flows"):
        whole = f"{name} {{'messages': 12, 'valid': 11}} all read\n" in printed
        assert whole or f"{name} {{" in printed and "batches whose reports were gone" in printed


def test_missing_reports_are_told():
    assert health.missing_batches({}) == 0
    assert health.missing_batches({0: {}, 1: {}}) == 0
    assert health.missing_batches({3: {}, 4: {}}) == 3


def test_the_number_of_state_stores_is_the_querys_own(spark, tmp_path):
    """What is planned in the session meanwhile keeps the session's number."""
    spark.createDataFrame([(1,), (2,)], "a long").write.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream = spark.readStream.schema("a long").parquet(str(tmp_path / "in"))
    counts = stream.groupBy("a").count()
    started = write_table(counts, "own_stores", str(tmp_path / "ck"), state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    finish(started)
    assert spark.table("own_stores").count() == 2
    assert len(list((tmp_path / "ck" / "state" / "0").glob("[0-9]*"))) == 3
