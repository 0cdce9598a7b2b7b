import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from flowspark.functions.messages import from_message
from flowspark.plans.replay import replay_csv
from flowspark.plans.training_set import build_training_set, training_set
from flowspark.schema import FEATURES, LABEL, flow_schema, string_schema
from flowspark.sources.flow_csv import CORRUPT, read_flows, with_line_status
from flowspark.sources.messages import kafka_options, read_folder, stream_kafka
from flowspark.sources.training_set import read_training_set
from flowspark.operators.cleaning import cast_and_clean


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def flow_line(start, label):
    return ",".join([*(str(start + i) for i in range(len(FEATURES))), label])


RAW_HEADER = ",".join(
    " Fwd Header Length" if "Fwd Header Length" in n else f" {n}" for n in [*FEATURES, LABEL]
)


@pytest.fixture
def raw_files(tmp_path):
    return [
        write(tmp_path / "mon.csv", RAW_HEADER, *(flow_line(i, "BENIGN") for i in range(200))),
        write(tmp_path / "tue.csv", RAW_HEADER, flow_line(1000, "Bot"),
              flow_line(1001, "Heartbleed"), flow_line(1002, "Web Attack - XSS")),
    ]


def test_inferred_headers_get_positions(spark, tmp_path):
    path = write(tmp_path / "h.csv", " A, B,C, B, Label", "1,2,3,4,x")
    assert read_flows(spark, path, infer=True).columns == [" A", " B1", "C", " B3", " Label"]


def test_duplicate_headers_need_no_inference(spark, raw_files):
    df = read_flows(spark, raw_files, file_column="file")
    assert df.columns == [*FEATURES, LABEL, "file"]
    row = df.filter(F.col(LABEL) == "Bot").first()
    assert (row["Fwd Header Length34"], row["Fwd Header Length55"]) == ("1034", "1055")
    counts = {r.file.rsplit("/", 1)[1]: r["count"] for r in df.groupBy("file").count().collect()}
    assert counts == {"mon.csv": 200, "tue.csv": 3}


def test_columns_by_name(spark, raw_files, tmp_path):
    """Other layouts in one run: suffixed names, another order, more columns in front."""
    clean = write(tmp_path / "clean.csv", ",".join([*FEATURES, LABEL]), flow_line(1, "Bot"))
    fields = flow_line(2, "Bot").split(",")
    order = [len(FEATURES), *range(len(FEATURES))]
    first = write(tmp_path / "first.csv", ",".join([LABEL, *FEATURES]),
                  ",".join(fields[i] for i in order))
    raw_names = [n.strip() for n in RAW_HEADER.split(",")]
    more = write(tmp_path / "more.csv", ",".join(["Flow ID", "Source IP", *raw_names]),
                 "f,1.2.3.4," + flow_line(3, "Bot"))
    df = read_flows(spark, [*raw_files, clean, first, more], file_column="file")
    assert df.columns == [*FEATURES, LABEL, "file"] and df.count() == 206
    bots = {r.file.rsplit("/", 1)[1]: r for r in df.filter(F.col(LABEL) == "Bot").collect()}
    for name, start in (("tue", 1000), ("clean", 1), ("first", 2), ("more", 3)):
        row = bots[f"{name}.csv"]
        assert [row[f] for f in FEATURES] == flow_line(start, "Bot").split(",")[:-1]


def test_one_layout_is_one_scan(spark, raw_files):
    assert read_flows(spark, raw_files)._jdf.queryExecution().toString().count("FileScan csv") == 1


def test_missing_columns_fail(spark, raw_files, tmp_path):
    bare = write(tmp_path / "bare.csv", flow_line(2, "Bot"))
    with pytest.raises(ValueError, match="no column .*bare.csv"):
        read_flows(spark, [*raw_files, bare])
    assert read_flows(spark, bare, header=False).count() == 1
    short = write(tmp_path / "short.csv", ",".join(FEATURES), flow_line(1, "Bot"))
    with pytest.raises(ValueError, match="no column Label in .*short.csv"):
        build_training_set(spark, [short], str(tmp_path / "bad"), features=FEATURES)


def test_numeric_schema_cleans_to_the_same(spark, tmp_path):
    path = write(tmp_path / "n.csv", "a,b,Label", '1.5, 7 ,x', 'abc,NaN,x', ',Infinity,',
                 '"",-inf,x', "1e3,0x10,x", "+Inf,1d,x")
    frames = [
        cast_and_clean(read_flows(spark, path, schema=flow_schema(["a", "b"], numeric=n)),
                       ["a", "b"], keep_label=True)
        for n in (False, True)
    ]
    text, numeric = [sorted(map(str, f.collect())) for f in frames]
    assert text == numeric


def test_bad_lines(spark, tmp_path):
    path = write(tmp_path / "b.csv", "a,b", "1,2", "3", "4,5,6", "x,7", '"p,q",8', '1,2,"r,s"')
    numeric = flow_schema(["a", "b"], label=None, numeric=True)
    df = with_line_status(read_flows(spark, path, schema=numeric, strict=True), 2).cache()
    got = {r[CORRUPT]: r.status for r in df.collect()}
    assert got == {None: "good", "3": "short", "4,5,6": "long", "x,7": "unparsable",
                   '"p,q",8': "unparsable", '1,2,"r,s"': "long"}


def test_build_training_set(spark, raw_files, tmp_path):
    output = str(tmp_path / "set")
    for by_label in (False, True):
        counts = build_training_set(spark, raw_files, output, by_label=by_label, features=FEATURES)
        sizes = {r[LABEL]: r["count"] for r in counts.collect()}
        assert sizes["BotNet"] == sizes["WebAttack"] == 1
        assert "Heartbleed" not in sizes
        assert 0 < sizes["BENIGN"] < 60
    one = read_training_set(spark, output).filter(F.col(LABEL) == "BotNet")
    assert one.drop(LABEL).first().asDict()["Idle Min"] == 1077.0
    assert "PartitionFilters: [isnotnull(Label" in one._jdf.queryExecution().toString()


def test_unreadable_file_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_flows(spark, str(tmp_path / "missing.csv")).count()


def messages_of(spark, folder, names):
    df = read_folder(spark, folder)
    return df.select(
        F.col("key").cast("string").cast("bigint").alias("key"),
        from_message(F.col("value").cast("string"), names).alias("d"),
    ).select("key", "d.*")


def test_replay(spark, tmp_path):
    names = ["a", "b", "Label"]
    path = write(tmp_path / "r.csv", "a,b,Label", "1,2,x", "3", "4,5,6,7", '"p,q",,y')
    folder = str(tmp_path / "topic")
    totals = replay_csv(spark, path, path=folder, names=names)
    assert (totals.sent, totals.dropped) == (3, 1)
    got = {tuple(r)[1:] for r in messages_of(spark, folder, names).collect()}
    assert got == {("1", "2", "x"), ("3", None, None), ("p,q", None, "y")}


def test_replay_names_match_the_batch_scan(spark, raw_files, tmp_path):
    folder = str(tmp_path / "topic")
    assert replay_csv(spark, raw_files[1], path=folder).sent == 3
    row = messages_of(spark, folder, FEATURES).orderBy("key").first()
    assert (row["Fwd Header Length34"], row["Fwd Header Length55"]) == ("1034", "1055")


def test_dense_replay_keys_follow_the_file(spark, tmp_path):
    path = write(tmp_path / "d.csv", "a", *map(str, range(1, 2001)))
    folder = str(tmp_path / "topic")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        replay_csv(spark, path, path=folder, names=["a"], dense_keys=True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = messages_of(spark, folder, ["a"])
    assert got.count() == 2000
    assert got.filter(F.col("key") != F.col("a").cast("bigint")).count() == 0


def test_kafka_options():
    options = kafka_options("h:9092", "t", max_offsets_per_trigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }
    earliest = kafka_options("h", "t", "earliest", extra={"kafka.group.id": "g"})
    assert earliest["startingOffsets"] == "earliest" and earliest["kafka.group.id"] == "g"


def test_kafka_without_connector_says_so(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        stream_kafka(spark, "localhost:1", "t")


def test_training_set_without_key(spark):
    schema = string_schema(["p", LABEL])
    df = spark.createDataFrame([("1", "Bot"), ("x", "Heartbleed")], schema)
    assert training_set(df).collect() == [(1.0, "BotNet")]


def test_keyed_set_does_not_follow_the_scan(spark, tmp_path):
    lines = [f"{i},{flow_line(i, 'BENIGN')}" for i in range(3000)]
    path = write(tmp_path / "keyed.csv", ",".join(["Flow ID", *FEATURES, LABEL]), *lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    drawn = []
    try:
        for size in ("128m", "64k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            output = str(tmp_path / f"set-{size}")
            build_training_set(spark, path, output, features=FEATURES, key="Flow ID")
            drawn.append({r[0] for r in read_training_set(spark, output).select("Flow ID").collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert drawn[0] == drawn[1] and 200 < len(drawn[0]) < 400
