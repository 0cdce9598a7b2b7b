"""One JSON object or not, its keys and its fields, by one parse of each message."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowspark.functions.messages import is_json_object
from flowspark.streaming.health import message_format, message_health
from flowspark.streaming.parsing import parse_messages

TEXTS = [
    '{"A": "1"}', ' {"A" : 1, "B": null}\n', "{}", "[]", "[{}]", "3", '"x"', "null", "true", "", " ", None,
    "{bad", '{"A": 1} and more', '{"A": 1}{"A": 2}', '{"A": 1}, {"A": 2}', '{"A": 1}] [{"A": 1}', "{'A': 1}",
    "{A: 1}", '{"A": 1,}', '{"A": NaN}', '{"A": Infinity}', '{"A": 01}', '{"B": {"A": [1, {"C": 2}]}, "A": "x"}',
    '{"A": 1, "A": 2}', '{"A": "\\u0041\\n"}', '{"A": "un\nescaped"}', '{"A": 1}//x', "//x\n{}", '{"é漢": "😀"}',
    '{"A": 1}]', '[{"A": 1}', '{"\\u0002seal": "5"}', '{"A": "1"}, {"\\u0002seal": "5"}', "\x00", '{"A": "\\q"}',
    "{" * 300, '{"A":' * 300 + "1" + "}" * 300,
]


def strict(text):
    """The object of a text by a parser that refuses NaN, or None."""

    def refuse(name):
        raise ValueError(name)

    try:
        value = json.loads(text, parse_constant=refuse)
    except (TypeError, ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def frame(spark, texts):
    rows = [(i, None if t is None else bytearray(t.encode())) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i long, value binary")
    return df.withColumn("timestamp", F.current_timestamp())


def test_validity_and_keys(spark):
    got = message_format(frame(spark, TEXTS), passthrough=["i"]).orderBy("i").collect()
    for text, row in zip(TEXTS, got):
        found = strict(text)
        assert row.is_valid == (found is not None), text
        assert row.n_fields == len(found or {}), text
        assert row.first_fields == (None if found is None else ",".join(list(found)[:5])), text
    health = message_health(frame(spark, TEXTS)).first()
    assert health.valid == sum(strict(t) is not None for t in TEXTS)


def test_fields_of_valid_messages(spark):
    parsed = parse_messages(frame(spark, TEXTS), ["A", "B"], passthrough=["i"], valid_only=True)
    assert parsed.columns == ["i", "kafka_timestamp", "A", "B"]
    got = {r.i: r for r in parsed.collect()}
    assert set(got) == {i for i, t in enumerate(TEXTS) if strict(t) is not None}
    plain = {r.i: r for r in parse_messages(frame(spark, TEXTS), ["A", "B"], ["i"]).collect()}
    for i, row in got.items():
        assert (row.A, row.B) == (plain[i].A, plain[i].B)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from('{}[]:," ') | st.sampled_from(['"a"', "1", "null", '{"a":1}', ","])
                         ).map("".join), min_size=20, max_size=60))
def test_any_text(spark, texts):
    df = frame(spark, texts).select("i", is_json_object(F.col("value").cast("string")).alias("ok"))
    assert [r.ok for r in df.orderBy("i").collect()] == [strict(t) is not None for t in texts]


def parsers(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.count("from_json(") + text.count("json_object_keys(") + text.count("parse_json(")


def test_one_parser(spark, tmp_path):
    frame(spark, TEXTS).write.parquet(str(tmp_path / "topic"))
    topic = spark.read.parquet(str(tmp_path / "topic"))
    assert parsers(message_format(topic, passthrough=["i"])) == 1
    assert parsers(message_format(topic).filter("is_valid and n_fields > 3")) == 1
    assert parsers(message_health(topic)) == 1
    valid = parse_messages(topic, ["A", "B"], valid_only=True)
    assert parsers(valid) == 1
    assert parsers(valid.filter("A > '1' and B is not null").select("B", "A")) == 1
