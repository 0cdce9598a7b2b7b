import math

import pytest
from pyspark.sql import functions as F

from flowspark.functions.hashing import digest_below, key_digest
from flowspark.functions.labels import canonical_label, decode_prediction
from flowspark.functions.messages import from_message, is_json_object, to_message
from flowspark.functions.numeric import value_kind
from flowspark.operators.cleaning import cast_and_clean, cast_features, fill_missing
from flowspark.schema import LITERAL_DECODE_LABELS


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


CAST = {
    "1.5": 1.5,
    " 7 ": 7.0,
    "1e3": 1000.0,
    "1d": 1.0,
    "-2": -2.0,
    "abc": 0.0,
    "": 0.0,
    None: 0.0,
    "NaN": 0.0,
    "nan": 0.0,
    "Infinity": 0.0,
    "-Infinity": 0.0,
    "inf": 0.0,
    "-inf": 0.0,
    "+Inf": 0.0,
    "INFINITY": 0.0,
    "1,000": 0.0,
    "0x10": 0.0,
}


def test_cast_and_clean(spark):
    df = texts(spark, CAST)
    assert column(cast_and_clean(df, ["x"], passthrough=["i"]), "x") == list(CAST.values())


def test_cast_and_clean_of_numbers(spark):
    values = [1.5, None, math.nan, math.inf, -math.inf]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    assert column(cast_and_clean(df, ["x"], passthrough=["i"]), "x") == [1.5, 0, 0, 0, 0]


def test_fill_missing_keeps_infinity(spark):
    df = cast_features(texts(spark, ["NaN", None, "Infinity", "abc", "2"]), ["x"], keep=["i"])
    assert column(fill_missing(df), "x") == [0.0, 0.0, math.inf, 0.0, 2.0]


def test_value_kind(spark):
    df = texts(spark, [None, "", "abc", "NaN", "Infinity", "-inf", "3"])
    assert column(df.withColumn("k", value_kind(F.col("x"))), "k") == [
        "null", "unparsable", "unparsable", "nan", "+inf", "-inf", "valid",
    ]


LABELS = {
    None: "BENIGN",
    "Infiltration": "BENIGN",
    "web attack": "BENIGN",
    "BruteForce": "BENIGN",
    " BENIGN": "BENIGN",
    "BENIGN": "BENIGN",
    "DDoS": "DDoS",
    "DoS Hulk": "DoS",
    "DoS slowloris": "DoS",
    "PortScan": "PortScan",
    "Heartbleed": "Heartbleed",
    "Web Attack - Brute Force": "WebAttack",
    "Web Attack - XSS": "WebAttack",
    "SQL Injection": "WebAttack",
    "Brute Force": "WebAttack",
    "FTP-Patator": "BruteForce",
    "SSH-Patator": "BruteForce",
    "Bot": "BotNet",
}


def test_canonical_label(spark):
    df = texts(spark, LABELS)
    got = column(df.withColumn("c", canonical_label(F.col("x"))), "c")
    assert got == list(LABELS.values())


def test_canonical_label_with_other_default(spark):
    df = texts(spark, [None, "Infiltration", "BENIGN", "Bot"])
    got = column(df.withColumn("c", canonical_label(F.col("x"), default="Other")), "c")
    assert got == ["Other", "Other", "BENIGN", "BotNet"]


def decoded(value, labels):
    """The decoding rule in plain Python."""
    try:
        index = int(value)
    except (TypeError, ValueError, OverflowError):
        return "Unknown"
    return labels[index] if 0 <= index < len(labels) else "Unknown"


@pytest.mark.parametrize("labels", [LITERAL_DECODE_LABELS, ["only"]])
def test_decode_prediction(spark, labels):
    values = [None, math.nan, math.inf, -math.inf, -1.0, -0.5, -0.0, 0.0, 0.9, 1.0,
              float(len(labels) - 1), float(len(labels)), 1e20]
    df = spark.createDataFrame(list(enumerate(values)), "i int, p double")
    got = column(df.withColumn("c", decode_prediction(F.col("p"), labels)), "c")
    assert got == [decoded(v, labels) for v in values]


def test_json_object_test(spark):
    df = texts(spark, ['{"A":"1"}', "{}", "{bad", "", "[1]", "3", None])
    got = column(df.withColumn("ok", is_json_object(F.col("x"))), "ok")
    assert got == [True, True, False, False, False, False, False]


def test_from_message(spark):
    df = texts(spark, ['{"A":"1","A":"2"}', "{bad", "", '{"A":{"z":1},"B":"x"}', '[{"A":"9"}]',
                       None])
    parsed = df.withColumn("d", from_message(F.col("x"), ["A", "B"])).select("i", "d.*")
    got = [(r.A, r.B) for r in parsed.orderBy("i").collect()]
    assert got == [("2", None), (None, None), (None, None), ('{"z":1}', "x"), (None, None),
                   (None, None)]


def test_message_round_trip(spark):
    names = ["Flow Bytes/s", "A", "B "]
    df = spark.createDataFrame([(1, 'q"u,oé', None, 2.5)], ["i", *names][:1] + names
                               if False else "i int, `Flow Bytes/s` string, A string, `B ` double")
    message = df.select("i", to_message(names).alias("m"))
    assert column(message, "m") == ['{"Flow Bytes/s":"q\\"u,oé","A":null,"B":"2.5"}']
    back = message.select("i", from_message(F.col("m"), ["Flow Bytes/s", "A", "B"]).alias("d"))
    row = back.select("d.*").first()
    assert tuple(row) == ('q"u,oé', None, "2.5")


def test_digest_threshold_is_numeric(spark):
    df = spark.range(5000)
    digest = key_digest(F.col("id"), 42)
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    for fraction in (0.0, 0.1, 0.8, 1.0):
        below = digest_below(digest, fraction)
        assert df.filter(below != (number < math.floor(fraction * 2**32))).count() == 0


def test_digest_of_null_key_fails(spark):
    """Rows that share a missing key would be kept or lost together."""
    df = spark.createDataFrame([(None,)], "k string")
    with pytest.raises(Exception, match="no key"):
        df.select(digest_below(key_digest(F.col("k"), 1), 0.5).alias("b")).first()
