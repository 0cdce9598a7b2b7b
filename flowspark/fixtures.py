"""Flow records made from the ``events`` table, for the registered queries and tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.operators.classifier import with_predicted_class
from flowspark.schema import FEATURES, LABEL, PROBE_FEATURES, quoted
from flowspark.sinks.messages import replay_messages

FLOW_FEATURES = PROBE_FEATURES
TEXT_COLUMNS = [*FLOW_FEATURES, LABEL]
FEEDS = 8
RULE_LABELS = ["BENIGN", "WebAttack", "DoS"]


def _by_remainder(number: Column, modulus: int, values: dict[int, str | None], otherwise) -> Column:
    chain = F
    for remainder, value in values.items():
        chain = chain.when(number % modulus == remainder, F.lit(value))
    return chain.otherwise(otherwise)


def _raw_label() -> Column:
    n, kind = F.col("event_id"), F.col("event_type")
    return (
        F.when(kind == "click", "BENIGN")
        .when(
            kind == "view",
            _by_remainder(n, 4, {0: "DoS Hulk", 1: "DDoS", 2: "PortScan"}, "DoS slowloris"),
        )
        .when(
            kind == "error",
            _by_remainder(
                n,
                5,
                {
                    0: "Web Attack - XSS",
                    1: "Web Attack - Sql Injection",
                    2: "Web Attack - Brute Force",
                    3: "FTP-Patator",
                },
                "SSH-Patator",
            ),
        )
        .when(kind == "signup", _by_remainder(n, 3, {0: "Bot", 1: "Infiltration"}, "Heartbleed"))
        .when(kind == "purchase", _by_remainder(n, 2, {0: None}, "BENIGN"))
    )


def _port() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flow_id, ts, three text features and the raw label."""
    rate = _by_remainder(
        _port(),
        20,
        {0: "Infinity", 1: "NaN", 2: "abc", 3: None, 4: ""},
        F.col("value").cast("string"),
    )
    return events(spark, sf_dir).select(
        F.col("event_id").alias("flow_id"),
        "ts",
        _port().cast("string").alias("Destination Port"),
        F.col("user_id").cast("string").alias("Flow Duration"),
        rate.alias("Flow Bytes/s"),
        _raw_label().alias(LABEL),
    )


def spaced_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under untidy headers; ``Destination Port`` comes twice."""
    df = flows(spark, sf_dir)
    return df.select(
        "flow_id",
        F.col("Destination Port").alias(" Destination Port"),
        F.col("Flow Duration").alias("Flow Duration"),
        F.col("Flow Bytes/s").alias("Flow Bytes/s "),
        F.lit("repeated").alias("Destination Port "),
        F.col(LABEL).alias(f" {LABEL}"),
    )


def wide_flows(events: DataFrame) -> DataFrame:
    """flow_id, all 78 features as text and the raw label."""
    base = events.select(
        F.col("event_id").alias("flow_id"), _port().alias("k"), "user_id", _raw_label().alias(LABEL)
    )
    special = "array('Infinity', 'NaN', '', NULL, 'abc', '-Infinity')"
    features = [
        f"IF((flow_id + {i}) % 97 < 6, get({special}, int((flow_id + {i}) % 97)), "
        f"string((k * {i + 1} + user_id) % 1000)) AS {quoted(name)}"
        for i, name in enumerate(FEATURES)
    ]
    return base.selectExpr("flow_id", *features, LABEL)


def with_rule_prediction(df: DataFrame, duration: str = "Flow Duration") -> DataFrame:
    """A prediction that plain SQL can repeat: by flow duration, below 40, below 100, above."""
    value = F.col(quoted(duration)).try_cast("double")
    rule = F.when(value < 40, 0.0).when(value < 100, 1.0).otherwise(2.0)
    return df.withColumn("prediction", rule)


def rule_scorer(df: DataFrame) -> DataFrame:
    """Stands in for a model where a stream's result must be exactly checkable."""
    return with_predicted_class(with_rule_prediction(df), RULE_LABELS)


def mixed_messages(df: DataFrame) -> DataFrame:
    """Messages of the flows, with every 25th of seven kinds damaged."""
    messages = replay_messages(df, "flow_id", TEXT_COLUMNS, time=F.col("ts"),
                               passthrough=["flow_id"])
    damaged = _by_remainder(
        F.col("flow_id"),
        25,
        {
            1: "{bad",
            2: "",
            3: "[1]",
            4: "3",
            5: None,
            6: '{"A": "1"} and more',
            7: '{"A": "1"}{"A": "2"}',
        },
        F.col("value").cast("string"),
    )
    return messages.withColumn("value", damaged.cast("binary"))
