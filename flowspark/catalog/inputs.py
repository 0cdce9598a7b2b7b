"""Inputs several queries share: written copies of the flows and the fitted model.

Each is made once per application and data folder.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.fixtures import (
    FEEDS,
    FLOW_FEATURES,
    TEXT_COLUMNS,
    events,
    flows,
    mixed_messages,
    wide_flows,
)
from flowspark.operators.classifier import fit_forest
from flowspark.operators.sampling import hash_split
from flowspark.plans.training_set import training_set
from flowspark.schema import FEATURES, LABEL, quoted, string_schema
from flowspark.scratch import new_folder
from flowspark.sinks.messages import replay_messages, send
from flowspark.sinks.training_set import write_training_set
from flowspark.sources.flow_csv import read_flows
from flowspark.sources.training_set import read_training_set

_made: dict[tuple[str, str, str], Any] = {}

CSV_COLUMNS = ["flow_id", *TEXT_COLUMNS]


#: Files of a micro-batch, as a job would limit its intake.
FILES_PER_TRIGGER = 8


def shared(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], Any]) -> Any:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def spread(df: DataFrame) -> DataFrame:
    """The rows in as many pieces as the session has cores, whatever the input's layout."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def feed_paths(spark: SparkSession, sf_dir: str) -> list[str]:
    """The flows as CSV, in one folder per feed."""

    def make():
        folder = new_folder(spark, "feeds")
        (
            spread(flows(spark, sf_dir))
            .withColumn("feed", F.col("flow_id") % FEEDS)
            .select("feed", *CSV_COLUMNS)
            .write.mode("overwrite")
            .partitionBy("feed")
            .option("header", True)
            .csv(folder)
        )
        return [f"{folder}/feed={i}" for i in range(FEEDS)]

    return shared(spark, sf_dir, "feeds", make)


def other_layout(spark: SparkSession, sf_dir: str, names: list[str]) -> list[str]:
    """The flows as CSV: odd ids in files with these columns, even ids in the usual ones."""

    def make():
        folder = new_folder(spark, "layouts")
        rows = flows(spark, sf_dir).select(*map(quoted, CSV_COLUMNS))
        for part, columns in enumerate((CSV_COLUMNS, names)):
            known = [F.col(quoted(n)) if n in CSV_COLUMNS else F.lit("x").alias(n) for n in columns]
            own = rows.filter(F.col("flow_id") % 2 == part).select(*known)
            own.write.option("header", True).csv(f"{folder}/{part}")
        return [f"{folder}/0", f"{folder}/1"]

    return shared(spark, sf_dir, f"layout-{','.join(names)}", make)


def feed_scan(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """One scan over all feeds; ``feed`` tells them apart."""
    df = read_flows(
        spark,
        feed_paths(spark, sf_dir),
        schema=string_schema(CSV_COLUMNS),
        file_column="feed",
        **options,
    )
    return df.withColumns(
        {
            "flow_id": F.col("flow_id").cast("bigint"),
            "feed": F.regexp_extract("feed", "feed=([0-9]+)", 1).cast("bigint"),
        }
    )


def wide_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 78 features as text, at rest."""

    def make():
        folder = new_folder(spark, "wide")
        wide_flows(spread(events(spark, sf_dir))).write.mode("overwrite").parquet(folder)
        return folder

    return spark.read.parquet(shared(spark, sf_dir, "wide", make))


def damaged_csv(spark: SparkSession, sf_dir: str) -> str:
    """The flows as CSV lines; some have lost fields and some have gained one."""

    def make():
        folder = new_folder(spark, "damaged")
        n = F.col("flow_id")
        fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in CSV_COLUMNS]
        whole = F.concat_ws(",", *fields)
        line = (
            F.when(n % 50 == 7, F.concat_ws(",", *fields[:3]))
            .when(n % 50 == 11, F.concat(whole, F.lit(",more")))
            .when(n % 50 == 13, F.concat(whole, F.lit(',"a,b"')))
            .otherwise(whole)
        )
        flows(spark, sf_dir).select(line.alias("value")).write.mode("overwrite").text(folder)
        return folder

    return shared(spark, sf_dir, "damaged", make)


def training_parquet(spark: SparkSession, sf_dir: str, wide: bool = False) -> str:
    """The sampled, cleaned flows, written as the training job writes them."""

    def make():
        folder = new_folder(spark, "training")
        if wide:
            built = training_set(wide_parquet(spark, sf_dir), FEATURES, key="flow_id")
        else:
            built = training_set(flows(spark, sf_dir), FLOW_FEATURES, key="flow_id")
        write_training_set(built, folder)
        return folder

    return shared(spark, sf_dir, "training-wide" if wide else "training", make)


def split_training_set(
    spark: SparkSession, sf_dir: str, wide: bool = False
) -> tuple[DataFrame, DataFrame]:
    df = read_training_set(spark, training_parquet(spark, sf_dir, wide))
    train, test = hash_split(df, [0.8, 0.2], "flow_id")
    return train, test


def forest(spark: SparkSession, sf_dir: str, wide: bool = False) -> PipelineModel:
    """The model, fitted on the training part."""

    def make():
        train, _ = split_training_set(spark, sf_dir, wide)
        return fit_forest(train, FEATURES if wide else FLOW_FEATURES, LABEL)

    return shared(spark, sf_dir, "forest-wide" if wide else "forest", make)


def wide_topic(spark: SparkSession, sf_dir: str) -> str:
    """Messages of all 78 features as files."""

    def make():
        folder = new_folder(spark, "topic-wide")
        wide = wide_parquet(spark, sf_dir)
        send(replay_messages(wide, "flow_id", [*FEATURES, LABEL]), folder)
        return folder

    return shared(spark, sf_dir, "topic-wide", make)


def damaged_topic(spark: SparkSession, sf_dir: str) -> str:
    """Messages, some of them no JSON object, as files."""

    def make():
        folder = new_folder(spark, "topic-damaged")
        send(spread(mixed_messages(flows(spark, sf_dir)).drop("flow_id")), folder)
        return folder

    return shared(spark, sf_dir, "topic-damaged", make)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_messages(
        flows(spark, sf_dir), "flow_id", TEXT_COLUMNS, time=F.col("ts"), passthrough=["ts"]
    )


def time_slices(df: DataFrame, column: str, slices: int) -> list[DataFrame]:
    """Consecutive, disjoint ranges of time that together are the input. Rows without a
    time are in the first one."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    step = (high - low) / slices
    bounds = [low + step * i for i in range(1, slices)]
    parts, left = [], F.lit(True)
    for bound in bounds:
        below = F.col(column) < F.lit(bound).cast("timestamp_ntz")
        if not parts:
            below = below | F.col(column).isNull()
        parts.append(df.filter(left & below))
        left = F.col(column) >= F.lit(bound).cast("timestamp_ntz")
    return [*parts, df.filter(left)]


def topic(spark: SparkSession, sf_dir: str, slices: int = 3) -> str:
    """All messages as files, written in order of time."""

    def make():
        folder = new_folder(spark, "topic")
        for part in time_slices(messages(spark, sf_dir), "ts", slices):
            send(spread(part), folder)
        return folder

    return shared(spark, sf_dir, "topic", make)
