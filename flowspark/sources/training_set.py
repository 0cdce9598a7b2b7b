"""The Parquet training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_training_set(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
