"""Counts and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions.numeric import kind_of
from flowspark.schema import DEFAULT_CLASS, LABEL, PREDICTED, quoted


def row_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*[F.col(quoted(c)) for c in by]).agg(F.count(F.lit(1)).alias("count"))


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per label, rarest first; the label breaks ties."""
    return row_counts(df, [label]).orderBy("count", label)


def distinct_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.select(F.col(quoted(label))).distinct()


def attack_summary(df: DataFrame, predicted: str = PREDICTED) -> DataFrame:
    """Rows per predicted class, most frequent first."""
    return row_counts(df, [predicted]).orderBy(F.desc("count"), predicted)


def top_k(df: DataFrame, k: int, predicted: str = PREDICTED) -> DataFrame:
    return attack_summary(df, predicted).limit(k)


def confusion_counts(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    return row_counts(df, [label, prediction]).orderBy(label, prediction)


def attacks_per_window(
    df: DataFrame, time: str = "ts", label: str = LABEL, width: str = "1 minute"
) -> DataFrame:
    """Rows per tumbling window and class, on a batch or on a stream with a watermark.

    Counts are combined before the shuffle, so one busy minute or class does not
    become one busy task.
    """
    counted = df.groupBy(F.window(F.col(quoted(time)), width), F.col(quoted(label))).agg(
        F.count(F.lit(1)).alias("count")
    )
    return counted.select(F.col("window.start").alias("window_start"), quoted(label), "count")


def preview(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """First ``n`` rows by key; the same rows on every run."""
    return df.orderBy(F.col(quoted(key))).limit(n)


def distinct_per_column(
    df: DataFrame, columns: Sequence[str], exact: bool = True, rsd: float = 0.02
) -> DataFrame:
    """Number of different non-NULL values of each column, as one row per column.

    The exact form shuffles each column's distinct values; the estimate is one pass
    with fixed-size sketches and the choice for wide or high-cardinality tables.
    """
    long = df.unpivot([], [F.col(quoted(c)).cast("string").alias(c) for c in columns],
                      "column", "value")
    if exact:
        counted = F.count_distinct("value")
    else:
        counted = F.approx_count_distinct("value", rsd)
    return long.groupBy("column").agg(counted.alias("distinct_values"))


def invalid_value_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows per column and kind of value (null, unparsable, nan, +inf, -inf, valid).

    Reads text columns, before cleaning. Rows are unfolded to (column, value) and
    counted at once in the same stage, so only six counts per column and task are
    shuffled.
    """
    long = df.unpivot([], [F.col(quoted(c)).alias(c) for c in features], "column", "value")
    # A projection of its own makes the number once for the tests on it.
    parsed = long.withColumn("number", F.col("value").try_cast("double"))
    return (
        parsed.groupBy("column", kind_of(F.col("value"), F.col("number")).alias("kind"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def profile_by_file(df: DataFrame, file: str, label: str = LABEL) -> DataFrame:
    """Label distribution of each file with the file's totals, from one scan.

    The window runs over the counted rows, one per file and label.
    """
    per_file = Window.partitionBy(file)
    benign = F.coalesce(F.col(label) == DEFAULT_CLASS, F.lit(True))
    return row_counts(df, [file, label]).select(
        file,
        label,
        "count",
        F.sum("count").over(per_file).alias("file_rows"),
        F.count(F.lit(1)).over(per_file).alias("file_labels"),
        F.sum(F.when(~benign, F.col("count")).otherwise(0)).over(per_file).alias(
            "file_non_benign"
        ),
    )
