"""Distinct counts that can be kept, merged and asked again: one HyperLogLog sketch a column.

A sketch of ``1 << precision`` registers has a fixed size, whatever it has seen, so profiles of
files, days or clusters are stored beside each other and merged in any grouping later, without
a second look at the data. The exact count of ``profile.distinct_per_column`` shuffles every
different value; here a task sends one sketch for each column and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.schema import quoted

PRECISION = 12


def relative_error(precision: int = PRECISION) -> float:
    """The standard error of a merged sketch's estimate, as a part of the count."""
    return 1.04 / (1 << precision) ** 0.5


def column_sketches(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), precision: int = PRECISION
) -> DataFrame:
    """``by``, column, sketch, values and missing (NULLs), one row per group and column.

    One pass; values are compared as text. A column of NULLs has the empty sketch.
    """
    value = lambda c: F.col(quoted(c)).cast("string")
    parts = [
        F.struct(
            F.lit(c).alias("column"),
            F.hll_sketch_agg(value(c), F.lit(precision)).alias("sketch"),
            F.count(value(c)).alias("values"),
            F.count_if(value(c).isNull()).alias("missing"),
        )
        for c in columns
    ]
    sketched = df.groupBy(*map(quoted, by)).agg(F.array(*parts).alias("_columns"))
    return sketched.select(*map(quoted, by), F.inline("_columns"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of larger groups: those of ``by`` and column, or of each column overall.

    Sketches of different precisions merge to the lower one.
    """
    return sketches.groupBy(*map(quoted, by), "column").agg(
        F.hll_union_agg("sketch", F.lit(True)).alias("sketch"),
        F.sum("values").alias("values"),
        F.sum("missing").alias("missing"),
    )


def distinct_estimate(sketch: Column | str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``distinct_values`` in place of the sketch."""
    kept = [F.col(quoted(c)) for c in sketches.columns if c != "sketch"]
    return sketches.select(*kept, distinct_estimate().alias("distinct_values"))
